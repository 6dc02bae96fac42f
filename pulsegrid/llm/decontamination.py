"""Test items inside documents: MinHash containment search by size class, in DataFrame expressions only.

An item is contained in a document if at least ``threshold`` of the item's distinct shingles (five
words in a row, lower case, words being runs of letters and digits) are shingles of the document.

Items are partitioned by size: class c holds the items with 2**c to 2**(c + 1) - 1 distinct shingles. The
MinHash signature of an item is its k shingles of least hash, and k follows from the upper bound u
of the class: k = floor((1 - threshold) * u) + 1. A document that contains an item lacks at most
(1 - threshold) * u of its shingles, so it holds one of any k of them: the search over signatures
finds every contained item, however long the document. The documents' shingles meet the signatures in
a hash join that streams them; candidates (text, item) are then verified by counting the item's
shingles in the text as strings.

The signatures and item shingles grow with the benchmark only. They are broadcast if they were counted
and have at most ``BROADCAST_ROWS`` rows, else joined by shuffle.

Defined results: a text of one to four words is one shingle, so such an item is only found in an equal
text; items and texts that are null or without words match nothing; repeated rows of a document
give one row per item, repeated items are found under each id; null ids are kept. Other columns
are ignored by ``contained`` and kept by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.session import cut_lineage

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BROADCAST_ROWS = 1_000_000
WORD_GAP = r"[^\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_GAP), lambda w: w != "")


def _starts(words: Column, size: int) -> Column:
    """First positions of all shingles (of the only one, if there are fewer words)."""
    n = F.greatest(F.size(words) - (size - 1), F.least(F.size(words), F.lit(1)))
    return F.when(n > 0, F.sequence(F.lit(0), n - 1))


def _hashed(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` with one row per shingle and its ``hash``, from their column ``words``."""
    hashes = rows.withColumn("words", F.transform("words", lambda w: F.xxhash64(w)))
    each = hashes.withColumn("at", F.explode(_starts(F.col("words"), size)))
    return each.withColumn(
        "hash", F.xxhash64(*[F.get("words", F.col("at") + i) for i in range(size)])
    ).drop("words", "at")


def _strings(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` with one row per shingle as ``shingle``."""
    each = rows.withColumn("at", F.explode(_starts(F.col("words"), size)))
    return each.withColumn(
        "shingle", F.array_join(F.slice("words", F.col("at") + 1, F.lit(size)), " ")
    ).drop("words", "at")


def _small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it was counted to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def signatures(
    items: DataFrame, id_col: str, text_col: str, size: int, threshold: float,
) -> tuple[DataFrame, DataFrame]:
    """(item, hash) of all signatures; (item, n_item, shingle) of all items."""
    words = items.select(F.col(id_col).alias("item"), words_of(F.col(text_col)).alias("words"))
    words = words.withColumn("key", F.xxhash64(F.array_join("words", " ")))
    hashes = _hashed(words, size).distinct()
    one = Window.partitionBy("item", "key")
    ranked = hashes.select(
        "item", "hash", F.count("*").over(one).alias("n"),
        F.row_number().over(one.orderBy("hash")).alias("rank"),
    )
    upper = F.pow(F.lit(2.0), F.floor(F.log2("n")) + 1) - 1
    # the margin keeps rounding from making a signature too short
    keep = F.floor(F.lit(1 - threshold) * upper + 1e-9) + 1
    shingles = _strings(words, size).distinct()
    whole = shingles.withColumn("n_item", F.count("*").over(one).cast("long"))
    return ranked.where(F.col("rank") <= keep).select("item", "hash").distinct(), whole


def contained(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", size: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id column, item column, n_shared, n_item, k1, k2) of all contained items.

    k1 and k2 identify the text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2"),
        words_of(text).alias("words"),
    )
    short, whole = (
        cut_lineage(t, "containment") for t in signatures(items, item_col, item_text_col, size, threshold)
    )
    found = (
        _hashed(texts.select("k1", "k2", "words"), size).join(_small(short), "hash")
        .select("k1", "k2", "item").distinct()
    )
    found = cut_lineage(found, "containment")
    near = texts.join(found.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")
    shared = (
        _strings(near, size).join(_small(whole), "shingle")
        .select("id", "k1", "k2", "item", "key", "n_item", "shingle").distinct()
        .groupBy("id", "k1", "k2", "item", "key", "n_item").agg(F.count("*").alias("n_shared"))
        .where(F.col("n_shared") >= F.lit(threshold) * F.col("n_item") - 1e-9)
        .groupBy("id", "k1", "k2", "item")
        .agg(F.max(F.struct("n_shared", "n_item")).alias("best"))
    )
    return shared.select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), "best.n_shared", "best.n_item",
        "k1", "k2",
    )


def clean(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns."""
    only = docs.select(F.lit(None).cast("int").alias("id"), F.col(text_col).alias("text"))
    found = contained(only, items, "id", "text", item_col, item_text_col)
    found = cut_lineage(found.select("k1", "k2").distinct(), "containment")
    text = F.coalesce(F.col(text_col), F.lit(""))
    kept = docs.join(
        found,
        (F.xxhash64(text) == found.k1) & (F.xxhash64(F.lit(7), text) == found.k2), "left_anti",
    )
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
