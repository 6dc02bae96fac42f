"""Importance resampling towards a target distribution, on hashed n-grams.

Letters A-Z are lowered and every run of separators becomes one blank. One scan with ``regex`` and
``overlapped=True`` then stands at each word (a lookbehind asks for a blank or the start before it, a
lookahead for a blank or the end behind it) and its groups are the word and the words that follow: the
spans of all n-grams that start there. A CRC is carried on from span to span, so that each n-gram costs
only its last word; it is counted in bucket ``CRC modulo BUCKETS``.

Counts over all source rows and all target rows give every bucket a gain, the floored log ratio of the
smoothed shares. A row's weight is the sum of the gains of its n-grams; with Gumbel noise from a hash
of its id, the highest scores are a draw without replacement in proportion to the importance.

The texts are scanned once: bucket numbers are written to the shared folder (two bytes an n-gram), counted per
task into one table of ``BUCKETS`` counters, which is the size of anything that is collected or
sent to tasks, and read again for the weights. Ranks come from a range partitioning of narrow
rows and the sizes of its partitions; no task sees all rows.

Defined results: null and empty texts have no words, weight 0, and are never drawn; texts of any length are
counted whole; a null id hashes as the empty text and ranks behind equal scores; repeated rows count
and rank each for itself, in no certain order among them. Empty tables are allowed on both sides; other columns
are ignored.
"""

from __future__ import annotations

import math
from array import array
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.words import map_arrow
from pulsegrid.session import cut_lineage

BUCKETS = 10_000
MAX_WORDS = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42
GAIN_SCALE = 1000

# separators become blanks and A-Z lower case; digits, a-z and bytes of longer characters stay
_CLEAN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_BLANKS = regex.compile(rb" ++")


def ngram_pattern(max_words: int) -> regex.Pattern:
    """At each word: the word, and the blank and word of each longer n-gram, as far as there are any."""
    return regex.compile(rb"(?<![^ ])([^ ]++)" + rb"( [^ ]++)?" * (max_words - 1) + rb"(?![^ ])")


def hashed_ngrams(text: str, pattern: regex.Pattern, buckets: int) -> tuple[int, np.ndarray]:
    """(words, bucket of every n-gram) of a text."""
    data = _BLANKS.sub(b" ", text.encode().translate(_CLEAN)).strip()
    words, codes = 0, array("I")
    put = codes.append
    for match in pattern.finditer(data, overlapped=True):
        words += 1
        code = 0
        for part in match.groups():
            if part is None:
                break
            code = crc32(part, code)
            put(code)
    return words, np.frombuffer(codes, dtype=np.uint32) % np.uint32(buckets)


def features(
    docs: DataFrame, id_col: str | None = "doc_id", text_col: str = "text", buckets: int = BUCKETS,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """(id, n_words, features) of every row; the buckets of its n-grams as packed unsigned numbers."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def over(batch: pa.RecordBatch):
        pattern = ngram_pattern(max_words)
        words, packed = [], []
        for text in batch.column("text").to_pylist():
            n, codes = hashed_ngrams(text, pattern, buckets)
            words.append(n)
            packed.append(codes.astype(kind).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(words, pa.int64()), pa.array(packed, pa.binary())],
            names=["id", "n_words", "features"],
        )

    identity = F.col(id_col) if id_col else F.lit(None).cast("long")
    rows = docs.select(identity.alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind_of_id = rows.schema["id"].dataType.simpleString()
    return map_arrow(rows, over, f"id {kind_of_id}, n_words long, features binary")


def _packed(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers, row offsets) of a binary column."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    values = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data else np.zeros(0, np.uint8)
    return values.view(kind), (offsets - offsets[0]) // kind.itemsize


def bucket_counts(packed: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all rows of ``features``, one table of counters per task."""

    def over(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            values, _ = _packed(batch.column("features"), buckets)
            total += np.bincount(values, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["bucket", "n"]
        )

    return packed.select("features").mapInArrow(over, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _table(counts: DataFrame, buckets: int) -> list[int]:
    out = [0] * buckets
    for row in counts.collect():  # at most one row per bucket
        out[row.bucket] = row.n
    return out


def gains(source: list[int], target: list[int]) -> list[int]:
    """Floored log ratio of the smoothed target and source share of every bucket."""
    size, all_source, all_target = len(source), sum(source), sum(target)
    return [
        math.floor(GAIN_SCALE * math.log(
            float(t + 1) * float(all_source + size) / (float(s + 1) * float(all_target + size))
        ))
        for s, t in zip(source, target)
    ]


def weigh(packed: DataFrame, gain: list[int]) -> DataFrame:
    """(id, n_words, n_features, weight) of every row of ``features``."""
    table = np.array(gain, dtype=np.int64)

    def over(batch: pa.RecordBatch):
        values, offsets = _packed(batch.column("features"), len(table))
        sums = np.concatenate([[0], np.cumsum(table[values])])
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("n_words"), pa.array(np.diff(offsets), pa.int64()),
             pa.array(sums[offsets[1:]] - sums[offsets[:-1]], pa.int64())],
            names=["id", "n_words", "n_features", "weight"],
        )

    kind = packed.schema["id"].dataType.simpleString()
    return map_arrow(packed, over, f"id {kind}, n_words long, n_features long, weight long")


def with_rank(rows: DataFrame, order: list, draw: int, partitions: int) -> DataFrame:
    """``rank`` 1 to ``draw`` by ``order`` (a total order), null behind; rows are dealt by ranges.

    Places within the sorted partitions are shifted by the sizes of the partitions before, one row per
    partition.
    """
    placed = cut_lineage(
        rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()), "ranked",
    )
    part = F.shiftright("place", 33).alias("part")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = placed.groupBy(part).agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")
    )
    rank = F.col("shift") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.withColumn("part", part).join(F.broadcast(shifts), "part").withColumn(
        "rank", F.when(rank <= draw, rank)
    ).drop("part", "shift", "place")


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    target_text_col: str = "text", buckets: int = BUCKETS, max_words: int = MAX_WORDS,
    min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """(id column, n_features, weight, score, rank) of every row; ``rank`` is null for rows not drawn.

    Of the rows with ``min_words`` words or more, ``percent`` of a hundred are drawn.
    """
    spark = docs.sparkSession
    packed = cut_lineage(features(docs, id_col, text_col, buckets, max_words), "ngram-buckets")
    goal = features(target, None, target_text_col, buckets, max_words)
    gain = gains(_table(bucket_counts(packed, buckets), buckets), _table(bucket_counts(goal, buckets), buckets))

    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    share = (F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    noise = F.floor(-1000 * F.ln(-F.ln(share))).cast("long")
    scored = cut_lineage(
        weigh(packed, gain).select(
            "id", "n_features", "weight", (F.col("weight") + noise).alias("score"),
            (F.col("n_words") >= min_words).alias("enough"), F.monotonically_increasing_id().alias("row"),
        ), "scored",
    )
    draw = scored.filter("enough").count() * percent // 100
    order = [F.desc("enough"), F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    ranked = with_rank(scored, order, draw, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return ranked.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
