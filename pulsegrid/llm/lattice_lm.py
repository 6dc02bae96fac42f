"""Language-model scores: a word model with additive smoothing, and a lattice over subwords.

Both learn from the training rows: those whose ``crc32`` of the id as text is no multiple of ``FOLDS``.
Words are lower case (A-Z only), and every text ends with an end token.

* Word model: log10((c + 0.1) / (N + 0.1 (V + 1))) summed over a text's tokens.
* Lattice model: the pieces come from an existing subword vocabulary. Their probabilities are the
  additively smoothed counts of the pieces in the training words, as the vocabulary's own tokenizer
  cuts them (at most as many numbers as the vocabulary has pieces). A word, with the mark of a word start
  before it, has the probability of all its segmentations together, found by a forward recursion
  over its bytes in log space; each single byte is a piece, so every text has one. Pieces never hold a
  word start inside, so a text's probability is the product over its words and its end.

Words are counted in the tasks and summed by key; the table of distinct words grows with the corpus and
holds each word's count and both scores, so a lattice is walked once per distinct word. The most
frequent words, at most ``COMMON_WORDS``, go to all workers (a bound that does not depend on the input);
the other words of a text reach their scores by a join.

Defined results: null and empty texts consist of the end token; null ids count as the empty text
(held out). Repeated rows are scored alike, and each counts in training. Very long words and texts are
scored whole. Other columns are ignored. Without training rows all counts are zero.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache
from itertools import repeat
from math import exp, log, log10

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.words import map_arrow
from pulsegrid.session import cut_lineage

FOLDS = 10
SMOOTH = 0.1
COMMON_WORDS = 1 << 18
FLUSH_WORDS = 200_000
END = "\n"  # no word holds white space
WORD_START = "▁"


def rows_of(docs: DataFrame, id_col: str, text_col: str, folds: int = FOLDS) -> DataFrame:
    """(id, held_out, text)."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"), (F.crc32(key.cast("binary")) % folds == 0).alias("held_out"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def count_words(rows: DataFrame) -> DataFrame:
    """(word, c): every word with its count in training rows, zero if only held out; and the end."""

    def table(counts: Counter) -> pa.RecordBatch:
        words = pa.array(counts.keys(), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [words, pa.array(counts.values(), pa.int64())], names=["word", "c"]
        )

    def over(batches):
        counts: Counter = Counter()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for text, held in zip(texts, batch.column("held_out").to_pylist()):
                words = text.lower().split()
                if held:
                    counts.update(dict.fromkeys(words, 0))
                else:
                    counts.update(words)
                    counts[END.encode()] += 1
                if len(counts) >= FLUSH_WORDS:
                    yield table(counts)
                    counts = Counter()
        counts[END.encode()] += 0
        yield table(counts)

    found = rows.select("held_out", "text").mapInArrow(over, "word string, c long")
    return found.groupBy("word").agg(F.sum("c").alias("c"))


@lru_cache(maxsize=2)
def _processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def pieces(path: str) -> tuple[bytes | None, ...]:
    """The bytes of each piece; None for control pieces."""
    model = _processor(path)
    out = []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            out.append(None)
        elif model.is_byte(i):
            out.append(bytes([int(model.id_to_piece(i)[1:-1], 16)]))
        else:
            out.append(model.id_to_piece(i).encode())
    return tuple(out)


def count_pieces(words: DataFrame, path: str) -> DataFrame:
    """(piece, n): how often the vocabulary's tokenizer uses each piece in the training words."""

    def over(batches):
        total = np.zeros(len(pieces(path)), dtype=np.int64)
        for batch in batches:
            ids = _processor(path).encode(batch.column("word").to_pylist(), num_threads=1)
            sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            flat = np.fromiter((i for word in ids for i in word), dtype=np.int64, count=sizes.sum())
            np.add.at(total, flat, np.repeat(batch.column("c").to_numpy(), sizes))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(total[used])], names=["piece", "n"]
        )

    used = words.where(F.col("c") > 0).where(F.col("word") != END)
    return used.mapInArrow(over, "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def piece_weights(counts: dict[int, int], ends: int, path: str) -> tuple[dict[bytes, float], float]:
    """Natural logarithm of each piece's probability by its bytes, and that of the end."""
    listed = pieces(path)
    usable = [i for i, p in enumerate(listed) if p is not None]
    weight: dict[bytes, float] = {}
    for i in usable:
        weight[listed[i]] = weight.get(listed[i], 0.0) + counts.get(i, 0) + SMOOTH
    for b in range(256):
        weight.setdefault(bytes([b]), SMOOTH)
    total = sum(weight.values()) + ends + SMOOTH
    return {p: log(w / total) for p, w in weight.items()}, log((ends + SMOOTH) / total)


def log_marginal(data: bytes, weights: dict[bytes, float], longest: int) -> float:
    """Natural logarithm of the probability of all segmentations of ``data`` together."""
    get, forward = weights.get, [0.0]
    for end in range(1, len(data) + 1):
        terms = []
        for start in range(max(0, end - longest), end):
            w = get(data[start:end])
            if w is not None:
                terms.append(forward[start] + w)
        top = max(terms)
        forward.append(top + log(sum([exp(t - top) for t in terms])))
    return forward[-1]


def score_words(words: DataFrame, path: str) -> tuple[DataFrame, int]:
    """(word, c, base, lattice) of every word of ``count_words``; the training tokens."""
    words = cut_lineage(words, "lm-counts")
    size = words.agg(
        F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v"),
        F.max(F.when(F.col("word") == END, F.col("c"))).alias("ends"),
    ).first()
    total, ends = size.n or 0, size.ends or 0
    # one row per used piece: bounded by the vocabulary
    used = {r.piece: r.n for r in count_pieces(words, path).collect()}
    weights, end_weight = piece_weights(used, ends, path)
    longest = max(map(len, weights))
    shared = words.sparkSession.sparkContext.broadcast(weights)

    def over(batch: pa.RecordBatch):
        table, out = shared.value, []
        for word in batch.column("word").to_pylist():
            out.append(
                end_weight if word == END
                else log_marginal((WORD_START + word).encode(), table, longest)
            )
        lattice = np.array(out, dtype=np.float64) / log(10)
        yield pa.RecordBatch.from_arrays(
            [batch.column("word"), batch.column("c"), pa.array(lattice)],
            names=["word", "c", "lattice"],
        )

    scored = map_arrow(words, over, "word string, c long, lattice double")
    rest = log10(total + SMOOTH * (size.v + 1))
    scored = scored.withColumn("base", F.log10(F.col("c") + SMOOTH) - rest)
    return cut_lineage(scored, "lm-words"), total


def _common(scored: DataFrame, most: int) -> DataFrame:
    """The most frequent words: as many frequency classes as hold at most ``most`` words."""
    level = F.floor(F.log2(F.col("c") + F.lit(1)) * 16)
    sizes = scored.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    least, room = None, most
    for row in sizes:  # at most 16 * 64 classes
        room -= row["count"]
        if room < 0:
            break
        least = row["level"]
    return scored.where(level >= least) if least is not None else scored.limit(0)


def score(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
    folds: int = FOLDS, common_words: int = COMMON_WORDS,
) -> DataFrame:
    """(id column, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``vocabulary`` is the path of a subword model that every executor can open (it is installed there).
    """
    rows = rows_of(docs, id_col, text_col, folds)
    scored, total = score_words(count_words(rows), vocabulary)
    common = _common(scored, common_words).toArrow()
    place = {w: i for i, w in enumerate(common.column("word").cast(pa.binary()).to_pylist())}
    nothing = np.zeros(1)
    values = [
        np.concatenate([common.column(c).to_numpy(), nothing]) for c in ("c", "base", "lattice")
    ]
    shared = docs.sparkSession.sparkContext.broadcast((place, values))

    def over(batch: pa.RecordBatch):
        table, (c, base, lattice) = shared.value
        known, out, ends = c > 0, [], [0]
        names, times = [], []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            words = text.lower().split()
            words.append(END.encode())
            at = np.fromiter(map(table.get, words, repeat(-1)), dtype=np.int64, count=len(words))
            rare = Counter([words[i] for i in np.flatnonzero(at < 0)])
            names += rare.keys()
            times += rare.values()
            ends.append(len(names))
            out.append((len(words), int(known[at].sum()), float(base[at].sum()), float(lattice[at].sum())))
        tokens, some, bases, lattices = zip(*out) if out else ([],) * 4
        rest = pa.StructArray.from_arrays(
            [pa.array(names, pa.binary()).cast(pa.string()), pa.array(times, pa.int64())],
            names=["word", "times"],
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("id"), batch.column("held_out"),
             pa.array(tokens, pa.int64()), pa.array(some, pa.int64()), pa.array(bases, pa.float64()),
             pa.array(lattices, pa.float64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rest)],
            names=["row", "id", "held_out", "n_tokens", "n_known", "base", "lattice", "rest"],
        )

    kind = rows.schema["id"].dataType.simpleString()
    parts = map_arrow(
        rows.select(F.monotonically_increasing_id().alias("row"), "id", "held_out", "text"), over,
        f"row long, id {kind}, held_out boolean, n_tokens long, n_known long, base double, "
        "lattice double, rest array<struct<word:string,times:long>>",
    )
    # the table fixes the row numbers, too
    parts = cut_lineage(parts, "lm-rows")
    rest = (
        parts.select("row", F.inline("rest")).join(scored, "word")
        .groupBy("row").agg(
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("n_known"),
            F.sum(F.col("times") * F.col("base")).alias("base"),
            F.sum(F.col("times") * F.col("lattice")).alias("lattice"),
        )
    )
    nil = F.lit(0)
    joined = parts.drop("rest").alias("p").join(rest.alias("r"), "row", "left")
    return joined.select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("p.n_known") + F.coalesce("r.n_known", nil)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("p.base") + F.coalesce("r.base", nil)).alias("base_score"),
        (F.col("p.lattice") + F.coalesce("r.lattice", nil)).alias("score"),
    )
