"""Removal of passages that occur elsewhere, by counting content-defined stretches of windows.

This stands in for relative Lempel-Ziv parsing: nothing is matched greedily and no factor length is
tested, but all windows that occur again are found.

The reference is the whole corpus. It is cut into blocks by content: every window of
``window`` words chooses the 8-word anchor with the least hash in it (the leftmost of equals), and
the block of an anchor holds all places where that anchor was chosen. A document therefore meets a
block only where they share an anchor, and every block that could hold one of its windows.

A document gives each of its blocks one *stretch* for every place of the anchor: the maximal run of
consecutive windows that chose it.

* A stretch whose whole word sequence is in the block a second time is taken as a whole.
  Consecutive stretches join to longer passages when their spans are united.
* Where a block holds several different stretches for an anchor, a common passage ends inside
  them. There, and only there, the single windows are compared.

Both steps are hash aggregations with map-side combining; no group is gathered in one task.
Copies of a text share its 128-bit key, so their stretches are found and stored once. Equality is that
of 64-bit hashes within equal 64-bit anchors (and 128-bit text keys).

Defined results: null and empty texts have no words and stay empty; texts shorter than a window
keep all words; repeated rows are copies of each other, so all their windows go; rows with a null
id are kept. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.words import (
    WORD_BASE, map_arrow, mix, range_hash, row_bounds, runs, split_words,
)
from pulsegrid.session import cut_lineage, drop_table

WINDOW = 35
ANCHOR_WORDS = 8

SPANS = "array<struct<lo:int,n:int>>"
STRETCH = "k1 long, k2 long, anchor long, body long, lo int, n int"


def with_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, k1, k2, text): two independent 64-bit hashes identify a text; null is empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("k1"),
        F.xxhash64(F.lit(7), text).alias("k2"), text.alias("text"),
    )


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """Index of the least of ``values[i:i + span]``, the leftmost of equals, for each i."""
    at, width = np.arange(len(values)), 1
    best = values
    while width < span:
        step = min(width, span - width)
        right, right_at = best[step:], at[step:]
        left, left_at = best[:-step], at[:-step]
        take = right < left
        best, at = np.where(take, right, left), np.where(take, right_at, left_at)
        width += step
    return at


def stretches(hashes: np.ndarray, bounds: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(first window, number of windows, anchor hash, body hash) of all stretches of a run."""
    span = window - ANCHOR_WORDS + 1
    none = np.zeros(0, dtype=np.int64)
    if len(hashes) < window:
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    starts = np.arange(len(hashes) - ANCHOR_WORDS + 1)
    grams = range_hash(hashes, WORD_BASE, starts, starts + ANCHOR_WORDS)
    at = _least(grams, span)
    # a window is whole if it ends within the row in which it starts
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(at)]
    whole = np.arange(len(at)) + window <= bounds[1:][row]
    same = np.zeros(len(at) + 1, dtype=bool)
    same[1:-1] = whole[1:] & whole[:-1] & (at[1:] == at[:-1])
    lo = np.flatnonzero(whole & ~same[:-1])
    hi = np.flatnonzero(whole & ~same[1:])
    n, off = hi - lo + 1, at[lo] - lo
    body = range_hash(hashes, WORD_BASE, lo, hi + window)
    return lo, n, grams[at[lo]], mix(body + (n * 64 + off).astype(np.uint64))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def parse_stretches(keyed: DataFrame, window: int) -> DataFrame:
    """All stretches of all documents, one row each."""

    def parse(batch: pa.RecordBatch):
        k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
        for first, data, offsets in runs(batch.column("text")):
            starts, _, hashes = split_words(data)
            bounds = row_bounds(starts, offsets)
            lo, n, anchor, body = stretches(hashes, bounds, window)
            row = np.searchsorted(bounds, lo, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[first + row]), pa.array(k2[first + row]), _signed(anchor), _signed(body),
                 pa.array((lo - bounds[row]).astype(np.int32)), pa.array(n.astype(np.int32))],
                names=["k1", "k2", "anchor", "body", "lo", "n"],
            )

    return map_arrow(keyed.select("k1", "k2", "text"), parse, STRETCH)


def boundary_windows(keyed: DataFrame, at: DataFrame, window: int) -> DataFrame:
    """(k1, k2, anchor, start, w) of every window in the stretches listed in ``at``.

    ``at`` has k1, k2 and ``places``, an array of (anchor, lo, n).
    """

    def windows(batch: pa.RecordBatch):
        k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
        places = batch.column("places")
        for first, data, offsets in runs(batch.column("text")):
            starts, _, hashes = split_words(data)
            bounds = row_bounds(starts, offsets)
            listed = places.slice(first, len(offsets) - 1)
            flat = listed.flatten()
            counts = np.diff(listed.offsets.to_numpy())
            row = np.repeat(np.arange(len(counts)), counts)
            anchor, lo, n = (flat.field(c).to_numpy() for c in ("anchor", "lo", "n"))
            each = np.repeat(np.arange(len(n)), n)
            step = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
            start = lo[each] + step
            absolute = bounds[row[each]] + start
            w = range_hash(hashes, WORD_BASE, absolute, absolute + window)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[first + row[each]]), pa.array(k2[first + row[each]]),
                 pa.array(anchor[each]), pa.array(start.astype(np.int32)), _signed(w)],
                names=["k1", "k2", "anchor", "start", "w"],
            )

    return map_arrow(
        keyed.join(at, ["k1", "k2"]).select("id", "k1", "k2", "text", "places"), windows,
        "k1 long, k2 long, anchor long, start int, w long",
    )


def duplicate_spans(keyed: DataFrame, window: int = WINDOW) -> DataFrame:
    """(k1, k2, spans): per text the array of (lo, n): n repeated windows from word lo on."""
    stretch = cut_lineage(parse_stretches(keyed, window), "rlz-stretches")
    often = stretch.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    met = cut_lineage(stretch.join(often.select("anchor"), "anchor", "left_semi"), "rlz-met")
    drop_table(stretch)
    index = cut_lineage(
        met.groupBy("anchor", "body").agg(
            F.count("*").alias("places"), F.min(F.struct("k1", "k2", "lo", "n")).alias("one"),
        ),
        "rlz-index",
    )
    repeated = index.where("places > 1").select("anchor", "body")
    factors = met.join(repeated, ["anchor", "body"], "left_semi").select("k1", "k2", "lo", "n")

    # factor boundaries: anchors with several bodies, one place of each
    several = index.groupBy("anchor").agg(F.count("*").alias("bodies")).where("bodies > 1")
    at = (
        index.join(several.select("anchor"), "anchor", "left_semi")
        .groupBy(F.col("one.k1").alias("k1"), F.col("one.k2").alias("k2"))
        .agg(F.collect_list(F.struct("anchor", "one.lo", "one.n")).alias("places"))
    )
    # not cut: the exchange of the texts is the one that remove_spans uses
    windows = boundary_windows(keyed, cut_lineage(at, "rlz-boundaries"), window)
    place = F.xxhash64("k1", "k2", "start")
    shared = (
        windows.groupBy("anchor", "w")
        .agg(F.min(place).alias("a"), F.max(place).alias("b"))
        .where("a <> b").select("anchor", "w")
    )
    single = windows.join(shared, ["anchor", "w"], "left_semi")
    return (
        factors.unionByName(single.select("k1", "k2", F.col("start").alias("lo"), F.lit(1).alias("n")))
        .groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "n")).alias("spans"))
    )


def remove_spans(keyed: DataFrame, spans: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id, text, n_words, n_removed): texts without the words that their spans cover.

    The kept words are joined by one blank.
    """

    def remove(batch: pa.RecordBatch):
        texts, listed = batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans")
        first = listed.offsets.to_numpy()
        flat = listed.values
        lo = flat.field("lo").to_numpy(zero_copy_only=False).astype(np.int64)
        hi = lo + flat.field("n").to_numpy(zero_copy_only=False) + window - 1
        total, gone, kept = [], [], []
        for i, text in enumerate(texts):
            words = text.split()
            total.append(len(words))
            a, b = first[i], first[i + 1]
            if a < b:
                covered = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(covered, lo[a:b], 1)
                np.add.at(covered, hi[a:b], -1)
                words = [words[j] for j in np.flatnonzero(np.cumsum(covered[:-1]) == 0)]
            gone.append(total[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(kept, pa.binary()).cast(pa.string()),
             pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
            names=["id", "text", "n_words", "n_removed"],
        )

    kind = keyed.schema["id"].dataType.simpleString()
    rows = (
        keyed.join(spans, ["k1", "k2"], "left")
        .select("id", "text", F.coalesce("spans", F.expr(f"CAST(array() AS {SPANS})")).alias("spans"))
    )
    return map_arrow(rows, remove, f"id {kind}, text string, n_words long, n_removed long")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
) -> DataFrame:
    """Every document without the words of windows that start anywhere else, too.

    Returns the id column, text, n_words and n_removed, one row per input row.
    """
    keyed = with_key(docs, id_col, text_col)
    out = remove_spans(keyed, duplicate_spans(keyed, window), window)
    return out.withColumnRenamed("id", id_col)
