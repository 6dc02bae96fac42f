"""Quality rules on repetition, by a suffix array over words.

The suffix array of a run of texts is built by prefix doubling: suffixes that agree on their first
2**k words keep a common rank, and only ranks that are still shared are refined; of each level just the
refined ranks are kept. Each text ends with a symbol of its own, so no repeat crosses texts. From the ranks
the longest common prefix (LCP) of neighbouring suffixes is read level by level. The LCP intervals
that hold a suffix have at most the larger of its two neighbouring LCP values, so that value is the
longest substring starting there which occurs again; the union of these spans is the union of
all maximal repeats.

Rules: a text fails if repeats of at least ``MIN_REPEAT`` words cover more than ``MAX_COVERED`` of the
characters in its words and more than ``MIN_COVERED`` characters, or if its longest repeat has more than
``MAX_REPEAT`` words. Base rules (fewer than 50 words; words in repeated 3-word windows over half of
all) come from the same arrays. Every covered word also lies in a repeated 3-word window, so
``MAX_COVERED`` must stay well below one half to decide anything; header and footer lines that stand
twice in a short text are what ``MIN_COVERED`` allows, in texts of any length.

Defined results: null and empty texts have no words and fail the base rules; texts of any length are
judged whole; repeated rows are judged alike. Extra columns pass through ``accepted`` and are ignored
by ``measure``. Words are compared by 64-bit hashes within one text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.words import (
    BYTE_CODE, LINE_BASE, map_arrow, range_hash, row_bounds, runs, split_words,
)

MIN_REPEAT = 8
MAX_COVERED = 0.3
MIN_COVERED = 200
MAX_REPEAT = 50
MIN_WORDS = 50
WINDOW = 3

SYMBOL = np.zeros(256, dtype=np.int64)
SYMBOL[list(b"#*$%&|<>")] = 1

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat",
    "covered_chars",
)


def _ranks(symbols: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Ranks of all suffixes, and for each level the (suffixes, their ranks by 1, 2, 4, ... symbols).

    A rank is the place of the first suffix with that prefix in the suffix array. A level lists, in text
    order, the suffixes whose prefix of that length still occurs again; all others have their last rank.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable").astype(np.int32)
    fresh = np.concatenate([[True], symbols[order][1:] != symbols[order][:-1]])
    starts = np.flatnonzero(fresh).astype(np.int32)
    sub = np.cumsum(fresh) - 1
    rank = np.empty(n, dtype=np.int32)
    rank[order] = starts[sub]
    active = order[np.diff(np.append(starts, n))[sub] > 1]
    levels, step = [], 1
    while len(active):
        listed = np.sort(active)
        levels.append((listed, rank[listed]))
        # the last symbol is unique, so active + step stays inside
        old, then = rank[active], rank[active + step]
        by = np.lexsort((then, old))
        active, old, then = active[by], old[by], then[by]
        group = np.concatenate([[True], old[1:] != old[:-1]])
        fresh = group | np.concatenate([[True], then[1:] != then[:-1]])
        within = np.arange(len(active)) - np.flatnonzero(group)[np.cumsum(group) - 1]
        starts = np.flatnonzero(fresh)
        sub = np.cumsum(fresh) - 1
        rank[active] = old + within[starts][sub]
        active = active[np.diff(np.append(starts, len(active)))[sub] > 1]
        step *= 2
    return rank, levels


def longest_repeats(symbols: np.ndarray) -> np.ndarray:
    """For every position the length of the longest substring from it that occurs again.

    The last symbol must be unique.
    """
    n = len(symbols)
    rank, levels = _ranks(symbols)
    suffixes = np.empty(n, dtype=np.int32)
    suffixes[rank] = np.arange(n, dtype=np.int32)
    a, b = suffixes[:-1], suffixes[1:]
    same = np.zeros(n - 1, dtype=np.int32)
    for k in range(len(levels) - 1, -1, -1):
        # two suffixes agree on 2**k symbols if both are listed at that level with one rank
        listed, ranks = levels[k]
        here, there = a + same, b + same
        i = np.minimum(np.searchsorted(listed, here), len(listed) - 1)
        j = np.minimum(np.searchsorted(listed, there), len(listed) - 1)
        agree = (listed[i] == here) & (listed[j] == there) & (ranks[i] == ranks[j])
        same += agree.astype(np.int32) << np.int32(k)
    lcp = np.zeros(n + 1, dtype=np.int64)
    lcp[1:n] = same
    out = np.empty(n, dtype=np.int64)
    out[suffixes] = np.maximum(lcp[:-1], lcp[1:])
    return out


def _covered(length: np.ndarray, least: int) -> np.ndarray:
    """Positions inside the spans of repeats of at least ``least`` symbols."""
    at = np.flatnonzero(length >= least)
    change = np.zeros(len(length) + 1, dtype=np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + length[at], -1)
    return np.cumsum(change[:-1]) > 0


def _row_sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[cuts[1:]] - sums[cuts[:-1]]


def _run(data: np.ndarray, offsets: np.ndarray, min_repeat: int) -> dict[str, np.ndarray]:
    rows = len(offsets) - 1
    starts, ends, hashes = split_words(data)
    bounds = row_bounds(starts, offsets)
    n_words = np.diff(bounds)

    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = points[ends] - points[starts]
    out = {
        "n_words": n_words, "word_chars": _row_sums(chars, bounds),
        "n_symbols": _row_sums(SYMBOL[data], offsets),
    }

    breaks = np.flatnonzero(data == 10)
    heads = np.concatenate([[0], breaks[:-1] + 1])
    filled = np.searchsorted(starts, breaks) > np.searchsorted(starts, heads)
    heads, breaks = heads[filled], breaks[filled]
    line = range_hash(BYTE_CODE[data], LINE_BASE, heads, breaks)
    row = np.searchsorted(offsets, heads, side="right") - 1
    by = np.lexsort((line, row))
    again = (line[by][1:] == line[by][:-1]) & (row[by][1:] == row[by][:-1])
    out["n_dup_lines"] = np.bincount(row[by][1:][again], minlength=rows)

    # every word is numbered within its text; a symbol of its own ends each text
    row = np.repeat(np.arange(rows), n_words)
    by = np.lexsort((hashes, row))
    fresh = np.ones(len(by), dtype=bool)
    fresh[1:] = (hashes[by][1:] != hashes[by][:-1]) | (row[by][1:] != row[by][:-1])
    number = np.empty(len(by), dtype=np.int64)
    number[by] = np.cumsum(fresh) + rows
    symbols = np.empty(len(number) + rows, dtype=np.int64)
    place = np.arange(len(number)) + row
    symbols[place] = number
    symbols[bounds[1:] + np.arange(rows)] = np.arange(rows)
    length = longest_repeats(symbols)
    cuts = bounds + np.arange(rows + 1)
    out["n_repeat_words"] = _row_sums(_covered(length, WINDOW), cuts)
    out["longest_repeat"] = np.maximum.reduceat(length, cuts[:-1]) if rows else length
    weight = np.zeros(len(symbols), dtype=np.int64)
    weight[place] = chars
    out["covered_chars"] = _row_sums(weight * _covered(length, min_repeat), cuts)
    return out


def _measures(texts: pa.Array, min_repeat: int) -> dict[str, np.ndarray]:
    parts = [_run(data, offsets, min_repeat) for _, data, offsets in runs(texts)]
    none = np.zeros(0, dtype=np.int64)
    return {m: np.concatenate([p[m] for p in parts] or [none]).astype(np.int64) for m in MEASURES}


def _verdict(
    m, max_covered: float, max_repeat: int, min_covered: int = MIN_COVERED,
) -> tuple[np.ndarray, np.ndarray]:
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    allowed = np.maximum(max_covered * m["word_chars"], min_covered)
    fine = (m["covered_chars"] <= allowed) & (m["longest_repeat"] <= max_repeat)
    return failed, ~failed & fine


def measure(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_repeat: int = MIN_REPEAT,
    max_covered: float = MAX_COVERED, max_repeat: int = MAX_REPEAT, min_covered: int = MIN_COVERED,
) -> DataFrame:
    """(id column, the measures, base_failed, kept) of every row."""

    def judge(batch: pa.RecordBatch):
        m = _measures(batch.column("text"), min_repeat)
        failed, kept = _verdict(m, max_covered, max_repeat, min_covered)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), *[pa.array(m[k]) for k in MEASURES], pa.array(failed), pa.array(kept)],
            names=["id", *MEASURES, "base_failed", "kept"],
        )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    columns = ", ".join(f"{m} long" for m in MEASURES)
    out = map_arrow(rows, judge, f"id {kind}, {columns}, base_failed boolean, kept boolean")
    return out.withColumnRenamed("id", id_col)


def accepted(
    docs: DataFrame, text_col: str = "text", min_repeat: int = MIN_REPEAT,
    max_covered: float = MAX_COVERED, max_repeat: int = MAX_REPEAT, min_covered: int = MIN_COVERED,
) -> DataFrame:
    """The rows of ``docs`` that pass all rules, with all their columns."""

    def keep(batch: pa.RecordBatch):
        m = _measures(batch.column(text_col), min_repeat)
        yield batch.filter(pa.array(_verdict(m, max_covered, max_repeat, min_covered)[1]))

    return map_arrow(docs, keep, docs.schema)
