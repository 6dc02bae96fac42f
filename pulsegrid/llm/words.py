"""Vectorised words and hashes of whole Arrow string columns.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and carriage
return. Every function works on runs of rows (``runs``) of a few MB, a longer row alone, so the
memory of a task does not depend on the size of an Arrow batch. Hashes are polynomials modulo
2**64 with fixed random tables, mixed at the end; they agree between processes and executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN_BYTES = 1 << 21
SEGMENT_BYTES = 1 << 18

SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

EMPTY, LINE_FEED = (pa.scalar(x, pa.large_string()) for x in ("", "\n"))

_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_CODE = _rng.integers(1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
LINE_BASE = 0xA0761D6478BD642F


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of unsigned 64-bit values over the whole word."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below ``size`` (base is odd)."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.ones(1, dtype=np.uint64)
        while len(p) < size:
            p = np.concatenate([p, p * np.uint64(pow(b, len(p), 1 << 64))])
        out.append(p)
    return out[0], out[1]


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Power tables with at least ``size`` entries; sizes are rounded up to share tables."""
    return _powers(base, 1 << max(10, int(size).bit_length()))


def range_hash(codes: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of ``codes[start:end]`` for every pair, equal for equal content."""
    up, down = powers(base, len(codes) + 1)
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * up[: len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def runs(texts: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) of runs of rows; each row is followed by a line feed.

    A null counts as an empty text.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    ends = np.cumsum(sizes)
    first = 0
    while first < len(texts):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + limit, side="right")))
        part = pc.binary_join_element_wise(texts.slice(first, last - first), EMPTY, LINE_FEED)
        offsets = np.frombuffer(part.buffers()[1], dtype=np.int64)
        offsets = offsets[part.offset:part.offset + len(part) + 1]
        data = np.frombuffer(part.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
        yield first, data, offsets - offsets[0]
        first = last


def segments(data: np.ndarray, size: int = SEGMENT_BYTES) -> Iterator[tuple[int, int]]:
    """Cut a run into pieces that end behind a white-space byte, so no word is cut."""
    start, n = 0, len(data)
    while start < n:
        end = min(n, start + size)
        while end < n and not SPACE[data[end - 1]]:
            reach = min(n, end + 4096)
            hit = np.flatnonzero(SPACE[data[end - 1:reach]])
            end = end + int(hit[0]) if len(hit) else reach
        yield start, end
        start = end


def split_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word of a run (which ends with white space)."""
    starts, ends, hashes = [], [], []
    for a, b in segments(data):
        part = data[a:b]
        inside = np.zeros(len(part) + 2, dtype=np.int8)
        inside[1:-1] = ~SPACE[part]
        edge = np.diff(inside)
        s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        starts.append(s + a)
        ends.append(e + a)
        hashes.append(range_hash(BYTE_CODE[part], BYTE_BASE, s, e))
    if not starts:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(0, dtype=np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def row_bounds(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index of the first word of every row, and the number of words at the end."""
    return np.searchsorted(starts, offsets)


def release() -> None:
    """Give back what Arrow holds free: workers are used again, and their memory adds up."""
    pa.default_memory_pool().release_unused()


def map_arrow(df, fn, schema: str):
    """``df.mapInArrow`` for a function from one batch to an iterator of batches."""

    def over(batches):
        try:
            for batch in batches:
                yield from fn(batch)
        finally:
            release()

    return df.mapInArrow(over, schema)
