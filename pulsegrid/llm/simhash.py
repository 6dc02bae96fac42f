"""Near-duplicate groups by SimHash and a grid join on segment popcounts.

A fingerprint is embedded as 32 counts, the set bits of each of its 2-bit segments. One differing
bit changes one count by at most one, so the Manhattan distance of two embeddings is a lower bound
of their bit distance. The counts are stored in unary (00, 01, 11), which makes that distance the
popcount of an exclusive or.

The grid join splits the 32 coordinates into some number of ``blocks``. Points at a Manhattan distance
of at most ``max_bits`` differ on at most ``max_bits`` blocks, so they share a cell of the grid on some
choice of the others: every fingerprint is put in one cell for each choice (35 for 4 bits and 7
blocks), and nothing is lost. In a cell, pairs pass the Manhattan bound, then the exact bit distance.

More blocks make cells more selective and more numerous. ``choose_blocks`` weighs both on the counted
fingerprints: the pairs that meet follow from their number and from how often two of them agree on
each coordinate, which one aggregation of 64 sums gives. The result is the same for any number of
blocks. So the work stays near the number of cells, where a fixed number of blocks would make the pairs
grow with the square of the texts. ``pairs_compared`` counts the pairs that a choice compares.

Cells hold distinct fingerprints, so groups of equal fingerprints cost one row. A cell with more
than ``CELL_ROWS`` of them is cut into blocks, and each pair of blocks is a cell of its own. Rows are
sorted by cell, and a task holds ``ROWS_AT_ONCE`` rows and the cell that is not yet finished, whatever
the size of its partition. It emits a star for each group that it finds, never the pairs.

Defined results: null and empty texts have the fingerprint zero, which links like any other. Rows
with a null id take part; a component's id is its least id that is not null (null if it has none).
Repeated rows give repeated rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import combinations, repeat
from math import comb, prod

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from pulsegrid.llm.components import components
from pulsegrid.llm.words import map_arrow
from pulsegrid.session import cut_lineage

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
CELL_ROWS = 8192
ROWS_AT_ONCE = 1 << 18
HASHES_AT_ONCE = 1 << 16
MOST_BLOCKS = 16
CELL_COST = 64  # writing, shuffling and sorting a row of a cell takes as long as comparing so many pairs


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """Fingerprint of one text (as a signed 64-bit number)."""
    words = text.lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    n = len(words) - size + 1
    votes = np.zeros(64, dtype=np.int64)
    for a in range(0, n, HASHES_AT_ONCE):
        b = min(n, a + HASHES_AT_ONCE)
        cuts = map(slice, starts[a:b].tolist(), (ends[a + size - 1:b + size - 1] - 1).tolist())
        hashes = np.fromiter(
            map(xxh64_intdigest, map(joined.__getitem__, cuts), repeat(SEED)),
            dtype=np.uint64, count=b - a,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.int64)[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS,
) -> DataFrame:
    """(id, fp) of every row."""

    def prints(batch: pa.RecordBatch):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        fp = [fingerprint(t, shingle) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(fp, pa.int64())], names=["id", "fp"]
        )

    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    kind = rows.schema["id"].dataType.simpleString()
    return map_arrow(rows, prints, f"id {kind}, fp long")


def embed(fp: Column) -> Column:
    """Popcounts of the 2-bit segments, each in unary: the segment's bits in order."""
    low = F.lit(0x5555555555555555)
    half = F.shiftrightunsigned(fp, 1)
    either, both = fp.bitwiseOR(half).bitwiseAND(low), fp.bitwiseAND(half).bitwiseAND(low)
    return either.bitwiseOR(F.shiftleft(both, 1))


def cell_masks(max_bits: int = MAX_BITS, blocks: int | None = None) -> list[int]:
    """Bit masks of the coordinate blocks that cells compare, one for each choice of blocks."""
    blocks = blocks or max_bits + 3
    cuts = [2 * round(32 * i / blocks) for i in range(blocks + 1)]
    block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    masks = (sum(c) for c in combinations(block, blocks - max_bits))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def choose_blocks(n: int, agree: list[float], max_bits: int = MAX_BITS) -> int:
    """Number of blocks that is expected to take the least work for ``n`` fingerprints.

    ``agree`` holds, for each coordinate, the share of pairs that agree on it; the estimate takes the
    coordinates as independent.
    """
    def cost(blocks: int) -> float:
        cuts = [round(32 * i / blocks) for i in range(blocks + 1)]
        chosen = [1.0] + [0.0] * (blocks - max_bits)  # sums over all choices of so many blocks
        for a, b in zip(cuts, cuts[1:]):
            block = prod(agree[a:b])
            chosen = [1.0] + [c + block * before for before, c in zip(chosen, chosen[1:])]
        return CELL_COST * comb(blocks, max_bits) + (n - 1) / 2 * chosen[-1]

    return min(range(max_bits + 3, max(MOST_BLOCKS, max_bits + 3) + 1), key=cost)


def blocks_for(prints: DataFrame, max_bits: int = MAX_BITS) -> int:
    """``choose_blocks`` for distinct fingerprints ``fp``, from their number and the counts of their bits."""
    half = F.shiftrightunsigned("fp", 1)
    either, both = F.col("fp").bitwiseOR(half), F.col("fp").bitwiseAND(half)
    sums = [
        F.sum(F.shiftrightunsigned(bits, 2 * i).bitwiseAND(F.lit(1)))
        for bits in (either, both) for i in range(32)
    ]
    n, *counts = prints.agg(F.count("*"), *sums).first()
    if not n:
        return max_bits + 3
    some, two = np.array(counts[:32]) / n, np.array(counts[32:]) / n
    return choose_blocks(n, ((1 - some) ** 2 + (some - two) ** 2 + two ** 2).tolist(), max_bits)


def _pairs(cell: np.ndarray, fp: np.ndarray, point: np.ndarray, max_bits: int):
    """(member, root) of the groups that links inside cells make, from rows sorted by cell."""
    root = np.arange(len(cell))
    left = np.flatnonzero(cell[1:] == cell[:-1])
    step = 1
    while len(left):
        right = left + step
        near = np.bitwise_count(point[left] ^ point[right]) <= max_bits  # Manhattan bound
        a, b = left[near], right[near]
        near = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits
        a, b = a[near], b[near]
        apart = root[a] != root[b]
        for i, j in zip(root[a[apart]].tolist(), root[b[apart]].tolist()):
            while root[i] != i:
                i = root[i]
            while root[j] != j:
                j = root[j]
            root[max(i, j)] = min(i, j)
        while not np.array_equal(root, up := root[root]):
            root = up
        step += 1
        left = left[left + step < len(cell)]
        left = left[cell[left] == cell[left + step]]
    member = np.flatnonzero(root != np.arange(len(root)))
    return fp[member], fp[root[member]]


def _stars(batches, max_bits: int, rows_at_once: int = ROWS_AT_ONCE):
    """Batches of the links inside cells, from batches of rows sorted by cell."""

    def found(cell: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        fp = fp.view(np.uint64)
        low, one = np.uint64(0x5555555555555555), np.uint64(1)
        half = fp >> one
        point = (fp | half) & low | ((fp & half & low) << one)
        a, b = _pairs(cell, fp, point, max_bits)
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
        )

    cells, prints, rows = [], [], 0
    for batch in batches:
        cells.append(batch.column("cell").to_numpy())
        prints.append(batch.column("fp").to_numpy())
        rows += batch.num_rows
        if rows >= rows_at_once:
            cell, fp = np.concatenate(cells), np.concatenate(prints)
            whole = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on in the next batch
            if whole:
                yield found(cell[:whole], fp[:whole])
            cells, prints, rows = [cell[whole:].copy()], [fp[whole:].copy()], rows - whole
    if rows:
        yield found(np.concatenate(cells), np.concatenate(prints))


def _cells(prints: DataFrame, max_bits: int, blocks: int | None) -> DataFrame:
    """(fp, cell) of every fingerprint in all of its cells."""
    point = embed(F.col("fp"))
    return prints.select("fp", F.explode(F.array(*[
        F.xxhash64(F.lit(i), point.bitwiseAND(F.lit(m)))
        for i, m in enumerate(cell_masks(max_bits, blocks))
    ])).alias("cell"))


def pairs_compared(prints: DataFrame, max_bits: int = MAX_BITS, blocks: int | None = None) -> int:
    """Number of pairs that share a cell, once for each cell; for judging a number of blocks."""
    sizes = _cells(prints, max_bits, blocks).groupBy("cell").agg(F.count("*").alias("n"))
    return sizes.agg(F.coalesce(F.sum(F.expr("n * (n - 1) div 2")), F.lit(0))).first()[0]


def links(prints: DataFrame, max_bits: int = MAX_BITS, blocks: int | None = None) -> DataFrame:
    """(a, b): links that join the same fingerprints ``fp`` as all pairs of at most ``max_bits``.

    ``prints`` holds distinct fingerprints. ``blocks`` are chosen by ``blocks_for`` if not given.
    """
    cells = cut_lineage(_cells(prints, max_bits, blocks or blocks_for(prints, max_bits)), "simhash-cells")
    heavy = cells.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > CELL_ROWS)
    parts = F.coalesce(F.ceil(F.col("n") / CELL_ROWS), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    tasks = (
        cells.join(heavy, "cell", "left").withColumn("parts", parts).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("fp", F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other"))
                .alias("cell"))
        .repartition("cell").sortWithinPartitions("cell")
    )

    return tasks.mapInArrow(lambda batches: _stars(batches, max_bits), "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, blocks: int | None = None,
) -> DataFrame:
    """(id column, fp, component_id) of every row of ``docs``."""
    rows = cut_lineage(fingerprints(docs, id_col, text_col, shingle), "simhash-rows")
    prints = cut_lineage(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-prints")
    roots = components(links(prints.select("fp"), max_bits, blocks))
    named = prints.join(roots, prints.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return (
        rows.join(named.join(ids, "root").select("fp", "component_id"), "fp")
        .select(F.col("id").alias(id_col), "fp", "component_id")
    )


def first_of_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, blocks: int | None = None,
) -> DataFrame:
    """One row of each component, with all columns: that of the least id, null ids last.

    Rows with equal ids are told apart by a 128-bit hash of all columns; of wholly equal rows one stays.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    whole = [F.xxhash64(*columns), F.xxhash64(F.lit(7), *columns)]
    key = F.struct(
        F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), whole[0].alias("h1"),
        whole[1].alias("h2"),
    )
    rows = docs.select(key.alias("key"), F.col(text_col).alias("text"))
    groups = near_duplicates(rows, "key", "text", shingle, max_bits, blocks)
    first = groups.where("key = component_id").select("key.h1", "key.h2").distinct()
    marked = docs.select(F.struct(*columns).alias("row"), whole[0].alias("h1"), whole[1].alias("h2"))
    kept = marked.join(first, ["h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"])
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
