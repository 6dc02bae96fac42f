"""Exact top-k search by inner product, branch and bound over a vertical layout.

Components become whole numbers, so scores are exact. Vectors are packed in blocks of some thousand rows that
hold one dimension after the other. For a query the dimensions are taken eight at a time, those with
most of the query's mass (sum of squares) first. After each step a candidate's score is at most its
partial score plus the product of the norms that remain on both sides (Cauchy-Schwarz); candidates that
cannot reach the query's k-th best score so far are dropped, and the survivors are compacted before the next
dimensions are read. A candidate that may still tie is kept, as ties go to the smaller id.

The packed rows are written once to the shared folder. Queries are taken in passes of at most ``PASS_VALUES``
numbers, the size of what is broadcast; in a pass every task goes through its blocks and keeps the k best
rows of each query, which are merged by query afterwards. Passes are independent, their results are appended
to one table.

Defined results: null vectors, and vectors that hold a null or a component that is not finite, take no part;
vectors meet only vectors with as many components (none at all: score zero); an empty table, or one without
queries, gives no rows. A row's own copies, the rows with its id, are no candidates; a repeated query row
gives its results again, and repeated candidates count each. A null id is no query, and as a candidate
ranks behind equal scores. Scores that may not fit 64 bits raise an OverflowError. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.session import cut_lineage, shared_dir

SCALE = 256
TOP = 5
STEP = 8  # dimensions between two compactions
BLOCK_ROWS = 8192
BLOCK_VALUES = 1 << 20
PASS_VALUES = 1 << 22
FIRST_ROWS = 256  # searched first in a block, so that the others meet a bound

BLOCK_SCHEMA = "dims int, ids binary, absent binary, kind string, data binary"


@dataclass
class Block:
    """Rows of equal size: ``columns[d]`` holds dimension ``d`` of all of them."""

    ids: np.ndarray
    absent: np.ndarray  # rows without id
    columns: np.ndarray

    @classmethod
    def read(cls, dims: int, ids: bytes, absent: bytes, kind: str, data: bytes) -> Block:
        numbers = np.frombuffer(ids, dtype=np.int64)
        return cls(
            numbers, np.frombuffer(absent, dtype=bool), np.frombuffer(data, dtype=kind).reshape(dims, len(numbers))
        )


def _whole(vectors: pa.Array, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of whole numbers) of the valid vectors, one pair per vector size."""
    sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    flat = pc.fill_null(vectors.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    valid = vectors.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[ends - sizes])
    for size in np.unique(sizes[valid]):
        rows = np.flatnonzero(valid & (sizes == size))
        scaled = np.floor(flat[(ends - sizes)[rows][:, None] + np.arange(size)] * scale)
        if scaled.size and np.abs(scaled).max() >= 2.0 ** 62:
            raise OverflowError("a component is too large for whole numbers of 64 bits")
        yield rows, scaled.astype(np.int64)


def packed(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """The valid vectors as blocks of bounded size in vertical layout."""

    def block(ids: list, absent: list, rows: list) -> pa.RecordBatch:
        matrix = np.concatenate(rows)
        top = np.abs(matrix).max(initial=0)
        kind = next((k for k in ("<i2", "<i4") if top <= np.iinfo(k).max), "<i8")
        return pa.RecordBatch.from_arrays(
            [pa.array([matrix.shape[1]], pa.int32()), pa.array([np.concatenate(ids).tobytes()], pa.binary()),
             pa.array([np.concatenate(absent).tobytes()], pa.binary()), pa.array([kind]),
             pa.array([np.ascontiguousarray(matrix.T).astype(kind).tobytes()], pa.binary())],
            names=["dims", "ids", "absent", "kind", "data"],
        )

    def over(batches):
        waiting: dict[int, tuple[list, list, list]] = {}
        for batch in batches:
            known = batch.column("id")
            ids = pc.fill_null(known, np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
            absent = known.is_null().to_numpy(zero_copy_only=False)
            for rows, matrix in _whole(batch.column("vector"), scale):
                dims = matrix.shape[1]
                most = max(1, min(BLOCK_ROWS, BLOCK_VALUES // max(1, dims)))
                held = waiting.setdefault(dims, ([], [], []))
                at = 0
                while at < len(rows):
                    room = most - sum(map(len, held[0]))
                    part = rows[at:at + room]
                    for kept, new in zip(held, (ids[part], absent[part], matrix[at:at + room])):
                        kept.append(new)
                    at += len(part)
                    if sum(map(len, held[0])) == most:
                        yield block(*held)
                        held = waiting[dims] = ([], [], [])
        for held in waiting.values():
            if held[0]:
                yield block(*held)

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    return rows.mapInArrow(over, BLOCK_SCHEMA)


def _spans(dims: int) -> list[slice]:
    return [slice(d, min(d + STEP, dims)) for d in range(0, dims, STEP)] or [slice(0, 0)]


def _masses(columns: np.ndarray) -> np.ndarray:
    """Sum of squares of every row within each span of dimensions."""
    return np.stack([(columns[s].astype(np.float64) ** 2).sum(axis=0) for s in _spans(len(columns))])


class Search:
    """The best candidates so far of some queries of equal size."""

    def __init__(self, queries: Block, top: int):
        self.top, self.queries = top, queries
        self.vectors = np.ascontiguousarray(queries.columns.T.astype(np.int64))
        mass = _masses(queries.columns).T
        self.order = np.argsort(-mass, axis=1, kind="stable")
        sorted_mass = np.take_along_axis(mass, self.order, axis=1)
        # mass of the query in the spans behind the first, the second, ...
        self.left = np.maximum(sorted_mass.sum(axis=1, keepdims=True) - np.cumsum(sorted_mass, axis=1), 0)
        self.total = mass.sum(axis=1)
        none = np.zeros(0, dtype=np.int64)
        self.best = [(none, none, none.astype(bool))] * len(queries.ids)  # scores, ids, absent

    def add(self, block: Block) -> None:
        """Let the rows of a block compete."""
        for first, last in ((0, FIRST_ROWS), (FIRST_ROWS, len(block.ids))):
            if first < len(block.ids):
                self._add(block.ids[first:last], block.absent[first:last], block.columns[:, first:last])

    def _add(self, ids: np.ndarray, absent: np.ndarray, columns: np.ndarray) -> None:
        mass = _masses(columns)
        total = mass.sum(axis=0)
        largest = float(np.sqrt(total.max(initial=0.0)) * np.sqrt(self.total.max(initial=0.0)))
        if largest >= 2.0 ** 62:
            raise OverflowError("scores may not fit 64 bits")
        # partial scores stay below the product of the norms: doubles are exact up to 2**52
        kind = np.float64 if largest < 2.0 ** 52 else np.int64
        columns, vectors = columns.astype(kind), self.vectors.astype(kind)
        spans = _spans(len(columns))
        for q, best in enumerate(self.best):
            bound = best[0][-1] if len(best[0]) == self.top else None
            at, rest, score = None, total, np.zeros(len(ids), dtype=kind)
            for step, span in enumerate(self.order[q].tolist()):
                part = columns[spans[span]] if at is None else columns[spans[span]][:, at]
                score = score + vectors[q, spans[span]] @ part
                rest = rest - (mass[span] if at is None else mass[span][at])
                if bound is None:
                    continue
                reach = score + np.sqrt(np.maximum(rest, 0) * self.left[q, step])
                # one is more than the rounding of bounds up to 2**52; larger ones get a share of their size
                alive = np.flatnonzero(reach + 1 + largest * 1e-12 >= bound)
                if len(alive) < len(score):
                    at = alive if at is None else at[alive]
                    score, rest = score[alive], rest[alive]
                if not len(alive):
                    break
            if len(score):
                at = np.arange(len(ids)) if at is None else at
                self._merge(q, score.astype(np.int64), ids[at], absent[at])

    def _merge(self, q: int, scores: np.ndarray, ids: np.ndarray, absent: np.ndarray) -> None:
        other = absent | (ids != self.queries.ids[q])
        old = self.best[q]
        scores, ids, absent = (
            np.concatenate([a, b[other]]) for a, b in zip(old, (scores, ids, absent))
        )
        by = np.lexsort((ids, absent, -scores))[:self.top]
        self.best[q] = scores[by], ids[by], absent[by]


FOUND_SCHEMA = "pass int, query int, query_id long, candidate_id long, score long"


def _pass(layout: DataFrame, queries: list[tuple[int, Block]], number: int, top: int) -> DataFrame:
    """The best rows of every query within each task; ``queries`` are blocks with their first query's number."""
    context = layout.sparkSession.sparkContext
    sent = context.broadcast(queries)

    def over(batches):
        searches = [(first, Search(block, top)) for first, block in sent.value]
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.read(**row)
                for _, search in searches:
                    if search.vectors.shape[1] == len(block.columns):
                        search.add(block)
        for first, search in searches:
            size = np.array([len(s) for s, _, _ in search.best], dtype=np.int64)
            scores, ids, absent = (np.concatenate(x) for x in zip(*search.best))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), number), pa.int32()),
                 pa.array(np.repeat(first + np.arange(len(size)), size), pa.int32()),
                 pa.array(np.repeat(search.queries.ids, size), pa.int64()),
                 pa.array(ids, pa.int64(), mask=absent), pa.array(scores, pa.int64())],
                names=["pass", "query", "query_id", "candidate_id", "score"],
            )

    return layout.mapInArrow(over, FOUND_SCHEMA)


def _passes(blocks: DataFrame, limit: int) -> Iterator[list[tuple[int, Block]]]:
    """The packed queries in lists of at most ``limit`` numbers, or of one block."""
    held, values, first = [], 0, 0
    for row in blocks.toLocalIterator():
        block = Block.read(*row)
        size = max(block.columns.size, len(block.ids))
        if held and values + size > limit:
            yield held
            held, values, first = [], 0, 0
        held.append((first, block))
        values, first = values + size, first + len(block.ids)
    if held:
        yield held


def top_matches(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    top: int = TOP, scale: int = SCALE, pass_values: int = PASS_VALUES,
) -> DataFrame:
    """(query_id, rank, <id column>, score): the ``top`` other rows of greatest inner product for each query."""
    spark = vectors.sparkSession
    layout = cut_lineage(packed(vectors, id_col, vector_col, scale), "vector-blocks")
    asked = vectors.filter(is_query & F.col(id_col).isNotNull())
    queries = cut_lineage(packed(asked, id_col, vector_col, scale), "query-blocks")
    path = shared_dir(spark, "top-matches")
    spark.createDataFrame([], FOUND_SCHEMA).write.parquet(path)
    for number, held in enumerate(_passes(queries, pass_values)):
        _pass(layout, held, number, top).write.mode("append").parquet(path)
    found = spark.read.schema(FOUND_SCHEMA).parquet(path)
    order = Window.partitionBy("pass", "query").orderBy(F.desc("score"), F.asc_nulls_last("candidate_id"))
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        .select("query_id", "rank", F.col("candidate_id").alias(id_col), "score")
    )
