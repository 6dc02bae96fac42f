"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.session import cut_lineage, drop_table


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step; ``edges`` are distinct (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = (
        both.where("v > u").join(least, "u").where("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(low, "u")
    return (
        moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(low.select("u", F.col("m").alias("v")))
        .distinct()
    )


def _state(edges: DataFrame):
    return edges.agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
        F.bit_xor(F.xxhash64("v", "u")).alias("y"),
    ).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b) of longs.

    The root is the least node of the component. Each round moves every node's neighbours to its
    least neighbour, so paths shrink to stars in a logarithmic number of rounds; the rounds go to
    tables in the shared folder. Minima are combined before the shuffle and joins may split a
    node with many neighbours. Self loops and repeated edges are allowed.
    """
    work = cut_lineage(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "stars",
    )
    before = _state(work)
    while before.n:
        after = cut_lineage(_stars(work), "stars")
        state = _state(after)
        drop_table(work)
        work = after
        if state == before:
            break
        before = state
    roots = work.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return work.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
