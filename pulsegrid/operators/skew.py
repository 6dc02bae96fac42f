"""Joins of a large, possibly very skewed table to a table with unique keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The largest keys above HOT_ROWS are spread here, a list that is small enough to broadcast. Keys
# beyond the list hold less than 1/MAX_HOT_KEYS of the rows each; Spark's skew join splits the
# partitions of those that are still large (adaptive execution, on in CLUSTER_CONF).
HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 1000
SALTS = 512

# Up to this many counted rows of a few ids each are broadcast (some tens of megabytes).
BROADCAST_ROWS = 500_000


def hot_keys(facts: DataFrame, keys: str | list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The largest keys with more than ``hot_rows`` rows, at most ``MAX_HOT_KEYS`` of them.

    Reads only the key columns; the counts are combined map-side.
    """
    keys = [keys] if isinstance(keys, str) else keys
    counts = facts.select(*keys).dropna().groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") > hot_rows).orderBy(F.desc("n"), *keys).limit(MAX_HOT_KEYS).select(*keys)


def lookup_join(facts: DataFrame, dim: DataFrame, keys: str | list[str], how: str = "left",
                salts: int = SALTS, hot_rows: int = HOT_ROWS, count_dim: bool = True) -> DataFrame:
    """``facts`` joined to ``dim`` on ``keys``, which are unique in ``dim``.

    Rows of hot keys are spread over ``salts`` partitions, and only the few matching ``dim``
    rows are repeated once per salt; all other rows join on the plain key. Fact rows with a
    NULL key are spread too, as they match nothing. Every fact row meets exactly the same
    ``dim`` row as in the plain join. When ``dim`` turns out small, Spark broadcasts it.
    A narrow ``dim`` is counted first (up to the bound only) and broadcast if it has few rows:
    then ``facts`` are neither counted nor shuffled. A streaming ``facts`` is joined plainly:
    its micro-batches are small.
    """
    keys = [keys] if isinstance(keys, str) else keys
    if facts.isStreaming:
        return facts.join(dim, keys, how)
    if count_dim and is_narrow(dim) and dim.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return facts.join(F.broadcast(dim), keys, how)
    hot = F.broadcast(hot_keys(facts, keys, hot_rows).withColumn("is_hot", F.lit(True)))
    row_salt = F.pmod(F.xxhash64(*_hashable(facts)), F.lit(salts)).cast("int")
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    salted_facts = (
        facts.join(hot, keys, "left")
        .withColumn("salt", F.when(F.col("is_hot") | has_null, row_salt).otherwise(0))
        .drop("is_hot")
    )
    all_salts = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_dim = (
        dim.join(hot, keys, "left")
        .withColumn("salt", F.explode(F.when(F.col("is_hot"), all_salts).otherwise(F.array(F.lit(0)))))
        .drop("is_hot")
    )
    return salted_facts.join(salted_dim, [*keys, "salt"], how).drop("salt")


def spread_left_join(facts: DataFrame, dim: DataFrame, key: str, by: list[str]) -> DataFrame:
    """Left join of ``facts`` that often have no ``key``; keys of ``dim`` may repeat.

    Rows with a NULL key match nothing, and a plain join would bring all of them to one task: they are dealt by
    a hash of the ``by`` columns instead. All others meet under their key. Nothing is counted before.
    """
    spread = F.when(F.col(key).isNull(), F.xxhash64(*by)).otherwise(F.xxhash64(key))
    keyed = dim.withColumn("_spread", F.xxhash64(key))
    return facts.withColumn("_spread", spread).join(keyed, [key, "_spread"], "left").drop("_spread")


def is_narrow(df: DataFrame) -> bool:
    """A few columns of flat types: a row takes some tens of bytes."""
    return len(df.columns) <= 6 and len(_hashable(df)) == len(df.columns)


def lookup_counted(facts: DataFrame, rows: int, dim: DataFrame, key: str) -> DataFrame:
    """Inner lookup of narrow, written ``facts`` whose number of ``rows`` was counted.

    Few rows are broadcast, so that ``dim`` is scanned but not shuffled; more go through
    ``lookup_join``.
    """
    if rows <= BROADCAST_ROWS:
        return dim.join(F.broadcast(facts), key)
    return lookup_join(facts, dim, key, "inner")


def _hashable(df: DataFrame) -> list[str]:
    """Columns that spread the rows of one key; nested ones add cost, not spread."""
    flat = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    return flat or df.columns
