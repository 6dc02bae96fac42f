"""Keyed state tables: one row per key, in hash buckets of which an epoch rewrites only those that it touches.

A bucket is one folder, and a writer's manifest (see ``state``) names the folder of each bucket. An epoch
reads the buckets of its own keys, merges its rows into them, writes them to new folders and commits all of
them in one step; the other buckets are neither read nor written. Nothing is left to compact.

The manifest also keeps the folders that the last epoch replaced. A replay of that epoch starts from them,
so it gives the same, and readers ``before`` the epoch see the table without it. An earlier epoch that is
repeated is merged into the table as it is, so its ``merge`` must give the same when rows come twice.

Batch runs and streams write one table under different writer names, with manifests of their own. A key may
be in several of them, and readers merge.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.session import cut_lineage, drop_table
from pulsegrid.sinks.state import _latest, _publish, _writers

BUCKETS = 256


def bucket_of(keys: tuple[str, ...], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _folders(found: dict, before: int | None) -> dict[int, str]:
    """Folder of each bucket, as of before an epoch if that is the last one."""
    now = {int(b): f for b, f in found.get("buckets", {}).items()}
    if before is not None and found.get("epoch") == before:
        for bucket, folder in found["before"].items():
            now.pop(int(bucket))
            if folder:
                now[int(bucket)] = folder
    return now


def _read(spark: SparkSession, path: str, folders: list[str], schema: T.StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in folders]).select(schema.names)


def upsert(rows: DataFrame, path: str, writer: str, epoch: int, keys: tuple[str, ...],
           merge: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS) -> None:
    """Merge the rows of an epoch into the table; the number of buckets stays that of the first epoch."""
    spark = rows.sparkSession
    version, found = _latest(spark, path, writer)
    buckets = found.get("count", buckets)
    fresh = cut_lineage(rows.withColumn("bucket", bucket_of(keys, buckets)), "upsert")
    touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]  # at most one per bucket
    base = _folders(found, epoch)
    held = _read(spark, path, [base[b] for b in touched if b in base], rows.schema)
    merged = merge(held.unionByName(fresh.drop("bucket"))).select(rows.columns)
    folder = f"writer={writer}/epoch={epoch}/attempt={uuid.uuid4().hex}"
    if touched:
        placed = merged.withColumn("bucket", bucket_of(keys, buckets))
        placed.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{path}/{folder}")
    after = base | {b: f"{folder}/bucket={b}" for b in touched}
    needed = {base[b] for b in touched if b in base}
    stale = set(_folders(found, None).values()) - set(after.values()) | set(found.get("retired", []))
    content = {
        "count": buckets, "epoch": epoch, "buckets": after, "before": {b: base.get(b) for b in touched},
        "retired": sorted(stale - set(after.values())),
    }
    unused = [f for f in found.get("retired", []) if f not in needed and f not in after.values()]
    content["retired"] = [f for f in content["retired"] if f not in unused]
    _publish(spark, path, writer, version, content, unused)
    drop_table(fresh)


def read_keyed(spark: SparkSession, path: str, schema: T.StructType, writer: str | None = None,
               before: int | None = None, of: DataFrame | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows of all writers; a key comes once for each writer that holds it.

    With ``before``, ``writer``'s table is read as it was before that epoch. With ``of``, only the buckets
    that may hold the ``keys`` of its rows are read.
    """
    folders, wanted = [], {}
    for name in _writers(spark, path):
        found = _latest(spark, path, name)[1]
        held = _folders(found, before if name == writer else None)
        if of is not None:
            count = found["count"]
            if count not in wanted:
                wanted[count] = {r[0] for r in of.select(bucket_of(keys, count)).distinct().collect()}
            held = {b: f for b, f in held.items() if b in wanted[count]}
        folders += held.values()
    return _read(spark, path, folders, schema)
