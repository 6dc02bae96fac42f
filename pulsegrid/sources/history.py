"""The history of landed statuses, laid out so that a back-fill reads only what it needs.

Every landing is an epoch of a state table, so its files appear in one step, and its rows lie in folders by
user bucket, in order of time within a file. A run then names the epochs it has not read and the buckets
of the users it wants: other folders are neither listed nor opened, and a date range skips row groups.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.schemas import LANDED_STATUS_DDL
from pulsegrid.sinks.state import read_epochs, read_manifest, write_epoch

BUCKETS = 64
LANDING = "landing"


@dataclass(frozen=True)
class History:
    """Landed statuses below ``path``; the number of buckets belongs to the folder and never changes."""

    path: str
    buckets: int = BUCKETS

    def bucket(self, name: Column) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(self.buckets)).cast("int")

    def append(self, landed: DataFrame, epoch: int) -> None:
        """Add a landing; repeating its number replaces it."""
        rows = landed.withColumn("bucket", self.bucket(F.col("user.screen_name")))
        ordered = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "created_at")
        write_epoch(ordered, self.path, LANDING, epoch, ("bucket",))

    def last(self, spark: SparkSession) -> int:
        """The number of the latest landing, -1 before the first."""
        return max(read_manifest(spark, self.path, LANDING)["epochs"], default=-1)

    def rows(self, spark: SparkSession, after: int = -1, upto: int | None = None,
             users: DataFrame | None = None) -> DataFrame:
        """The statuses of the landings behind ``after`` up to ``upto``, of the buckets of ``users`` (screen_name)."""
        schema = T.DataType.fromDDL(LANDED_STATUS_DDL)
        parted = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
        found = read_epochs(spark, self.path, parted, LANDING, None if upto is None else upto + 1, after=after)
        if users is not None:
            wanted = users.select(self.bucket(F.col("screen_name")).alias("bucket")).distinct()
            found = found.filter(F.col("bucket").isin([r.bucket for r in wanted.collect()]))  # one row per bucket
        return found.select(schema.fieldNames())
