"""Write classified rows by batch, kind and day, with their time bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.times import file_stamp
from pulsegrid.operators.audit import roll_end

PARTITIONS = ["batch_name", "kind", "day"]


def with_bucket(rows: DataFrame, time: str = "created_at", interval: str = "8 minutes") -> DataFrame:
    """Add ``bucket``: the stamp of the end of the interval the row falls in."""
    return rows.withColumn("bucket", file_stamp(roll_end(F.col(time), interval)))


def write_routed(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Write one folder per (batch, kind, day of the bucket); ``bucket`` stays a column of the rows.

    The rebalance hint groups rows of a folder to avoid one small file per task, and lets
    AQE split a folder that holds much of the data over several tasks and files.
    """
    rows = rows.withColumn("day", F.substring("bucket", 1, 8))
    rows.hint("rebalance", *PARTITIONS).write.mode(mode).partitionBy(*PARTITIONS).parquet(path)
