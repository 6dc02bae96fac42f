"""Tables of a remote database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int,
              partitions: int, **options: str) -> DataFrame:
    """A remote table in parallel ranges of a numeric key; credentials come in ``options``.

    Filters and column lists are pushed to the database by Spark.
    """
    return (
        spark.read.format("jdbc").options(url=url, dbtable=table, **options)
        .option("partitionColumn", key).option("lowerBound", lower).option("upperBound", upper)
        .option("numPartitions", partitions).load()
    )
