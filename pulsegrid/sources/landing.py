"""Landed status records, as a table for the back-fill and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.schemas import LANDED_STATUS_DDL


def read_landed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """All landed statuses; filters on users, ids and dates reach a Parquet scan."""
    return spark.read.schema(LANDED_STATUS_DDL).format(fmt).load(path)


def stream_landed(spark: SparkSession, path: str, fmt: str = "json", max_files: int = 1000) -> DataFrame:
    """Statuses as they land; each new file is read once."""
    return (
        spark.readStream.schema(LANDED_STATUS_DDL).format(fmt)
        .option("maxFilesPerTrigger", max_files).load(path)
    )


def stream_table(spark: SparkSession, folder: str, file_name: str, schema, max_files: int = 1000) -> DataFrame:
    """A Parquet file of a folder as a file stream."""
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", file_name)
        .option("maxFilesPerTrigger", max_files).parquet(folder)
    )


def stream_folders(spark: SparkSession, path: str, schema) -> DataFrame:
    """A stream of the folders landed below ``path`` (see ``sinks.landing``), each in one micro-batch."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(path)
