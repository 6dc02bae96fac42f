"""Batch definitions: which users to watch, in which date range, and how deep to follow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.text import split_list
from pulsegrid.schemas import BATCH_DEFINITION_KEYS, text_schema


def read_batch_definitions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One JSON object per file, all values text."""
    return spark.read.schema(text_schema(BATCH_DEFINITION_KEYS)).option("multiLine", True).json(path)


def parse_batch_definitions(texts: DataFrame, column: str) -> DataFrame:
    """The same from a column that holds one JSON definition per row."""
    schema = text_schema(BATCH_DEFINITION_KEYS)
    return texts.select(F.from_json(column, schema).alias("d")).select("d.*")


def definition_text(keys: dict[str, Column]) -> Column:
    """A definition as pretty-printed JSON, as written back after a load."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in keys.items()]), {"pretty": "true"})


def batch_settings(definitions: DataFrame) -> DataFrame:
    """Typed settings; empty dates are open bounds. Each definition names its own date format."""
    def bound(key: str) -> Column:
        return F.try_to_timestamp(F.nullif(F.col(key), F.lit("")), F.col("dateFormat"))

    return definitions.select(
        F.col("batchName").alias("batch_name"),
        bound("batchRunStartTime").alias("start_time"),
        bound("batchCutOffMinDate").alias("cutoff_min"),
        bound("batchCutOffMaxDate").alias("cutoff_max"),
        (F.lower("batchTrackStream") == "true").alias("track_stream"),
        F.expr("try_cast(batchRefLevel AS int)").alias("ref_level"),
    )


def watched_users(definitions: DataFrame) -> DataFrame:
    """(batch_name, screen_name) in list order of each definition; empty names are dropped."""
    return definitions.select(
        F.col("batchName").alias("batch_name"),
        F.posexplode(split_list(F.col("userNames"), ",")).alias("position", "screen_name"),
    )
