"""Length checks and accepted/rejected counts of loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.functions.text import longest_field


def with_length_check(rows: DataFrame, limit: int = S.MAX_FIELD_OCTETS) -> DataFrame:
    """Add ``longest`` (octets of the longest text field) and ``accepted``.

    A row with a longer field is rejected as a whole, never cut.
    """
    texts = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "string"]
    return rows.withColumn("longest", longest_field(texts)).withColumn("accepted", F.col("longest") <= limit)


def source_file() -> Column:
    """Name of the file a row was read from, without its folder."""
    return F.element_at(F.split(F.input_file_name(), "/"), -1)


def load_counts(checked: DataFrame, keys: tuple[str, ...] = ("file_name",)) -> DataFrame:
    """Per file: rows accepted and rejected, and whether the load succeeded (any accepted)."""
    return (
        checked.groupBy(*keys)
        .agg(F.count_if("accepted").alias("accepted_rows"), F.count_if(~F.col("accepted")).alias("rejected_rows"))
        .withColumn("is_loaded", F.col("accepted_rows") > 0)
    )


def roll_end(time: Column, interval: str = "8 minutes") -> Column:
    """End of the epoch-aligned interval a row falls in; names the file bucket."""
    return F.window(time, interval)["end"]
