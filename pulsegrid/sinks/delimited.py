"""Writer for ``~``-delimited text files with a header line in every file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.text import quoted_field
from pulsegrid.sources.delimited import SEPARATOR

_ROW_IN_PARTITION = (1 << 33) - 1


def delimited_line(columns: list[str]) -> Column:
    """All fields of a row as one line; line breaks inside fields become blanks."""
    return F.concat_ws(SEPARATOR, *[quoted_field(F.col(c).cast("string")) for c in columns])


def write_delimited(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One file per partition, each starting with the header.

    The low 33 bits of ``monotonically_increasing_id`` number the rows of a partition, so its
    first row carries the header line along; rows need no extra shuffle or Python step.
    """
    header = SEPARATOR.join(rows.columns)
    first = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_IN_PARTITION)) == 0
    line = delimited_line(rows.columns)
    rows.select(
        F.when(first, F.concat(F.lit(header + "\n"), line)).otherwise(line).alias("value")
    ).write.mode(mode).text(path)
