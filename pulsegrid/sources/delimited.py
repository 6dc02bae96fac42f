"""Reader for ``~``-delimited text files with a header line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.schemas import text_schema

# The file format.
SEPARATOR = "~"
QUOTE = '"'
ESCAPE = "\\"


def read_delimited(spark: SparkSession, path: str | list[str], columns: list[str],
                   compat: bool = False, malformed: str | None = None, max_files: int | None = None) -> DataFrame:
    """Read by position into text columns; the header is skipped, its names are not trusted.

    In this project's files NULL is a bare empty field and an empty text is ``""``.
    ``compat=True`` reads the older files, where NULL is the bare word ``null`` and an empty
    field is an empty text; a quoted ``"null"`` cannot be told apart there.

    ``malformed`` names a further column that holds the whole line where the number of fields is
    wrong, and NULL elsewhere, and adds ``file_name``, the full path; without it such lines are padded or cut to the columns.

    ``max_files`` makes it a stream of the files in ``path`` and the folders below, with so many in
    a micro-batch.
    """
    listed = columns if malformed is None else [*columns, malformed]
    reader = spark.read if max_files is None else spark.readStream.option("maxFilesPerTrigger", max_files).option(
        "recursiveFileLookup", True)
    rows = (
        reader.schema(text_schema(listed))
        .option("sep", SEPARATOR).option("quote", QUOTE).option("escape", ESCAPE)
        .option("header", True).option("enforceSchema", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        # A bare empty field is read as NULL only while the null text differs from "".
        .option("nullValue", "\u0000").option("emptyValue", "")
        .option("columnNameOfCorruptRecord", malformed or "_malformed")
        .csv(path)
    )
    if malformed is not None:
        rows = rows.withColumn("file_name", F.col("_metadata.file_path"))
    if not compat:
        return rows
    values = [F.when(F.coalesce(c, F.lit("")) != "null", F.coalesce(c, F.lit(""))).alias(c) for c in columns]
    return rows.select(*values, *rows.columns[len(columns):])
