"""Load delimited files into typed Parquet tables, once per file, with counts per file."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.operators.audit import load_counts, with_length_check
from pulsegrid.session import cut_lineage, drop_table
from pulsegrid.sinks.state import replace_epoch
from pulsegrid.sources.delimited import read_delimited

_LAYOUTS = {S.KIND_STATUS: S.wide_status_columns, S.KIND_USER: S.wide_user_columns}


def kind_of_path(path: str) -> str:
    """Target table of a file by its name; rejected files and unknown names are errors."""
    name = path.upper()
    if "REJECTED" in name:
        raise ValueError(f"rejected rows are never loaded: {path}")
    for kind in (S.KIND_STATUS, S.KIND_USER):
        if kind in name:
            return kind
    raise ValueError(f"no target table for {path}")


MALFORMED = "wrong number of fields"
TOO_LONG = "field too long"


FILES_AT_ONCE = 1000
LOAD, RETRY = "load", "retry"
_AUDIT = "file_id string, file_name string, accepted_rows bigint, rejected_rows bigint, is_loaded boolean, loaded_at timestamp"


def checked_rows(lines: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of files with ``reason`` for those to reject, ``longest`` and ``accepted``."""
    sized = with_length_check(lines.select(*columns, F.struct("malformed", "file_name").alias("line")))
    reason = F.when(F.col("line.malformed").isNotNull(), MALFORMED).when(~F.col("accepted"), TOO_LONG)
    return sized.select(
        *columns, "longest", reason.alias("reason"), reason.isNull().alias("accepted"),
        F.col("line.malformed").alias("malformed"), F.col("line.file_name").alias("file_name"),
        F.md5("line.file_name").alias("file_id"),
    )


def read_audit(spark: SparkSession, audit_path: str) -> DataFrame:
    """The counts of all loads, with the ``writer`` and ``epoch`` that wrote them; empty before the first one."""
    schema = spark.createDataFrame([], f"{_AUDIT}, writer string, epoch bigint").schema
    try:
        return spark.read.schema(schema).parquet(audit_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def load_files(spark: SparkSession, path: str, table_path: str, audit_path: str,
               columns: list[str] | None = None, compat: bool = False,
               reject_path: str | None = None) -> DataFrame:
    """Append accepted rows of new files to the table and their counts to the audit table.

    New files are found by a file stream whose checkpoint lies beside the audit table, so neither the
    names of all files nor those of old ones come to the driver, and a file is known by its full path: equal
    names in different folders are different files. Rejected rows (wrong number of fields, or a field over the limit)
    go to the reject table with their file and reason, ``<table>-rejects`` unless given.

    A micro-batch writes its rows and then its counts into folders of its epoch, which a repetition
    replaces, so a load that is repeated after a failure adds nothing twice. Files without any accepted row
    stay pending and are read again by the next load. Returns the counts of this load.
    """
    columns = columns or _LAYOUTS[kind_of_path(path)]()
    rejects = reject_path or f"{table_path.rstrip('/')}-rejects"
    written = []

    def store(lines: DataFrame, writer: str, epoch: int) -> None:
        checked = cut_lineage(checked_rows(lines, columns), "load-rows")
        replace_epoch(checked.filter("accepted").select(*columns, "file_name"), table_path, writer, epoch)
        values = F.to_json(F.struct(*[F.col(c) for c in columns]))
        rejected = checked.filter(~F.col("accepted")).select(
            "file_name", "reason", "longest", F.coalesce("malformed", values).alias("row"), "file_id"
        )
        # faulty files only: what a file was rejected for is replaced when it is read again
        (
            rejected.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("file_id").parquet(rejects)
        )
        counts = load_counts(checked, ("file_id", "file_name")).withColumn("loaded_at", F.current_timestamp())
        replace_epoch(counts, audit_path, writer, epoch)
        drop_table(checked)
        written.append((writer, epoch))

    audit = read_audit(spark, audit_path)
    pending = audit.groupBy("file_name").agg(F.bool_or("is_loaded").alias("is_loaded")).filter("NOT is_loaded")
    tried = cut_lineage(pending.select("file_name"), "pending-files")
    last = audit.filter(F.col("writer") == RETRY).agg(F.max("epoch")).first()[0]
    epoch = 0 if last is None else last + 1
    names: list[str] = []
    for row in tried.toLocalIterator():
        names.append(row.file_name)
        if len(names) == FILES_AT_ONCE:
            store(read_delimited(spark, names, columns, compat, "malformed"), RETRY, epoch)
            names, epoch = [], epoch + 1
    if names:
        store(read_delimited(spark, names, columns, compat, "malformed"), RETRY, epoch)

    lines = read_delimited(spark, path, columns, compat, "malformed", FILES_AT_ONCE)
    (
        lines.writeStream.foreachBatch(lambda rows, number: store(rows, LOAD, number))
        .option("checkpointLocation", f"{audit_path.rstrip('/')}-progress").trigger(availableNow=True)
        .start().awaitTermination()
    )
    own = [(F.col("writer") == w) & (F.col("epoch") == e) for w, e in written]
    found = read_audit(spark, audit_path).filter(reduce(lambda a, b: a | b, own, F.lit(False)))
    return cut_lineage(found.drop("writer", "epoch"), "load-counts")
