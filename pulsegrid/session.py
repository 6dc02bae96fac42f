"""Session settings and the shared folder used for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the jobs rely on; all of them may be set on a running session.
# Partition sizing is left to AQE: a high initial shuffle count is coalesced to the
# advisory size, and skewed join partitions are split even when that adds a shuffle.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_LOCAL_DIRS: dict[str, str] = {}


def build_session(app_name: str = "pulsegrid", **conf: str) -> SparkSession:
    """Session for a cluster job; the master and memory come from spark-submit."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    for key, value in {**CLUSTER_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Pin the session zone: every stamp in files and tables is UTC wall-clock time."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, visible to every executor.

    Only a local session without that setting gets a temporary folder; on a cluster a
    missing setting is an error, because a machine-local folder would lose data.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        app = context.applicationId
        if app not in _LOCAL_DIRS:
            _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="pulsegrid-")
        base = _LOCAL_DIRS[app]
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Queries of this session drop their shuffle files as they end, not when the driver's memory is cleaned.

    For steps that write their tables one after the other. A lost file is made again by its stage.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def cut_lineage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Used between the rounds of iterative operators: a lost executor re-reads the table
    instead of replaying all rounds, and the next round plans with real sizes. The table is
    deleted when the application ends, as results derived from it may be read until then;
    ``drop_table`` deletes it earlier.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    system, folder = _file_system(df.sparkSession, path)
    system.deleteOnExit(folder)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete a table of ``cut_lineage`` that nothing will read again."""
    for path in {name.rpartition("/")[0] for name in df.inputFiles()}:
        delete_folder(df.sparkSession, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    system, folder = _file_system(spark, path)
    system.delete(folder, True)


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder
