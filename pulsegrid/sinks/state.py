"""State tables kept by jobs and streams: folders per writer and epoch, and a manifest of the committed ones.

Data of an epoch goes to a new folder; the epoch counts once a new version of its writer's manifest names
that folder. The version is written under another name and renamed, which fails if that version exists, so
a commit is one step: readers see all of it or nothing. A replayed epoch replaces its folder, and a
compaction replaces the folders of many epochs by one, in the same single step, so tables that are
summed never count a row twice. Folders that are no longer named stay until the next commit of
their writer, for readers that listed them before.

Back-fill runs and streams number their epochs independently and share a table under different writer
names; one job at a time writes under a name. A manifest has one entry per epoch that was not compacted.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.session import _file_system, delete_folder

BACKFILL = "backfill"
LIVE = "live"

_MANIFESTS = "_manifests"  # hidden from readers of Parquet folders
_KEEP_VERSIONS = 3


def epoch_path(path: str, writer: str, epoch: int) -> str:
    """The folder of an epoch of a result table, which has no manifest."""
    return f"{path}/writer={writer}/epoch={epoch}"


def _versions(spark: SparkSession, path: str, writer: str) -> list[int]:
    system, folder = _file_system(spark, f"{path}/{_MANIFESTS}/writer={writer}")
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return sorted(int(name) for name in names if name.isdigit())


def _writers(spark: SparkSession, path: str) -> list[str]:
    system, folder = _file_system(spark, f"{path}/{_MANIFESTS}")
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return sorted(name.removeprefix("writer=") for name in names if name.startswith("writer="))


def _latest(spark: SparkSession, path: str, writer: str) -> tuple[int, dict]:
    """Number and content of the newest version of a writer's manifest; version 0 is empty."""
    versions = _versions(spark, path, writer)
    if not versions:
        return 0, {}
    system, file = _file_system(spark, f"{path}/{_MANIFESTS}/writer={writer}/{versions[-1]}")
    stream = system.open(file)
    try:
        return versions[-1], json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def read_manifest(spark: SparkSession, path: str, writer: str) -> dict:
    """The latest version: ``epochs`` (epoch to folder), and ``retired`` folders of the version before."""
    version, found = _latest(spark, path, writer)
    return {"version": version, "epochs": {int(e): f for e, f in found.get("epochs", {}).items()},
            "retired": found.get("retired", [])}


def commit(spark: SparkSession, path: str, writer: str, epoch: int, folder: str, since: int | None = None) -> None:
    """Make ``folder`` the data of ``epoch``, and of all epochs from ``since`` to it if given, in one step."""
    now = read_manifest(spark, path, writer)
    first = epoch if since is None else since
    replaced = {e: f for e, f in now["epochs"].items() if first <= e <= epoch}
    epochs = {e: f for e, f in now["epochs"].items() if e not in replaced} | {epoch: folder}
    content = {"epochs": epochs, "retired": sorted(set(replaced.values()) - {folder})}
    _publish(spark, path, writer, now["version"], content, now["retired"])


def _publish(spark: SparkSession, path: str, writer: str, version: int, content: dict, unused: list[str]) -> None:
    """Make ``content`` the version after ``version`` in one step, then delete the ``unused`` folders."""
    base = f"{path}/{_MANIFESTS}/writer={writer}"
    system, draft = _file_system(spark, f"{base}/draft-{uuid.uuid4().hex}")
    stream = system.create(draft)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    target = _file_system(spark, f"{base}/{version + 1}")[1]
    if system.exists(target) or not system.rename(draft, target):
        raise RuntimeError(f"another job writes {path} as {writer}")
    for old in unused:
        delete_folder(spark, f"{path}/{old}")
        above = _file_system(spark, f"{path}/{old}")[1].getParent()
        while system.exists(above) and above.getName().startswith(("attempt=", "epoch=")) and not any(
                "=" in status.getPath().getName() for status in system.listStatus(above)):
            system.delete(above, True)
            above = above.getParent()
    for old_version in _versions(spark, path, writer)[:-_KEEP_VERSIONS]:
        delete_folder(spark, f"{base}/{old_version}")


def replace_epoch(rows: DataFrame, path: str, writer: str, epoch: int) -> None:
    """Write an epoch of a result table, which has no manifest; a replay replaces it."""
    rows.write.mode("overwrite").parquet(epoch_path(path, writer, epoch))


def write_epoch(rows: DataFrame, path: str, writer: str, epoch: int, partition_by: tuple[str, ...] = ()) -> None:
    """Write and commit an epoch; a replay replaces it."""
    folder = f"writer={writer}/epoch={epoch}/attempt={uuid.uuid4().hex}"
    rows.write.partitionBy(*partition_by).parquet(f"{path}/{folder}")
    commit(rows.sparkSession, path, writer, epoch, folder)


def read_epochs(spark: SparkSession, path: str, schema: T.StructType, writer: str | None = None,
                before: int | None = None, only: int | None = None, after: int = -1) -> DataFrame:
    """The rows of all committed epochs; empty when there are none yet.

    With ``before``, epochs of ``writer`` from that one on are left out, so that a replayed
    epoch does not see its own results. ``only`` reads that epoch of ``writer``; ``after`` leaves out
    its epochs up to that one.
    """
    if only is not None:
        return _read(spark, path, [read_manifest(spark, path, writer)["epochs"][only]], schema)
    folders = []
    for name in _writers(spark, path):
        epochs = read_manifest(spark, path, name)["epochs"]
        folders += [
            f for e, f in epochs.items() if name != writer or (e > after and (before is None or e < before))
        ]
    if not folders:
        return spark.createDataFrame([], schema)
    return _read(spark, path, folders, schema)


def _read(spark: SparkSession, path: str, folders: list[str], schema: T.StructType) -> DataFrame:
    found = [T.StructField(n, T.StringType()) for n in ("writer", "epoch", "attempt")]
    reader = spark.read.schema(T.StructType([*schema.fields, *found])).option("basePath", path)
    return reader.parquet(*[f"{path}/{f}" for f in folders]).drop("writer", "epoch", "attempt")


def compact_epochs(spark: SparkSession, path: str, schema: T.StructType, writer: str, upto: int,
                   merge: Callable[[DataFrame], DataFrame]) -> None:
    """Merge the epochs of ``writer`` up to ``upto`` into that one.

    The merged folder replaces the others when it is committed; a job that ends before leaves
    the table as it was, and a repeated call gives the same.
    """
    now = read_manifest(spark, path, writer)
    epochs = {e: f for e, f in now["epochs"].items() if e <= upto}
    if not epochs or list(epochs) == [upto]:
        if now["retired"]:  # nothing to merge: only delete what an earlier call replaced
            last = max(now["epochs"])
            commit(spark, path, writer, last, now["epochs"][last])
        return
    folder = f"writer={writer}/epoch={upto}/attempt={uuid.uuid4().hex}"
    merge(_read(spark, path, list(epochs.values()), schema)).write.parquet(f"{path}/{folder}")
    commit(spark, path, writer, upto, folder, since=min(epochs))


def replace_table(rows: DataFrame, path: str, writer: str) -> None:
    """A new version of a table that is rewritten as a whole; readers of the version before go on."""
    versions = read_manifest(rows.sparkSession, path, writer)["epochs"]
    epoch = max(versions, default=-1) + 1
    folder = f"writer={writer}/epoch={epoch}/attempt={uuid.uuid4().hex}"
    rows.write.parquet(f"{path}/{folder}")
    commit(rows.sparkSession, path, writer, epoch, folder, since=min(versions, default=epoch))


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The latest version of a table of ``replace_table``, or a plain Parquet table."""
    if _writers(spark, path):
        return read_epochs(spark, path, schema)
    return spark.read.schema(schema).parquet(path)
