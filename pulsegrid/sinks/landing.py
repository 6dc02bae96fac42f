"""Land rows for a file stream in folders, each of which it meets whole or not at all."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pulsegrid.session import _file_system


def land(rows: DataFrame, path: str, name: str, key: str) -> None:
    """Write ``rows`` as the folder ``name`` below ``path``, in files of even size dealt by ``key``.

    All tasks write beside ``path``; the finished folder is renamed into place in one step (as on HDFS and local
    disks), so that a stream that reads the folders below ``path`` never takes a part of it.
    """
    spark, draft = rows.sparkSession, f"{path}-landing/{name}"
    rows.hint("rebalance", key).write.parquet(draft)
    system, folder = _file_system(spark, path)
    system.mkdirs(folder)
    target = _file_system(spark, f"{path}/{name}")[1]
    if system.exists(target) or not system.rename(_file_system(spark, draft)[1], target):
        raise RuntimeError(f"{path}/{name} has landed before")
