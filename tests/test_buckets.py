"""Keyed tables: only touched buckets are rewritten, replays and readers before an epoch see the right rows."""

import pytest
from pyspark.sql import functions as F

from pulsegrid.sinks import buckets, state

KEYS = ("batch", "name")
DDL = "batch string, name string, n bigint"


def total(rows):
    return rows.groupBy(*KEYS).agg(F.sum("n").alias("n"))


def put(spark, path, epoch, rows, writer="live"):
    buckets.upsert(spark.createDataFrame(rows, DDL), path, writer, epoch, KEYS, total, buckets=8)


def held(spark, path, **more):
    schema = spark.createDataFrame([], DDL).schema
    return sorted(map(tuple, buckets.read_keyed(spark, path, schema, **more).collect()), key=str)


def test_an_epoch_rewrites_its_buckets_only(spark, tmp_path):
    path = f"{tmp_path}/table"
    assert held(spark, path) == []
    many = [("b", f"u{i}", 1) for i in range(40)]
    put(spark, path, 0, many)
    before = state._latest(spark, path, "live")[1]["buckets"]
    put(spark, path, 1, [("b", "u3", 5), ("b", "u3", 1)])
    after = state._latest(spark, path, "live")[1]["buckets"]
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    want = sorted((b, u, 7 if u == "u3" else n) for b, u, n in many)
    assert held(spark, path) == want
    assert held(spark, path, writer="live", before=1) == sorted(many)
    asked = spark.createDataFrame([("b", "u3", 0)], DDL)
    some = held(spark, path, of=asked, keys=KEYS)
    assert ("b", "u3", 7) in some and len(some) < 40


def test_a_replay_starts_from_what_the_epoch_found(spark, tmp_path):
    path = f"{tmp_path}/table"
    put(spark, path, 0, [("b", "x", 1), ("b", "y", 1)])
    for rows in ([("b", "x", 4), ("b", "new", 9)], [("b", "x", 4)], [("b", "x", 4), ("b", "z", 2)]):
        put(spark, path, 1, rows)
        assert held(spark, path, writer="live", before=1) == [("b", "x", 1), ("b", "y", 1)]
    assert held(spark, path) == [("b", "x", 5), ("b", "y", 1), ("b", "z", 2)]
    for epoch in (2, 3):
        put(spark, path, epoch, [])
    assert held(spark, path) == [("b", "x", 5), ("b", "y", 1), ("b", "z", 2)]
    files = spark.read.schema(DDL).option("recursiveFileLookup", "true").parquet(f"{path}/writer=live")
    assert files.count() == 3  # replaced folders are gone


def test_an_epoch_that_stops_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/table"
    put(spark, path, 0, [("b", "x", 1)])
    with monkeypatch.context() as broken:
        broken.setattr(buckets, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            put(spark, path, 1, [("b", "x", 1)])
    assert held(spark, path) == [("b", "x", 1)]
    put(spark, path, 1, [("b", "x", 1)])
    assert held(spark, path) == [("b", "x", 2)]


def test_writers_share_a_table(spark, tmp_path):
    path = f"{tmp_path}/table"
    put(spark, path, 0, [("b", "x", 1), (None, "n", 3)], "backfill")
    put(spark, path, 0, [("b", "x", 2)])
    assert held(spark, path) == sorted([("b", "x", 1), ("b", "x", 2), (None, "n", 3)], key=str)
    assert held(spark, path, writer="backfill", before=0) == [("b", "x", 2)]
