"""Folders land whole, in several files, and a stream meets them one by one."""

import pytest
from pyspark.sql import functions as F

from pulsegrid.plans import bindings as B
from pulsegrid.plans.queries import REGISTRY
from pulsegrid.sinks.landing import land
from pulsegrid.sources.landing import stream_folders


def test_folders_land_once_and_are_streamed(spark, tmp_path):
    path, rows = f"{tmp_path}/in", spark.range(100)
    land(rows.filter("id < 60"), path, "0", "id")
    with pytest.raises(RuntimeError):
        land(rows, path, "0", "id")
    met = []
    running = (
        stream_folders(spark, path, rows.schema).writeStream
        .foreachBatch(lambda batch, epoch: met.append(sorted(r.id for r in batch.collect())))
        .option("checkpointLocation", f"{tmp_path}/progress").start()
    )
    try:
        running.processAllAvailable()
        land(rows.filter("id >= 60"), path, "1", "id")
        running.processAllAvailable()
    finally:
        running.stop()
    assert met == [list(range(60)), list(range(60, 100))]


def test_no_task_lands_a_whole_range(spark, tmp_path, monkeypatch):
    """``stream_until_date`` wrote each range of dates by one task."""
    from pyspark.sql import DataFrame

    def refuse(self, *args):
        raise AssertionError("one task would write the whole range")

    monkeypatch.setattr(DataFrame, "coalesce", refuse)
    assert REGISTRY["stream_until_date"](spark, "/root/testdata/sf0.001").count() > 0


def test_statuses_without_retweet_are_dealt_to_all_tasks(spark, tmp_path):
    from test_skew import largest_share, shuffled

    spark.range(4000).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id % 9 AS user_id", "'view' AS event_type",
        "concat('{\"k\": ', id % 100, '}') AS props").write.parquet(f"{tmp_path}/events.parquet")
    rows = shuffled(spark, lambda: largest_share(B.landed_records(spark, str(tmp_path), retweets=True).select(F.col("id"), "retweeted_status")))
    assert rows < 0.3
