"""Rows without a key are spread, whatever the join."""

from pyspark.sql import functions as F

from pulsegrid.operators.skew import spread_left_join
from pulsegrid.plans import bindings as B


def shuffled(spark, make):
    """What ``make`` gives while no table is broadcast and no shuffle is coalesced."""
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        return make()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def largest_share(rows):
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def test_spread_left_join_is_a_left_join(spark):
    facts = spark.createDataFrame([(1, 10), (2, None), (3, 10), (4, 99), (None, None), (2, None)], "id bigint, key bigint")
    dim = spark.createDataFrame([(10, "a"), (10, "b"), (None, "c"), (7, "d")], "key bigint, value string")
    want = facts.join(dim, "key", "left").select("id", "key", "value").collect()
    for run in (lambda make: make(), lambda make: shuffled(spark, make)):
        got = run(lambda: spread_left_join(facts, dim, "key", ["id"]).select("id", "key", "value").collect())
        assert sorted(got, key=str) == sorted(want, key=str)


def test_statuses_without_parent_are_dealt_to_all_tasks(spark, tmp_path):
    spark.range(4000).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id % 9 AS user_id", "'view' AS event_type",
        "concat('{\"k\": ', id % 100, '}') AS props").write.parquet(f"{tmp_path}/events.parquet")
    share = shuffled(spark, lambda: largest_share(B.replying_statuses(spark, str(tmp_path))))
    assert share < 0.3
