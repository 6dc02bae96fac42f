"""Plans keep the properties they are written for."""

import pytest

from pulsegrid.operators import hashtags, patterns, registry
from pulsegrid.plans import bindings as B
from pulsegrid.plans.queries import REGISTRY
from pulsegrid.session import shared_dir

SF = "/root/testdata/sf0.001"
WRITING = {"delimited_roundtrip", "routed_write", "retweet_lineage", "retweet_unroll", "reply_threads",
           "embedded_unroll", "load_runs", "load_by_name", "backfill_runs", "handover", "rollup_client_country_hour"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in REGISTRY if n not in WRITING and not n.startswith("stream_")])
def test_no_product_and_no_python_step(spark, name):
    text = plan(REGISTRY[name](spark, SF))
    for step in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Arrow"):
        assert step not in text


def test_date_range_reaches_the_scan(spark):
    text = plan(REGISTRY["cutoff_filter"](spark, SF))
    assert "GreaterThanOrEqual(ts" in text and "LessThanOrEqual(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_unused_columns_are_not_read(spark):
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan(REGISTRY["user_watermarks"](spark, SF))


def test_rankings_limit_before_the_shuffle(spark):
    for df in (hashtags.top_hashtags(B.statuses(spark, SF)), REGISTRY["user_first_seen"](spark, SF)):
        text = plan(df)
        assert "WindowGroupLimit" in text and "Partial" in text


def test_matching_does_not_shuffle_statuses(spark):
    text = plan(patterns.match_patterns(B.texts(spark, SF), B.keywords(spark)))
    main = text.split("Subquery")[0]
    assert "Exchange" not in main


def test_registry_builds_no_lists(spark):
    text = plan(registry.register_users(B.statuses(spark, SF)))
    assert "collect_" not in text


def test_registry_and_reply_lookup_do_not_sort_statuses(spark):
    for name in ("user_registry", "reply_lookup"):
        parts = plan(REGISTRY[name](spark, SF)).split("Exchange")
        assert "SortAggregate" not in parts[-1], name


def test_rollup_reads_the_statuses_once(spark):
    text = plan(REGISTRY["rollup_client_country_hour"](spark, SF))
    assert text.count("events.parquet") <= 2


def test_small_lookup_sides_need_no_counting_pass(spark):
    text = plan(REGISTRY["incremental_extract"](spark, SF))
    assert "BroadcastHashJoin" in text and text.count("Scan parquet") == 2


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_routed_rows_are_rebalanced_by_folder(spark):
    rows = spark.range(10).selectExpr("id", "'b' AS batch_name", "'STATUS' AS kind", "'x' AS bucket")
    text = plan(rows.hint("rebalance", "batch_name", "kind", "bucket"))
    assert "REBALANCE_PARTITIONS_BY_COL" in text
