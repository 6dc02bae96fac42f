"""High-water marks, paging modes, registry, follow list and derived tables."""

import datetime as dt

from pyspark.sql import functions as F

from pulsegrid.operators import classify, incremental, registry, rollups
from pulsegrid.plans.refresh import advance_definitions, refresh_tables, refresh_weights
from pulsegrid.schemas import BATCH_DEFINITION_KEYS, text_schema
from pulsegrid.sinks.batch_config import write_definitions
from pulsegrid.sources.batch_config import read_batch_definitions

T0 = dt.datetime(2024, 1, 1)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def test_cutoffs_are_inclusive_and_open(spark):
    df = spark.createDataFrame([(i, at(i)) for i in range(5)], "status_id int, created_at timestamp")
    ids = lambda d: sorted(r.status_id for r in d.collect())
    assert ids(classify.within_cutoffs(df, F.lit(at(1)), F.lit(at(3)))) == [1, 2, 3]
    assert ids(classify.within_cutoffs(df, latest=F.lit(at(1)))) == [0, 1]
    assert ids(classify.within_cutoffs(df)) == [0, 1, 2, 3, 4]


def test_watermarks_are_exclusive(spark):
    df = spark.createDataFrame([(i, "a") for i in range(1, 8)] + [(1, "b")], "status_id bigint, screen_name string")
    marks = incremental.user_watermarks(df.filter("screen_name = 'a' AND status_id BETWEEN 3 AND 5"))
    got = {(r.status_id, r.screen_name): r.direction for r in incremental.beyond_watermarks(df, marks).collect()}
    assert got == {(1, "a"): "REVERSE", (2, "a"): "REVERSE", (6, "a"): "FORWARD", (7, "a"): "FORWARD", (1, "b"): "INITIAL"}
    merged = incremental.merge_watermarks(marks.unionByName(incremental.user_watermarks(df))).orderBy("screen_name").first()
    assert (merged.since_id, merged.max_id) == (1, 7)


def test_paging_modes(spark):
    watched = spark.createDataFrame([("x", "in"), ("x", "old"), ("y", "none"), ("z", "in")], "batch_name string, screen_name string")
    rows = spark.createDataFrame([("in", at(5)), ("old", at(5)), ("old", at(1))], "screen_name string, created_at timestamp")
    modes = incremental.paging_modes(watched, rows, F.lit(at(2)))
    got = {(r.batch_name, r.screen_name): r.paging_mode for r in modes.collect()}
    assert got == {("x", "in"): "REVERSE", ("x", "old"): "FORWARD", ("y", "none"): "FORWARD", ("z", "in"): "REVERSE"}
    done = {r.batch_name: r.is_finished for r in incremental.finished_batches(modes).collect()}
    assert done == {"x": False, "y": True, "z": False}
    left = incremental.without_finished_users(watched, modes)
    assert sorted(map(tuple, left.collect())) == [("x", "in"), ("z", "in")]


def test_registry_first_id_last_account_over_runs(spark):
    ddl = "batch_name string, screen_name string, user_id bigint, original_user string, created_at int, status_id bigint"
    rows = [("b", "u", 1, "old", 1, 1), ("b", "u", 2, "new", 2, 2), ("b", "v", 3, "x", 1, 3)]
    whole = registry.register_users(spark.createDataFrame(rows, ddl))
    parts = registry.merge_registrations(*[registry.register_users(spark.createDataFrame([r], ddl)) for r in reversed(rows)])
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))
    assert {r.screen_name: (r.user_id, r.original_user) for r in parts.collect()} == {"u": (1, "new"), "v": (3, "x")}
    assert {tuple(r) for r in registry.account_map(whole).collect()} == {("u", "new"), ("v", "x")}


def test_follow_list_order_and_lists(spark):
    ddl = "batch_name string, screen_name string"
    watched = spark.createDataFrame([("b", "w2"), ("b", "w1"), ("b", "unknown")], ddl)
    known = spark.createDataFrame([("b", "r1"), ("b", "w1"), ("c", "r1")], ddl)
    ids = spark.createDataFrame([("w1", 30), ("w2", 20), ("r1", 10)], "screen_name string, user_id bigint")
    rows = registry.follow_list(watched, known, ids, size=2)
    assert sorted((r.batch_name, r.list_no, r.position, r.screen_name) for r in rows.collect()) == [
        ("b", 0, 1, "w2"), ("b", 0, 2, "w1"), ("b", 1, 3, "r1"), ("c", 0, 1, "r1")]


def test_follow_list_ranks_across_slices(spark):
    many = spark.range(500).selectExpr("'b' AS batch_name", "concat('u', id) AS screen_name")
    ids = spark.range(500).selectExpr("concat('u', id) AS screen_name", "id * 1000003 AS user_id")
    rows = registry.follow_list(many.limit(0), many, ids).orderBy("position").collect()
    assert [r.position for r in rows] == list(range(1, 501))
    assert [r.user_id for r in rows] == [i * 1000003 for i in range(500)]
    assert [r.list_no for r in rows] == [i // 200 for i in range(500)]


def test_a_status_above_the_range_does_not_end_a_history(spark):
    watched = spark.createDataFrame([("x", "u"), ("x", "v")], "batch_name string, screen_name string")
    rows = spark.createDataFrame([("u", at(5)), ("u", at(9)), ("v", at(5)), ("v", at(1))], "screen_name string, created_at timestamp")
    modes = incremental.paging_modes(watched, rows, F.lit(at(2)), F.lit(at(6)))
    assert {r.screen_name: r.paging_mode for r in modes.collect()} == {"u": "REVERSE", "v": "FORWARD"}


def test_classify_followed(spark):
    ddl = "status_id int, batch_name string, screen_name string, mentions array<struct<screen_name:string,id:bigint>>"
    df = spark.createDataFrame([(1, "b", "w", []), (2, "b", "x", [("m", 1), ("n", 2)]), (3, "c", "w", [])], ddl)
    watched = spark.createDataFrame([("b", "w")], "batch_name string, screen_name string")
    accounts = spark.createDataFrame([("w", "org"), ("x", "other")], "screen_name string, original_user string")
    got = {r.status_id: (r.filter_type, r.original_user, r.derived_user)
           for r in classify.classify_followed(df, watched, accounts).collect()}
    assert got == {1: ("STREAM_TIMELINE", "org", "w"), 2: ("STREAM_REFERENCE", None, "m+n"), 3: ("STREAM_REFERENCE", None, "")}


MESSAGES = "status_id int, original_user string, user_id bigint, in_reply_to_user_id bigint, created_at timestamp"


def test_non_responded_users(spark):
    accounts = spark.createDataFrame([(1, "A"), (2, "A"), (9, "B")], "user_id bigint, original_user string")
    rows = [
        (1, "x", 5, 1, at(1)), (2, "A", 2, 5, at(2)),                        # 5 asked, A answered
        (3, "x", 6, 1, at(1)), (4, "A", 1, 6, at(2)), (5, "x", 6, 2, at(3)),  # 6 asked again
        (6, "B", 9, 1, at(1)),                                               # never answered
        (7, "A", 1, 2, at(1)),                                               # inside the team
    ]
    df = spark.createDataFrame(rows, MESSAGES)
    accounts = accounts.unionByName(spark.createDataFrame([(5, "x"), (6, "x")], accounts.schema))
    got = {r.client: (r.asking_users, r.non_responded_user_count)
           for r in rollups.non_responded_users(df, accounts).collect()}
    assert got["A"] == (3, 2)


def test_advance_definitions(spark, tmp_path):
    schema = text_schema(BATCH_DEFINITION_KEYS)
    row = {k: "" for k in BATCH_DEFINITION_KEYS} | {"dateFormat": "dd/MM/yyyy-HH:mm:ss"}
    defs = spark.createDataFrame([row | {"batchName": "a"}, row | {"batchName": "b", "batchCutOffMinDate": "05/01/2024-00:00:00"},
                                  row | {"batchName": "c"}], schema)
    loaded = spark.createDataFrame([("a", at(1)), ("a", at(2)), ("b", at(1))], "batch_name string, created_at timestamp")
    advanced = advance_definitions(defs, loaded)
    got = {r.batchName: r.batchCutOffMinDate for r in advanced.collect()}
    assert got == {"a": "01/01/2024-02:00:00", "b": "05/01/2024-00:00:00", "c": ""}
    write_definitions(advanced, f"{tmp_path}/defs")
    back = read_batch_definitions(spark, f"{tmp_path}/defs")
    assert sorted(map(tuple, back.select(advanced.columns).collect())) == sorted(map(tuple, advanced.collect()))


def test_refresh_replaces_days(spark, tmp_path):
    ddl = ("status_id int, user_id bigint, user_code string, original_user string, derived_user string, filter_type string, "
           "in_reply_to_user_id bigint, created_at timestamp, text string, hashtags array<string>")
    rows = [(1, 5, "u5", "A", "u5", "BATCH_TIMELINE", None, at(1), "good good", ["t"]),
            (2, 5, "u5", "A", "u5", "BATCH_TIMELINE", None, at(30), "bad", ["t", "s"])]
    users = spark.createDataFrame([(5, "tz1")], "id bigint, time_zone string")
    zones = spark.createDataFrame([("tz1", "X")], "src_timezone string, country string")
    accounts = spark.createDataFrame([(5, "A")], "user_id bigint, original_user string")
    df = spark.createDataFrame(rows, ddl)
    args = (users, zones, accounts, {"good": 1, "bad": -2}, str(tmp_path))
    refresh_tables(df, *args)
    more = df.unionByName(spark.createDataFrame([(3, 5, "u5", "A", "u5", "BATCH_TIMELINE", None, at(31), "bad", ["t"])], ddl))
    refresh_tables(more, *args, since="2024-01-02 07:00:00")
    sentiment = {(r.day, r.keyword): r.sentiment_score for r in spark.read.parquet(f"{tmp_path}/sentiment").collect()}
    assert sentiment == {(1, "good"): 2, (2, "bad"): -4}
    tags = {(r.day, r.hashtag): (r.country, r.sentiment_score, r.num_of_users)
            for r in spark.read.parquet(f"{tmp_path}/hashtag_country").collect()}
    assert tags == {(1, "t"): ("X", 2, 1), (2, "t"): ("X", -4, 1), (2, "s"): ("X", -2, 1)}
    assert spark.read.parquet(f"{tmp_path}/client_country").count() == 3
    refresh_weights(df, f"{tmp_path}/weights")
    assert spark.read.parquet(f"{tmp_path}/weights").count() == 2
