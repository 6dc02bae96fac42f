"""The back-fill and live jobs end to end on a few landed records."""

import datetime as dt

from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.plans.backfill import Store, current_modes, run_backfill
from pulsegrid.plans.live import before_cutoff, start_live
from pulsegrid.sinks.state import LIVE, compact_epochs, read_epochs, write_epoch
from pulsegrid.sources.landing import read_landed, stream_landed

T0 = dt.datetime(2024, 1, 1)


def record(id, user, hour, text="t", retweet=None, reply=-1, **extra):
    return dict(id=id, created_at=T0 + dt.timedelta(hours=hour), text=text, in_reply_to_status_id=reply,
                in_reply_to_user_id=-1, current_user_retweet_id=-1, mentions=[], hashtags=[],
                user={"id": ord(user), "screen_name": user},
                retweeted_status=retweet and {"id": retweet, "user": {"id": 0, "screen_name": "a"}}, **extra)


def land(spark, path, *rows, ddl=S.LANDED_STATUS_DDL):
    spark.createDataFrame(list(rows), ddl).coalesce(1).write.mode("append").parquet(path)


def definition(spark, users, earliest=""):
    row = {k: "" for k in S.BATCH_DEFINITION_KEYS}
    row.update(batchName="b", userNames=users, dateFormat="dd/MM/yyyy-HH:mm:ss", batchCutOffMinDate=earliest)
    return spark.createDataFrame([row], S.text_schema(S.BATCH_DEFINITION_KEYS))


def stored(spark, store):
    rows = spark.read.parquet(store.table("statuses")).select("status_id", "ref_status_id", "original_user", "batch_name")
    return sorted(map(tuple, rows.collect()), key=str)


def test_backfill_follows_and_remembers(spark, tmp_path):
    path, store = f"{tmp_path}/landed", Store(f"{tmp_path}/store")
    land(spark, path, record(1, "x", 1), record(2, "y", 2, retweet=1), record(3, "w", 3, retweet=2),
         record(4, "z", 4), record(5, "w", 5, reply=4), record(6, "q", 6))
    landed = read_landed(spark, path)
    run_backfill(spark, landed, definition(spark, "w"), store, 0)
    first = [(1, 2, "w", "b"), (2, 3, "w", "b"), (3, None, "w", "b"), (4, 5, "w", "b"), (5, None, "w", "b")]
    assert stored(spark, store) == sorted(first, key=str)
    users = spark.read.parquet(store.table("users"))
    assert sorted(r.screen_name for r in users.collect()) == ["w", "x", "y", "z"]

    # The same input again adds nothing and finishes the user; replaying run 0 changes nothing.
    run_backfill(spark, landed, definition(spark, "w"), store, 0)
    run_backfill(spark, landed, definition(spark, "w"), store, 1)
    assert stored(spark, store) == sorted(first, key=str)
    modes = {r.screen_name: r.paging_mode for r in current_modes(spark, store, 2).collect()}
    assert modes == {"w": "FORWARD"}


def test_backfill_extends_in_both_directions(spark, tmp_path):
    path, store = f"{tmp_path}/landed", Store(f"{tmp_path}/store")
    land(spark, path, record(5, "w", 5))
    run_backfill(spark, read_landed(spark, path), definition(spark, "w"), store, 0)
    land(spark, path, record(3, "w", 3), record(7, "w", 7, reply=5))
    run_backfill(spark, read_landed(spark, path), definition(spark, "w"), store, 1)
    assert stored(spark, store) == sorted(
        [(5, None, "w", "b"), (3, None, "w", "b"), (7, None, "w", "b"), (5, 7, "w", "b")], key=str)
    land(spark, path, record(8, "w", 8, reply=5))
    run_backfill(spark, read_landed(spark, path), definition(spark, "w"), store, 2)
    assert len(stored(spark, store)) == 5  # 5 was looked up before; only 8 is new


def test_backfill_cutoff(spark, tmp_path):
    path, store = f"{tmp_path}/landed", Store(f"{tmp_path}/store")
    land(spark, path, record(1, "w", 1), record(2, "w", 2), record(3, "w", 3))
    run_backfill(spark, read_landed(spark, path), definition(spark, "w", "01/01/2024-02:00:00"), store, 0)
    assert [r[0] for r in stored(spark, store)] == [2, 3]
    assert [r.paging_mode for r in current_modes(spark, store, 1).collect()] == ["FORWARD"]


LIVE_DDL = S.LANDED_STATUS_DDL.rstrip() + ", batch_name string"


def test_live_routes_and_restarts(spark, tmp_path):
    path, kw, ckpt, store = f"{tmp_path}/in", f"{tmp_path}/kw", f"{tmp_path}/ckpt", Store(f"{tmp_path}/store")
    spark.createDataFrame([(0, "org", 0, "sun", "sea")], "org_pos int, org string, kw_pos int, der string, tag string"
                          ).write.parquet(kw)
    watched = spark.createDataFrame([("b", "w")], "batch_name string, screen_name string")
    accounts = spark.createDataFrame([("w", "org")], "screen_name string, original_user string")

    def collect():
        source = spark.readStream.schema(LIVE_DDL).parquet(path)
        query = start_live(source, watched, accounts, kw, store, ckpt)
        assert query.awaitTermination(300)

    tracker = S.STREAM_TRACKER
    land(spark, path, record(1, "w", 1, retweet=99, batch_name="b"), record(2, "v", 2, batch_name="b"),
         record(3, "s", 3, text="SUN and sea", batch_name=tracker), record(4, "r", 4, text="sun", batch_name=tracker),
         record(5, "n", 5, text="none", batch_name=tracker), ddl=LIVE_DDL)
    collect()
    collect()
    land(spark, path, record(6, "w", 6, batch_name="b"), record(7, "r", 7, text="sea sun", batch_name=tracker), ddl=LIVE_DDL)
    collect()
    rows = spark.read.parquet(store.table("statuses"))
    got = {r.status_id: (r.kind, r.filter_type, r.original_user, r.derived_user) for r in rows.collect()}
    assert got == {
        1: ("STATUS", "STREAM_TIMELINE", "org", "w"), 2: ("STATUS", "STREAM_REFERENCE", None, ""),
        3: ("STATUS", "STREAM_TRACKER", "org", "(sun+sea)"),
        4: ("REJECTED-STATUS", "STREAM_TRACKER", "STREAM_KEYWORD", "(sun)"),
        6: ("STATUS", "STREAM_TIMELINE", "org", "w"), 7: ("STATUS", "STREAM_TRACKER", "org", "(sun+sea)"),
        99: ("STATUS", "STREAM_TIMELINE", "org", "w"),
    }
    assert rows.count() == 7 and [r.ref_status_id for r in rows.filter("status_id = 99").collect()] == [1]
    users = [r.screen_name for r in spark.read.parquet(store.table("users")).collect()]
    assert sorted(users) == ["a", "r", "s", "v", "w"]
    known = spark.read.parquet(store.state("registry")).select("batch_name", "screen_name", "original_user")
    assert [tuple(r) for r in known.collect()] == [("b", "a", "org")]


def test_user_seen_by_backfill_and_stream_is_stored_once(spark, tmp_path):
    path, live, kw = f"{tmp_path}/landed", f"{tmp_path}/live", f"{tmp_path}/kw"
    store = Store(f"{tmp_path}/store")
    land(spark, path, record(1, "w", 1))
    run_backfill(spark, read_landed(spark, path), definition(spark, "w"), store, 0)
    spark.createDataFrame([], "org_pos int, org string, kw_pos int, der string, tag string").write.parquet(kw)
    land(spark, live, record(2, "w", 2, batch_name="b"), record(3, "x", 3, batch_name="b"), ddl=LIVE_DDL)
    watched = spark.createDataFrame([("b", "w")], "batch_name string, screen_name string")
    accounts = spark.createDataFrame([("w", "w")], "screen_name string, original_user string")
    source = spark.readStream.schema(LIVE_DDL).parquet(live)
    assert start_live(source, watched, accounts, kw, store, f"{tmp_path}/ckpt").awaitTermination(300)
    users = [r.screen_name for r in spark.read.parquet(store.table("users")).collect()]
    assert sorted(users) == ["w", "x"]
    assert sorted(r[0] for r in stored(spark, store)) == [1, 2, 3]


def test_a_history_that_lands_late_is_still_read(spark, tmp_path):
    path, store = f"{tmp_path}/landed", Store(f"{tmp_path}/store")
    ends = definition(spark, "w,v").withColumn("batchCutOffMaxDate", F.lit("01/01/2024-05:00:00"))
    land(spark, path, record(4, "w", 4), record(10, "w", 10))
    run_backfill(spark, read_landed(spark, path), ends, store, 0)
    assert {r.screen_name: r.paging_mode for r in current_modes(spark, store, 1).collect()} == {"w": "REVERSE", "v": "REVERSE"}
    land(spark, path, record(2, "w", 2), record(3, "v", 3))
    run_backfill(spark, read_landed(spark, path), ends, store, 1)
    assert [r[0] for r in stored(spark, store)] == [2, 3, 4]


def test_statuses_landed_twice_are_stored_once(spark, tmp_path):
    path, store = f"{tmp_path}/landed", Store(f"{tmp_path}/store")
    rows = [record(1, "x", 1), record(2, "w", 2, retweet=1), record(3, "w", 3, reply=1)]
    land(spark, path, *rows, *rows)
    run_backfill(spark, read_landed(spark, path), definition(spark, "w"), store, 0)
    assert [r[:2] for r in stored(spark, store)] == [(1, 2), (1, 3), (2, None), (3, None)]


def test_retweeted_records_come_from_inside_the_retweet(spark, tmp_path):
    path, store = f"{tmp_path}/landed", Store(f"{tmp_path}/store")
    land(spark, path, record(2, "w", 2, retweet=1))
    run_backfill(spark, read_landed(spark, path), definition(spark, "w"), store, 0)
    assert [r[:2] for r in stored(spark, store)] == [(1, 2), (2, None)]


def test_reference_level_of_the_definition(spark, tmp_path):
    path = f"{tmp_path}/landed"
    land(spark, path, record(1, "x", 1), record(2, "y", 2, reply=1), record(3, "w", 3, reply=2))
    for level, want in (("0", [3]), ("1", [2, 3]), ("", [1, 2, 3])):
        store = Store(f"{tmp_path}/store{level}")
        run_backfill(spark, read_landed(spark, path), definition(spark, "w").withColumn("batchRefLevel", F.lit(level)), store, 0)
        assert sorted(r[0] for r in stored(spark, store)) == want


def test_live_settings_and_discovered_users(spark, tmp_path):
    path, kw, store = f"{tmp_path}/in", f"{tmp_path}/kw", Store(f"{tmp_path}/store")
    spark.createDataFrame([], "org_pos int, org string, kw_pos int, der string, tag string").write.parquet(kw)
    watched = spark.createDataFrame([("b", "w")], "batch_name string, screen_name string")
    accounts = spark.createDataFrame([("w", "org")], "screen_name string, original_user string")
    settings = spark.createDataFrame([("b", T0 + dt.timedelta(hours=8))], "batch_name string, cutoff_max timestamp")
    for rows in ([record(1, "a", 1, batch_name="b"), record(2, "w", 2, retweet=90, batch_name="b")],
                 [record(3, "a", 3, batch_name="b"), record(4, "z", 4, batch_name="b"), record(9, "w", 9, batch_name="b")]):
        land(spark, path, *rows, ddl=LIVE_DDL)
        source = spark.readStream.schema(LIVE_DDL).parquet(path)
        assert start_live(source, watched, accounts, kw, store, f"{tmp_path}/ckpt", settings=settings,
                          follow_registered=True).awaitTermination(300)
    # 1 came before its author was discovered through 2; 4 is by a stranger; 9 is behind the latest date
    assert sorted(r[0] for r in stored(spark, store)) == [2, 3, 90]


def test_compacted_state_reads_the_same(spark, tmp_path):
    path, schema = f"{tmp_path}/state", spark.createDataFrame([], "screen_name string").schema
    for epoch, names in enumerate((["a", "b"], ["b", "c"], ["d"], ["e"])):
        write_epoch(spark.createDataFrame([(n,) for n in names], schema), path, LIVE, epoch)
    compact_epochs(spark, path, schema, LIVE, 2, lambda rows: rows.distinct())
    compact_epochs(spark, path, schema, LIVE, 2, lambda rows: rows.distinct())
    assert sorted(r.screen_name for r in read_epochs(spark, path, schema).collect()) == ["a", "b", "c", "d", "e"]
    assert sorted(p.name for p in (tmp_path / "state" / f"writer={LIVE}").iterdir()) == ["epoch=2", "epoch=3"]


def test_live_cutoff(spark):
    df = spark.createDataFrame([(1, "a", T0), (2, "b", T0), (3, "c", T0), (4, "d", T0)],
                               "id int, batch_name string, created_at timestamp")
    settings = spark.createDataFrame([("a", T0), ("b", T0 + dt.timedelta(1)), ("c", None)],
                                     "batch_name string, cutoff_max timestamp")
    assert sorted(r.id for r in before_cutoff(df, settings).collect()) == [2, 3, 4]


def test_json_stream_source(spark, tmp_path):
    path = f"{tmp_path}/json"
    spark.createDataFrame([record(1, "w", 1)], S.LANDED_STATUS_DDL).write.json(path)
    query = (stream_landed(spark, path).select("id", F.col("user.screen_name").alias("n")).writeStream
             .format("memory").queryName("json_in").trigger(availableNow=True)
             .option("checkpointLocation", f"{tmp_path}/c").start())
    assert query.awaitTermination(120)
    assert [tuple(r) for r in spark.table("json_in").collect()] == [(1, "w")]


def test_late_ids_between_the_marks_are_stored(spark, tmp_path):
    path, store = f"{tmp_path}/landed", Store(f"{tmp_path}/store")
    early = definition(spark, "w")
    late = definition(spark, "w,v").withColumn("batchName", F.lit("c")).withColumn(
        "batchCutOffMinDate", F.lit("01/01/2024-04:00:00"))
    both = early.unionByName(late)
    land(spark, path, record(1, "w", 1), record(5, "w", 5), record(9, "w", 9))
    run_backfill(spark, read_landed(spark, path), both, store, 0)
    land(spark, path, record(3, "w", 3), record(5, "w", 5), record(7, "w", 7), record(8, "v", 8))
    run_backfill(spark, read_landed(spark, path), both, store, 1)
    run_backfill(spark, read_landed(spark, path), both, store, 2)
    got = sorted((r[3], r[0]) for r in stored(spark, store))
    assert got == [("b", i) for i in (1, 3, 5, 7, 9)] + [("c", i) for i in (5, 7, 8, 9)]


def test_history_reads_new_or_wanted_folders(spark, tmp_path):
    from pulsegrid.plans import backfill
    from pulsegrid.sources.batch_config import batch_settings, watched_users
    from pulsegrid.sources.history import History

    store, history = Store(f"{tmp_path}/store"), History(f"{tmp_path}/history")

    def landing(epoch, *rows):
        history.append(spark.createDataFrame(list(rows), S.LANDED_STATUS_DDL), epoch)

    def parts(definitions, run):
        found = backfill.wanted_parts(spark, history, watched_users(definitions), batch_settings(definitions), store, run)
        return [sorted(r.id for r in rows.collect()) for rows, _ in found], found

    one, more = definition(spark, "w"), definition(spark, "w,v")
    landing(0, record(1, "w", 1), record(2, "v", 2), record(3, "x", 3))
    run_backfill(spark, history, one, store, 0)
    landing(1, record(4, "w", 4), record(0, "w", 0))
    ids, found = parts(one, 1)
    assert ids == [[0, 4]] and all("epoch=1" in f for rows, _ in found for f in rows.inputFiles())
    run_backfill(spark, history, one, store, 1)
    landing(2, record(5, "v", 5))
    ids, found = parts(more, 2)
    assert ids == [[5], [2]]
    assert "PartitionFilters: [" in found[1][0]._jdf.queryExecution().executedPlan().toString()
    run_backfill(spark, history, more, store, 2)
    run_backfill(spark, history, more, store, 2)
    assert [r[0] for r in stored(spark, store)] == [0, 1, 2, 4, 5]
