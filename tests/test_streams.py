"""Streams over many files: same results as batch, nothing twice after a restart."""

from pyspark.sql import functions as F

from pulsegrid.operators import classify, patterns
from pulsegrid.plans import bindings as B
from pulsegrid.plans import queries as Q
from pulsegrid.sources.landing import stream_table
from pulsegrid.streaming import flows

SF = "/root/testdata/sf0.001"


def split_events(spark, path, parts, first=None):
    events = B.table(spark, SF, "events")
    if first is not None:
        events = events.filter(first)
    events.repartition(parts, "event_id").write.mode("append").parquet(path)


def stream(spark, path):
    schema = B.table(spark, SF, "events").schema
    rows = B.events_to_statuses(stream_table(spark, path, "*.parquet", schema, max_files=2))
    return rows.withColumn("created_at", F.col("created_at").cast("timestamp"))


def as_set(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_classification_in_two_runs(spark, tmp_path):
    src, out, ckpt = (f"{tmp_path}/{n}" for n in ("in", "out", "ckpt"))
    columns = ("status_id", "batch_name", "filter_type", "original_user", "derived_user", "kind")
    watched, accounts = B.watched(spark, SF), B.accounts(spark, SF)
    for part in ("event_id < 400", "event_id >= 400"):
        split_events(spark, src, 5, part)
        flows.finish(flows.classify_to_files(stream(spark, src), watched, accounts, out, ckpt))
    # A restart without new files adds nothing.
    flows.finish(flows.classify_to_files(stream(spark, src), watched, accounts, out, ckpt))
    want = classify.classify_followed(B.statuses(spark, SF), watched, accounts)
    assert as_set(spark.read.parquet(out), *columns) == as_set(want, *columns)


def test_users_once_over_restarts(spark, tmp_path):
    src, out, ckpt = (f"{tmp_path}/{n}" for n in ("in", "out", "ckpt"))
    for part in ("event_id % 2 = 0", "event_id % 2 = 1"):
        split_events(spark, src, 3, part)
        flows.finish(flows.first_users_to_files(stream(spark, src), out, ckpt))
    users = as_set(spark.read.parquet(out), "screen_name")
    assert users == as_set(B.statuses(spark, SF).select("screen_name").distinct(), "screen_name")


def test_roll_counts_with_open_windows(spark, tmp_path):
    src, out, ckpt = (f"{tmp_path}/{n}" for n in ("in", "out", "ckpt"))
    split_events(spark, src, 6)
    flows.finish(flows.roll_counts(stream(spark, src), out, ckpt))
    columns = ("batch_name", "bucket", "record_count")
    assert as_set(flows.read_roll_counts(spark, out), *columns) == as_set(Q.roll_windows(spark, SF), *columns)


def test_refreshed_patterns_apply_to_the_next_batch(spark, tmp_path):
    src, table, out, ckpt = (f"{tmp_path}/{n}" for n in ("in", "kw", "out", "ckpt"))
    ddl = "org_pos int, org string, kw_pos int, der string, tag string"
    for part, word in (("event_id < 500", "error"), ("event_id >= 500", "click")):
        spark.createDataFrame([(0, "o", 0, word, "by")], ddl).write.mode("overwrite").parquet(table)
        split_events(spark, src, 2, part)
        flows.finish(flows.track_to_epochs(stream(spark, src), table, out, ckpt))
    rows = B.statuses(spark, SF)
    want = [
        patterns.match_patterns(rows.filter(f"status_id {op} 500"), spark.createDataFrame([(0, "o", 0, word, "by")], ddl))
        for op, word in (("<", "error"), (">=", "click"))
    ]
    whole = classify.classify_tracked(want[0].unionByName(want[1]))
    columns = ("status_id", "derived_user", "original_user", "kind")
    assert as_set(spark.read.parquet(out), *columns) == as_set(whole, *columns)


def test_registry_over_micro_batches(spark, tmp_path):
    src, out, ckpt = (f"{tmp_path}/{n}" for n in ("in", "out", "ckpt"))
    split_events(spark, src, 5)
    rows = stream(spark, src)
    from pulsegrid.operators.registry import register_users
    whole = register_users(B.statuses(spark, SF).withColumn("created_at", F.col("created_at").cast("timestamp")))
    flows.finish(flows.register_users_stream(rows, out, ckpt))
    columns = whole.columns
    assert as_set(flows.read_registrations(spark, out, whole.schema), *columns) == as_set(whole, *columns)


def test_compacted_rolls_are_counted_once(spark, tmp_path, monkeypatch):
    from pulsegrid.sinks import state

    src, out, ckpt = (f"{tmp_path}/{n}" for n in ("in", "out", "ckpt"))
    split_events(spark, src, 6)
    flows.finish(flows.roll_counts(stream(spark, src), out, ckpt, compact_every=2))
    columns = ("batch_name", "bucket", "record_count")
    want = as_set(Q.roll_windows(spark, SF), *columns)
    assert as_set(flows.read_roll_counts(spark, out), *columns) == want
    epochs = state.read_manifest(spark, out, state.LIVE)["epochs"]
    assert sorted(epochs) == [1, 2]
    # a compaction that ends before its commit leaves the table as it was, and is made up for later
    schema = spark.createDataFrame([], flows._ROLLS).schema
    open_reader = flows.read_roll_counts(spark, out)
    with monkeypatch.context() as broken:
        broken.setattr(state, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
        try:
            state.compact_epochs(spark, out, schema, state.LIVE, 2, flows._sum_rolls)
            raise AssertionError("the commit did not fail")
        except RuntimeError:
            pass
    assert as_set(flows.read_roll_counts(spark, out), *columns) == want
    state.compact_epochs(spark, out, schema, state.LIVE, 2, flows._sum_rolls)
    assert sorted(state.read_manifest(spark, out, state.LIVE)["epochs"]) == [2]
    assert as_set(flows.read_roll_counts(spark, out), *columns) == want
    assert as_set(open_reader, *columns) == want


def test_patterns_are_refreshed_from_new_rows_only(spark, tmp_path):
    from pulsegrid.operators.hashtags import top_hashtags

    rows = B.statuses(spark, SF)
    counts, table = f"{tmp_path}/counts", f"{tmp_path}/patterns"
    parts = [rows.filter(f"status_id % 3 = {i}") for i in range(3)]
    for epoch, part in enumerate(parts):
        flows.refresh_patterns(part, counts, table, epoch, compact_every=2)
    flows.refresh_patterns(parts[2], counts, table, 2, compact_every=2)  # a repeated refresh adds nothing
    want = patterns.pattern_keywords(top_hashtags(rows))
    assert as_set(flows.read_keywords(spark, table), *want.columns) == as_set(want, *want.columns)


def test_derived_tables_follow_late_rows(spark, tmp_path):
    from pulsegrid.operators import rollups
    from pulsegrid.plans import refresh
    from pulsegrid.sinks import state

    rows = B.replying_statuses(spark, SF).withColumn("user_code", F.col("screen_name")).withColumn(
        "day", F.date_format("created_at", "yyyyMMdd"))
    users, zones, accounts = (f(spark, SF) for f in (B.users, B.zones, B.accounts))
    countries = rollups.user_countries(users, zones)
    root = f"{tmp_path}/kept"
    late = F.col("created_at").between("2024-01-10", "2024-01-11")
    for epoch, part in enumerate((rows.filter(~late), rows.filter(late))):
        state.write_epoch(part, f"{root}/loaded", state.LIVE, epoch, ("day",))
        days = refresh.refresh_epoch(f"{root}/loaded", rows.schema, countries, accounts, B.LEXICON, root, epoch)
    every = rows.select("day").distinct().count()
    assert {"20240110"} < set(days) and len(days) < every
    refresh.refresh_tables(rows, users, zones, accounts, B.LEXICON, f"{tmp_path}/whole")
    for name in ("sentiment", "client_country", "hashtag_country"):
        got, want = (spark.read.parquet(f"{r}/{name}") for r in (root, f"{tmp_path}/whole"))
        assert as_set(got, *want.columns) == as_set(want, *want.columns), name
