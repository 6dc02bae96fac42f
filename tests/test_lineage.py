"""Retweet chains, replies, skewed lookups and de-duplication."""

import random

from pyspark.sql import functions as F

from pulsegrid.operators import dedupe, lineage, skew

LINKS = "status_id bigint, created_at int, retweeted_status_id bigint, in_reply_to_status_id bigint"


def links(spark, rows):
    return spark.createDataFrame([(i, i, rt, rp) for i, rt, rp in rows], LINKS)


def test_chain_of_three_and_cycle(spark):
    df = links(spark, [(1, None, None), (2, 1, None), (3, 2, None), (8, 9, None), (9, 8, None)])
    got = {tuple(r) for r in lineage.retweet_lineage(df).collect()}
    chain = {(2, 2, 1, 1), (3, 3, 2, 1), (3, 2, 1, 2)}
    cycle = {(8, 8, 9, 1), (8, 9, 8, 2), (9, 9, 8, 1), (9, 8, 9, 2)}
    assert got == chain | cycle
    assert {r.level for r in lineage.retweet_lineage(df, max_level=1).collect()} == {1}


def test_long_chains_are_followed_to_the_end(spark):
    df = links(spark, [(1, None, None)] + [(i, i - 1, i - 1) for i in range(2, 10)])
    assert lineage.retweet_lineage(df).filter("origin_id = 9").count() == 8
    assert lineage.reply_threads(df.filter("status_id = 9"), df).count() == 8
    none = spark.createDataFrame([], "status_id bigint")
    rows = lineage.follow_references(df.filter("status_id = 9"), df, none)
    assert rows.filter("via = 'retweet'").agg(F.max("level")).first()[0] == 8
    near = df.filter("status_id = 9").withColumn("ref_level", F.lit(2))
    assert lineage.follow_references(near, df, none).agg(F.max("level")).first()[0] == 2
    ring = links(spark, [(1, 3, None), (2, 1, None), (3, 2, None)])
    assert lineage.follow_references(ring, ring, none).count() <= 9


def counted_rounds(monkeypatch, purpose):
    names, write = [], lineage.cut_lineage
    monkeypatch.setattr(lineage, "cut_lineage", lambda df, name: (names.append(name), write(df, name))[1])
    return lambda: names.count(purpose)


def test_rounds_are_the_logarithm_of_the_chain(spark, monkeypatch):
    df = spark.range(10_001).selectExpr(
        "id AS status_id", "id AS created_at", "nullif(id, 0) - 1 AS in_reply_to_status_id",
        "if(id % 200 = 0, NULL, id - 1) AS retweeted_status_id")
    rounds = counted_rounds(monkeypatch, "reply-round")
    rows = lineage.reply_threads(df.filter("status_id = 10000"), df)
    assert rows.filter("level = 10000 - status_id AND ref_status_id = status_id + 1").count() == 10_000
    assert rounds() <= 15
    rounds = counted_rounds(monkeypatch, "retweet-round")
    rows = lineage.retweet_lineage(df)
    assert rows.count() == 50 * sum(range(200))
    assert rows.filter("level = origin_id - status_id AND ref_status_id = status_id + 1").count() == rows.count()
    assert rounds() <= 9


def test_random_pointers_with_cycles(spark):
    rng = random.Random(4)
    up = {i: rng.choice([None, rng.randrange(60), rng.randrange(60)]) for i in range(50)}
    df = links(spark, [(i, up[i], up[i]) for i in up])
    chains, near = set(), {}
    seeds = [3, 11, 17, 29, 40]
    for i in up:
        at, seen = i, []
        while at in up and up[at] is not None and up[at] not in seen:
            seen.append(up[at])
            chains.add((i, at, up[at], len(seen)))
            at = up[at]
    for i, _, j, level in chains:
        if i in seeds and j in up:
            near[j] = min(near.get(j, level), level)
    assert {tuple(r) for r in lineage.retweet_lineage(df).collect()} == chains
    assert {tuple(r) for r in lineage.retweet_lineage(df, 3).collect()} == {c for c in chains if c[3] <= 3}
    got = {r.status_id: (r.level, r.ref_status_id) for r in lineage.reply_threads(df.filter(F.col("status_id").isin(seeds)), df).collect()}
    steps = {s: 0 for s in seeds} | {j: n for j, n in near.items() if j not in seeds}
    want = {j: (n, max(c for c in up if up[c] == j and steps.get(c) == n - 1)) for j, n in near.items()}
    assert got == want


def test_embedded_originals(spark):
    ddl = LINKS + ", filter_type string, original_user string, derived_user string"
    rows = spark.createDataFrame([(5, 5, 4, None, "T", "o", "d")], ddl)
    inside = spark.createDataFrame([(4, 4, 3, None, None, None, None), (4, 4, 3, None, None, None, None)], ddl)
    got = lineage.unroll_retweets(rows, embedded=inside).select("origin_id", "ref_status_id", "status_id", "filter_type")
    assert [tuple(r) for r in got.collect()] == [(5, 5, 4, "T")]


def test_last_reply_wins_and_missing_parent(spark):
    df = links(spark, [(1, None, None), (2, None, 1), (3, None, 1), (4, None, 99)])
    assert [tuple(r) for r in lineage.reply_parents(df, df).select("status_id", "ref_status_id").collect()] == [(1, 3)]


def test_threads_stop_at_level_and_visit_once(spark):
    df = links(spark, [(1, None, None)] + [(i, None, i - 1) for i in range(2, 8)])
    seeds = df.filter("status_id IN (5, 7)")
    got = {tuple(r) for r in lineage.reply_threads(seeds, df, max_level=2).collect()}
    assert got == {(4, 5, 1), (6, 7, 1), (3, 4, 2), (5, 6, 2)}


def test_mixed_references(spark):
    # 10 retweets 9, which replies to 8, which retweets 7; 11 replies to 8 as well.
    df = links(spark, [(7, None, None), (8, 7, None), (9, None, 8), (10, 9, None), (11, None, 8)])
    none = spark.createDataFrame([], "status_id bigint")
    got = {tuple(r) for r in lineage.follow_references(df.filter("status_id >= 10"), df, none, 5).collect()}
    assert got == {(10, 10, 9, "retweet", 1), (11, 11, 8, "reply", 1), (11, 8, 7, "retweet", 2)}
    seen = spark.createDataFrame([(8,)], "status_id bigint")
    got = {tuple(r) for r in lineage.follow_references(df.filter("status_id >= 10"), df, seen, 5).collect()}
    assert got == {(10, 10, 9, "retweet", 1)}


def test_lookup_join_equals_plain_join_with_a_hot_key(spark):
    facts = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 97).alias("key")
    )
    dim = spark.range(90).select(F.col("id").alias("key"), (F.col("id") * 2).alias("value"))
    hot = {r.key for r in skew.hot_keys(facts, "key", hot_rows=300).collect()}
    assert hot == {7}
    for how in ("left", "inner"):
        want = facts.join(dim, "key", how).select("id", "key", "value")
        got = skew.lookup_join(facts, dim, "key", how, salts=16, hot_rows=300).select("id", "key", "value")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_lookup_join_on_two_keys(spark):
    facts = spark.createDataFrame([("a", 1, i) for i in range(50)] + [("b", None, 90), (None, 1, 91), ("b", 2, 92)],
                                  "x string, y int, id int")
    dim = spark.createDataFrame([("a", 1, "p"), ("b", 2, "q"), ("c", 3, "r")], "x string, y int, value string")
    got = skew.lookup_join(facts, dim, ["x", "y"], salts=4, hot_rows=20).select("id", "value")
    want = facts.join(dim, ["x", "y"], "left").select("id", "value")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()), key=lambda r: r[0])


def test_hot_rows_are_spread(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        facts = spark.range(4000).select("id", F.lit(1).cast("bigint").alias("key"))
        dim = spark.range(5).select(F.col("id").alias("key"), F.lit("v").alias("value"))
        sizes = skew.lookup_join(facts, dim, "key", hot_rows=100).groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) >= 6 and max(r["count"] for r in sizes) < 1500
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_large_frontiers_give_the_same(spark, monkeypatch):
    df = links(spark, [(i, i - 3 if i % 2 and i > 3 else None, i - 2 if i % 3 == 0 and i > 2 else None) for i in range(60)])
    none = spark.createDataFrame([], "status_id bigint")
    seeds = df.filter("status_id > 40")
    def run():
        return [sorted(map(tuple, r.collect())) for r in (
            lineage.retweet_lineage(df, 4), lineage.reply_threads(seeds, df, 3),
            lineage.follow_references(seeds, df, none, 4).select("found_id", "ref_status_id", "status_id", "via", "level"))]
    small = run()
    monkeypatch.setattr(skew, "BROADCAST_ROWS", -1)
    assert run() == small and all(small)


def test_dedupe(spark):
    rows = [("a", 2, 20), ("a", 1, 30), ("a", 1, 10), ("b", 5, 50)]
    df = spark.createDataFrame(rows, "screen_name string, created_at int, status_id int")
    assert {(r.screen_name, r.status_id) for r in dedupe.first_per_user(df).collect()} == {("a", 10), ("b", 50)}
    done = spark.createDataFrame([("a",)], "screen_name string")
    assert [r.screen_name for r in dedupe.new_users(df, done).collect()] == ["b"]
    ids = spark.createDataFrame([(10,), (99,)], "status_id int")
    twice = df.unionByName(df).unionByName(df.withColumn("created_at", F.lit(0)).filter("status_id = 20"))
    kept = {r.status_id: r.created_at for r in dedupe.new_statuses(twice, ids).collect()}
    assert kept == {20: 0, 30: 1, 50: 5}


def test_first_of_users_is_found_without_ranking_rows(spark, monkeypatch):
    ddl = "screen_name string, created_at timestamp, status_id bigint, text string"
    day = "2024-01-0{}".format
    rows = [("a", day(2), 2, "x"), ("a", day(1), 7, "first"), ("a", day(1), 7, "first"), ("a", None, 1, "no time"),
            ("b", None, None, "only"), (None, day(1), 3, "nobody"), ("c", day(3), 5, "u"), ("c", day(3), 5, "v")]
    df = spark.createDataFrame(rows, "screen_name string, day string, status_id bigint, text string").select(
        "screen_name", F.col("day").cast("timestamp").alias("created_at"), "status_id", "text")
    def found():
        return sorted((r.screen_name, r.text) for r in dedupe.first_per_user(df).collect())
    first = found()
    assert first[:2] == [("a", "first"), ("b", "only")] and first[2][0] == "c" and len(first) == 3
    monkeypatch.setattr(skew, "BROADCAST_ROWS", -1)
    assert found() == first
    done = spark.createDataFrame([("a",), ("c",)], "screen_name string")
    assert [r.screen_name for r in dedupe.new_users(df, done).collect()] == ["b"]
    assert dedupe.first_per_user(spark.createDataFrame([], ddl)).collect() == []
