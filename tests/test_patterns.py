"""The pattern rule on hand-made texts, and against a plain loop on random ones."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsegrid.operators import classify, hashtags, patterns
from pulsegrid.plans import bindings as B
from pulsegrid.session import cut_lineage

SF = "/root/testdata/sf0.001"
KEYWORD_DDL = "org_pos int, org string, kw_pos int, der string, tag string"


def loop_match(text, keywords):
    """The rule, one text at a time: keywords are (org, der, tag) in order."""
    labels, orgs, used = [], [], []
    for org, der, tag in keywords:
        has_der = bool(der) and der.lower() in text.lower()
        has_tag = bool(tag) and tag.lower() in text.lower()
        if has_der and has_tag:
            labels.append(f"({der}+{tag})")
            if org not in orgs:
                orgs.append(org)
            continue
        token = tag if has_tag else der if has_der else None
        if token is not None and token not in used:
            used.append(token)
            labels.append(f"({token})")
    return (" & ".join(labels), " & ".join(orgs) or "STREAM_KEYWORD") if labels else None


def run(spark, texts, keywords):
    rows = spark.createDataFrame(list(enumerate(texts)), "status_id int, text string")
    listed = [(p, org, k, der, tag) for k, (p, org, der, tag) in enumerate(keywords)]
    kw = spark.createDataFrame(listed, KEYWORD_DDL)
    return {r.status_id: (r.patterns, r.orgs) for r in patterns.match_patterns(rows, kw).collect()}


def test_rule(spark):
    keywords = [(0, "a", "Ann", "sun"), (0, "a", "Bob", "sun"), (1, "b", "ann", "rain"), (1, "b", "Cat", ""),
                (2, "c", "Ann", "sun"), (3, "d", "", "snow")]
    texts = ["ANN likes the SUN", "only sun", "cat and ann", "nothing", "snow", None, "bob sun ann"]
    got = run(spark, texts, keywords)
    assert got[0] == ("(Ann+sun) & (sun) & (ann) & (Ann+sun)", "a & c")
    assert got[1] == ("(sun)", "STREAM_KEYWORD")
    assert got[2] == ("(Ann) & (ann) & (Cat)", "STREAM_KEYWORD")
    assert 3 not in got and 5 not in got
    assert got[4] == ("(snow)", "STREAM_KEYWORD")
    assert got[6] == ("(Ann+sun) & (Bob+sun) & (ann) & (Ann+sun)", "a & c")


words = st.sampled_from(["ab", "B", "abc", "", "Ca", "c"])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("abcABC ", max_size=8), min_size=1, max_size=12),
       st.lists(st.tuples(st.integers(0, 2), words, words), min_size=1, max_size=8))
def test_against_loop(spark, texts, entries):
    entries.sort(key=lambda e: e[0])
    keywords = [(p, f"org{p}", der, tag) for p, der, tag in entries]
    want = {i: loop_match(t, [k[1:] for k in keywords]) for i, t in enumerate(texts)}
    assert run(spark, texts, keywords) == {i: w for i, w in want.items() if w}


def test_accepted_and_rejected_make_up_the_matches(spark):
    rows = spark.createDataFrame([(1, "x y"), (2, "x"), (3, "z")], "status_id int, text string")
    kw = spark.createDataFrame([(0, "o", 0, "x", "y")], KEYWORD_DDL)
    out = classify.classify_tracked(patterns.match_patterns(rows, kw))
    kinds = {r.status_id: (r.kind, r.original_user, r.derived_user) for r in out.collect()}
    assert kinds == {1: ("STATUS", "o", "(x+y)"), 2: ("REJECTED-STATUS", "STREAM_KEYWORD", "(x)")}


def test_reject_needs_the_tracker_batch(spark):
    rows = spark.createDataFrame(
        [("STREAM_TRACKER", None), ("STREAM_TRACKER", ""), ("STREAM_TRACKER", "STREAM_KEYWORD"),
         ("STREAM_TRACKER", "org"), ("batch", None)], "batch_name string, original_user string")
    got = [r[0] for r in rows.select(classify.is_rejected(F.col("batch_name"), F.col("original_user"))).collect()]
    assert got == [True, True, True, False, False]


def test_keyword_list_keeps_order_in_lists(spark):
    rows = [("o2", "u1", "t1", 1), ("o1", "u9", "t1", 2), ("o1", "u8", "t2", 1)]
    top = spark.createDataFrame(rows, "original_user string, derived_user string, hashtag string, position int")
    kw = patterns.pattern_keywords(top)
    tokens = [r.token for r in patterns.tracked_tokens(kw).orderBy("position").collect()]
    assert tokens == ["u8", "t2", "u9", "t1", "u1"]
    assert [r.list_no for r in patterns.tracked_tokens(kw, size=2).orderBy("position").collect()] == [0, 0, 1, 1, 2]
    order = spark.createDataFrame([("o2", 0), ("o1", 1)], "original_user string, org_pos int")
    kw = patterns.pattern_keywords(top, order)
    tokens = [r.token for r in patterns.tracked_tokens(kw).orderBy("position").collect()]
    assert tokens == ["u1", "t1", "u8", "t2", "u9"]


def test_long_lists_match_like_short_ones(spark):
    texts = B.texts(spark, SF).limit(60)
    texts = texts.unionByName(spark.createDataFrame([(-1, None, "x", "y"), (-2, "", "x", "y")], texts.schema))
    for keywords in (B.keywords(spark), B.long_keywords(spark, SF).limit(300)):
        short = patterns.match_patterns(texts, keywords).select("status_id", "patterns", "orgs")
        long = patterns.match_patterns_indexed(texts, keywords).select("status_id", "patterns", "orgs")
        assert sorted(map(tuple, long.collect())) == sorted(map(tuple, short.collect()))
    tokens = B.long_keywords(spark, SF).limit(200).select(F.col("der").alias("token"))
    want = sorted(r.status_id for r in patterns.track_filter(texts, tokens).collect())
    assert sorted(r.status_id for r in patterns.track_filter_indexed(texts, tokens).collect()) == want and want


def test_index_on_odd_tokens(spark):
    """Short, long, repeated and equal tokens, white space, other cases, empty and NULL ones, repeated rows."""
    keywords = [(0, "a", 0, "Ann", "sun"), (0, "a", 1, "bob", "SUN"), (0, "a", 1, "bob", "SUN"), (1, "b", 0, "ann", "sunshine"),
                (1, "b", 1, "x", "é"), (1, "b", 2, "two words", "sun"), (2, "c", 0, "", "n"), (2, "c", 1, None, "ann"),
                (2, "c", 2, "ann", "ann"), (3, "d", 0, " ", "\n"), (3, "d", 1, "o w", "  "), (3, "d", 2, "zz", "zzzzzzzzzz"),
                (4, "e", 0, "Bob", "sun"), (4, "a", 0, "sun", "bob"), (5, None, 0, "bob", "n"), (5, "f", 0, "🙂", "ann")]
    texts = ["ann SUNshine", "bob", "the sun, bob", "two  words sun", "two words\nSUN", "Ann bob sun zzzzzzzzzzz", "🙂 ann",
             "", None, " ", "x", "é x", "n", "nothing", "ann SUNshine", "  "]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, "bob"), (None, "bob sun"), (None, "sun"), (0, "ann SUNshine")]
    statuses = spark.createDataFrame(rows, "status_id int, text string").repartition(3)
    kw = spark.createDataFrame(keywords, KEYWORD_DDL)
    short = patterns.match_patterns(statuses, kw).collect()
    assert len(short) > 12
    long = patterns.match_patterns_indexed(statuses, kw).collect()
    assert sorted(map(tuple, long), key=repr) == sorted(map(tuple, short), key=repr)
    tokens = kw.select(F.col("der").alias("token")).filter("length(token) > 1")
    want, got = patterns.track_filter(statuses, tokens), patterns.track_filter_indexed(statuses, tokens)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_candidates_are_few(spark):
    """At ten times the tokens and five times the texts, candidates per text stay near those that occur."""
    for sf in (SF, SF.replace("0.001", "0.01")):
        texts, keywords = B.texts(spark, sf), B.long_keywords(spark, sf)
        near = patterns.candidate_tokens(patterns._with_key(texts), keywords.select(F.col("der").alias("token"))).cache()
        assert near.filter("NOT is_whole").count() == 0
        words = texts.select("status_id", F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))).alias("w"))
        exact = words.filter("length(w) BETWEEN 10 AND 11").count()
        assert exact <= near.count() < 2 * exact
        near.unpersist()


def test_top_hashtags_ties_filter_and_nulls(spark):
    rows = [("o", f"u{i}", "BATCH_TIMELINE", ["t"]) for i in range(7)]
    rows += [("o", "u6", "BATCH_TIMELINE", ["t", "t"]), ("o", "u0", "STREAM_TRACKER", ["t"] * 9),
             ("o", "u1", "BATCH_TIMELINE", [None]), ("p", "u1", "BATCH_TIMELINE", [])]
    df = spark.createDataFrame(rows, "original_user string, derived_user string, filter_type string, hashtags array<string>")
    got = [(r.derived_user, r.record_count) for r in hashtags.top_hashtags(df).orderBy("position").collect()]
    assert got == [("u6", 3), ("u0", 1), ("u1", 1), ("u2", 1), ("u3", 1)]
    only = spark.createDataFrame([("p",)], "original_user string")
    assert hashtags.top_hashtags(df, for_users=only).count() == 0


def test_weights(spark):
    counts = spark.createDataFrame([("a", 100), ("b", 10), ("c", 1), ("d", 100)], "pattern string, record_count bigint")
    got = {r.pattern: (r.mean_count, r.weight, r.font_size, r.is_most_used)
           for r in hashtags.pattern_weights(counts).collect()}
    assert got == {"a": (52, 57, 50, True), "b": (52, 5, 10, False), "c": (52, 0, 10, False), "d": (52, 57, 50, False)}
    zero = spark.createDataFrame([("a", 0)], "pattern string, record_count bigint")
    assert hashtags.pattern_weights(zero).first().weight is None


def test_count_jumps(spark):
    rows = [("a", 1, 5), ("a", 2, 15), ("a", 3, 24), ("b", 1, 100), ("b", 2, 150), ("c", 1, 10), ("c", 2, 20)]
    df = spark.createDataFrame(rows, "pattern string, day int, record_count bigint")
    got = sorted((r.pattern, r.day) for r in hashtags.count_jumps(df, "pattern", "day").collect())
    assert got == [("a", 2), ("c", 2)]


def test_long_lists_are_not_gathered_on_the_driver(spark):
    found = spark.range(10).selectExpr("id AS _key", "concat('t', id) AS token")
    listed = spark.range(10).selectExpr("concat('t', id) AS token", "id AS place")
    grams, index = found.selectExpr("_key", "xxhash64(token) AS gram"), listed.selectExpr("xxhash64(token) AS gram", "place")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for joined in (patterns._met(found, listed, ["token"], 100_000), patterns._gram_join(grams, index, 100_000)):
            assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
            assert sorted(r.place for r in joined.collect()) == list(range(10))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_long_lists_give_the_same_by_shuffles(spark, monkeypatch):
    rows = [(0, "ANN likes the SUN"), (1, "only sun"), (2, "cat and ann"), (3, None), (4, "bob sun ann"), (4, "bob sun ann")]
    texts = spark.createDataFrame(rows, "status_id int, text string")
    listed = [(0, "a", 0, "Ann", "sun"), (0, "a", 1, "Bob", "sun"), (1, "b", 2, "ann", "rain"), (2, "c", 3, "the sun", "ann")]
    kw = spark.createDataFrame(listed, KEYWORD_DDL)
    want = sorted(patterns.match_patterns(texts, kw).select("status_id", "patterns", "orgs").collect())
    monkeypatch.setattr(patterns, "BROADCAST_TOKENS", 0)
    assert sorted(patterns.match_patterns_indexed(texts, kw).select("status_id", "patterns", "orgs").collect()) == want


def test_long_lists_against_loop(spark, monkeypatch):
    """Many keywords that share labels and tokens in several spellings, so that whole matches pass their labels on."""
    dice = random.Random(7)
    tokens = ["ab", "AB", "abc", "bca", "c", "ca", "Cab", "bb", "bbc", "b c", "aa", "xyz", ""]
    keywords = [(k // 5, f"org{dice.randrange(6)}", dice.choice(tokens), dice.choice(tokens)) for k in range(45)]
    texts = ["".join(dice.choices("abcABC x", k=dice.randrange(14))) for _ in range(150)]
    kw = spark.createDataFrame([(p, org, k, der, tag) for k, (p, org, der, tag) in enumerate(keywords)], KEYWORD_DDL)
    rows = spark.createDataFrame(list(enumerate(texts)), "status_id int, text string")
    listed = [k[1:] for k in sorted(keywords, key=lambda k: k[:2])]  # by account, then in order
    got = {r.status_id: (r.patterns, r.orgs) for r in patterns.match_patterns_indexed(rows, kw).collect()}
    want = {i: loop_match(t, listed) for i, t in enumerate(texts)}
    assert got == {i: w for i, w in want.items() if w} and len(got) > 100
    monkeypatch.setattr(patterns, "LENGTHS", 1)  # tokens found by grams, no word sent
    monkeypatch.setattr(patterns, "FREQUENT_WORDS", 0)
    got = {r.status_id: (r.patterns, r.orgs) for r in patterns.match_patterns_indexed(rows, kw).collect()}
    assert got == {i: w for i, w in want.items() if w}
    monkeypatch.setattr(patterns, "LENGTHS", 16)
    monkeypatch.setattr(patterns, "SENT_ENTRIES", 0)  # all pieces by shuffle
    got = {r.status_id: (r.patterns, r.orgs) for r in patterns.match_patterns_indexed(rows, kw).collect()}
    assert got == {i: w for i, w in want.items() if w}


def test_written_tables_of_long_lists_follow_the_words(spark, monkeypatch):
    """Five times the texts with the same words: no table of texts with tokens is written, only lists and vocabulary."""
    written = []

    def counted(df, purpose):
        table = cut_lineage(df, purpose)
        written.append(table.count())
        return table

    monkeypatch.setattr(patterns, "cut_lineage", counted)
    texts = spark.createDataFrame([(i, f"word{i} others{i} common words here") for i in range(40)], "status_id int, text string")
    kw = spark.createDataFrame([(0, f"o{i}", i, f"word{i}", f"others{i}") for i in range(40)], KEYWORD_DDL)
    sizes = []
    for times in (1, 5):
        many = texts.crossJoin(spark.range(times)).selectExpr("CAST(status_id + 1000 * id AS int) AS status_id", "text")
        written.clear()
        assert patterns.match_patterns_indexed(many, kw).count() == 40 * times
        sizes.append(sum(written))
    assert sizes[0] == sizes[1]


def test_rows_that_come_often_are_matched_once(spark, monkeypatch):
    written = {}

    def counted(df, purpose):
        table = cut_lineage(df, purpose)
        written[purpose] = table.count()
        return table

    monkeypatch.setattr(patterns, "cut_lineage", counted)
    rows = [(1, "Ann likes the sun")] * 30 + [(None, "only sun")] * 2 + [(2, "nothing")]
    texts = spark.createDataFrame(rows, "status_id int, text string").repartition(3)
    kw = spark.createDataFrame([(0, "a", 0, "ann", "sun"), (0, "a", 1, "the", "")], KEYWORD_DDL)
    got = sorted(map(tuple, patterns.match_patterns_indexed(texts, kw).collect()), key=repr)
    assert got == sorted(map(tuple, patterns.match_patterns(texts, kw).collect()), key=repr) and len(got) == 32
    assert written["single-texts"] == 3
