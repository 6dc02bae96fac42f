"""Flattening, slots, hashtag rows and the wide layouts."""

import datetime as dt

from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.functions import text, times
from pulsegrid.operators import audit, classify, flatten, hashtags
from pulsegrid.operators.rollups import text_score

NOW = dt.datetime(2024, 1, 2, 3, 4, 5)


def landed_row(id, **values):
    row = dict(id=id, created_at=NOW, text="hello", in_reply_to_status_id=-1, in_reply_to_user_id=-1,
               current_user_retweet_id=-1, mentions=[], hashtags=[], user={"id": 7, "screen_name": "ann"})
    row.update(values)
    return row


def landed(spark, *rows):
    return spark.createDataFrame(list(rows), S.LANDED_STATUS_DDL)


def test_absent_values_and_nested_fields(spark):
    place = {"country": "X", "country_code": "x", "name": "town", "id": "p1", "street_address": None}
    rows = flatten.flatten_status(landed(
        spark, landed_row(1),
        landed_row(2, in_reply_to_status_id=1, in_reply_to_user_id=7, place=place,
                   geo={"latitude": 1.5, "longitude": -2.0},
                   retweeted_status={"id": 9, "user": {"id": 3, "screen_name": "bob"}}),
    ), F.lit("BATCH_TIMELINE"), ref_status_id=F.lit(-1))
    a, b = rows.orderBy("status_id").collect()
    assert (a.in_reply_to_status_id, a.in_reply_to_user_id, a.current_user_retweet_id, a.ref_status_id) == (None,) * 4
    assert (a.is_reply, a.is_retweet, a.place, a.latitude, a.retweeted_status_id) == (False, False, None, None, None)
    assert (b.is_reply, b.is_retweet, b.place.name, b.latitude, b.retweeted_status_id) == (True, True, "town", 1.5, 9)
    assert rows.schema.simpleString() == spark.createDataFrame([], S.STATUS_DDL).schema.simpleString()


def test_hashtag_rows(spark):
    df = spark.createDataFrame([(1, []), (2, None), (3, ["a"]), (4, ["a", "b", "a"])], "status_id int, hashtags array<string>")
    got = sorted((r.status_id, r.hashtag or "") for r in hashtags.expand_hashtags(df).collect())
    assert got == [(1, ""), (2, ""), (3, "a"), (4, "a"), (4, "a"), (4, "b")]


def test_slots_and_overflow(spark):
    rows = spark.createDataFrame([(n, [str(i) for i in range(n)]) for n in (0, 1, 12, 13)], "n int, a array<string>")
    out = rows.select("n", *flatten.entity_slots(F.col("a"), "s"), flatten.slot_overflow(F.col("a")).alias("over"))
    got = {r.n: (r.s_0, r.s_11, r.over) for r in out.collect()}
    assert got == {0: (None, None, 0), 1: ("0", None, 0), 12: ("0", "11", 0), 13: ("0", "11", 1)}
    nothing = spark.range(1).select(flatten.slot_overflow(F.lit(None).cast("array<string>")).alias("o"))
    assert nothing.first().o == 0


def test_wide_layouts(spark):
    assert len(S.wide_status_columns()) == 104 and len(S.wide_user_columns()) == 53
    mentions = [{"screen_name": f"m{i}", "id": i} for i in range(2)]
    df = landed(spark, landed_row(5, mentions=mentions, hashtags=["x", "y"], text="has null inside"))
    typed = flatten.flatten_status(df, F.lit("T"), load_time=F.lit(NOW))
    wide = flatten.wide_status(hashtags.expand_hashtags(typed))
    assert wide.columns == S.wide_status_columns()
    rows = wide.orderBy("statusHashtagEntity").collect()
    assert [r.statusHashtagEntity for r in rows] == ["x", "y"]
    r = rows[0]
    assert (r.statusText, r.statusCreatedAt, r.systemCreateDt, r.statusIsReply) == (
        "has null inside", "Tue Jan 02 03:04:05 UTC 2024", "02/01/2024-03:04:05", "false")
    assert (r.statusUserMentionScreenName_1, r.statusUserMentionId_1, r.statusUserMentionId_2) == ("m1", "1", None)
    users = flatten.wide_user(flatten.flatten_user(df, F.lit("T")))
    assert users.columns == S.wide_user_columns()
    assert users.first().userScreenName == "ann"


def test_friends_count_is_not_the_listed_count(spark):
    user = {"id": 1, "screen_name": "a", "friends_count": 10, "listed_count": 3}
    row = flatten.wide_user(flatten.flatten_user(landed(spark, landed_row(1, user=user)), F.lit("T"))).first()
    assert (row.userFriendsCount, row.userListedCount) == ("10", "3")


def test_mentions_and_tokens(spark):
    df = spark.createDataFrame([([("a", 1), ("b", 2)], "x+y"), ([], "+x++"), (None, "")],
                               "m array<struct<screen_name:string,id:bigint>>, p string")
    got = df.select(classify.mentioned_names(F.col("m")), text.split_pattern(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("a+b", ["x", "y"]), ("", ["x"]), (None, [])]


def test_long_dates(spark):
    df = spark.createDataFrame(
        [("Fri Oct 10 14:13:24 IST 2014",), ("Fri Oct 10 14:13:24 GMT 2014",), ("Fri Oct 10 14:13:24 ZZZ 2014",),
         ("garbage",), (None,)], "t string")
    got = [str(r[0]) if r[0] else None for r in df.select(times.parse_long_date(F.col("t"))).collect()]
    assert got == ["2014-10-10 08:43:24", "2014-10-10 14:13:24", None, None, None]


def test_batch_dates(spark):
    df = spark.createDataFrame([("23/09/2014-14:59:58",), ("",), ("nope",)], "t string")
    got = [r[0] for r in df.select(times.format_batch_time(times.parse_batch_time(F.col("t")))).collect()]
    assert got == ["23/09/2014-14:59:58", None, None]


def test_length_limit_counts_octets(spark):
    df = spark.createDataFrame([("a" * 500, "x"), ("a" * 501, "x"), ("é" * 250, "x"), ("é" * 251, None), (None, None)],
                               "t string, u string")
    got = [(r.longest, r.accepted) for r in audit.with_length_check(df).collect()]
    assert got == [(500, True), (501, False), (500, True), (502, False), (0, True)]


def test_scores(spark):
    df = spark.createDataFrame([("Good, good! bad\nGOOD",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(text_score(F.col("t"), {"good": 2, "bad": -1})).collect()]
    assert got == [5, 0, None]


def test_projection_names(spark):
    df = spark.createDataFrame([("n", "l", 3, 4)], "name string, location string, followers_count int, other int")
    assert flatten.project_names(df, "user", ["FollowersCount", "Name"]).columns == ["followers_count", "name"]
    try:
        flatten.project_names(df, "user", ["Nope"])
    except ValueError as error:
        assert "Nope" in str(error)
    else:
        raise AssertionError("unknown name accepted")


def test_record_limit(spark):
    rows = [(i, NOW + dt.timedelta(seconds=20 * (i // 2))) for i in range(60)]
    df = spark.createDataFrame(rows, "status_id int, created_at timestamp").repartition(4)
    for limit in (1, 7, 24, 60, 100):
        assert sorted(r.status_id for r in flatten.limit_records(df, limit).collect()) == list(range(min(limit, 60)))
