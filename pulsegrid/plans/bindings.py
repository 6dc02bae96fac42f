"""Status-shaped views of the given tables, by fixed deterministic rules.

``oracles`` repeats the same rules in DuckDB's dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid import schemas as S
from pulsegrid.operators.skew import spread_left_join
from pulsegrid.session import shared_dir
from pulsegrid.sources.landing import stream_table

# Ordered keyword list (org_pos, org, kw_pos, der, tag) with frequent and rare
# words, two accounts sharing a tag, mixed case, and one keyword without a tag.
KEYWORDS = [
    (0, "alpha", 0, "the", "and"),
    (0, "alpha", 1, "Elle", "tion"),
    (0, "alpha", 2, "queux", "mentau"),
    (1, "beta", 0, "der", "und"),
    (1, "beta", 1, "los", "tion"),
    (1, "beta", 2, "zzyzx", "ing"),
    (2, "gamma", 0, "THE", "und"),
    (2, "gamma", 1, "ción", ""),
    (3, "delta", 0, "xquer", "qzj"),
]

# Sentiment lexicon.
LEXICON = {
    "purchase": 3, "signup": 2, "click": 1, "error": -3,
    "the": 1, "and": 1, "of": -1, "la": 2, "de": -1, "le": -2, "der": 1, "und": -2, "que": 1, "los": -1,
}

STATUS_EXPRS = {
    "status_id": "event_id",
    "user_id": "user_id",
    "screen_name": "concat('u', user_id)",
    "original_user": "concat('org', user_id % 10)",
    "derived_user": "concat('u', user_id)",
    "batch_name": "concat('batch', user_id % 3)",
    "event_type": "event_type",
    "created_at": "ts",
    "k": "k",
    "filter_type": """CASE event_type WHEN 'error' THEN 'STREAM_TRACKER' WHEN 'view' THEN 'STREAM_TIMELINE'
        WHEN 'purchase' THEN 'STREAM_REFERENCE' ELSE 'BATCH_TIMELINE' END""",
    "hashtags": "slice(array(concat('h', k % 7), concat('h', k % 5), concat('h', k % 3)), 1, k % 4)",
    "mentions": """transform(slice(sequence(0, 13), 1, if(k = 97, 14, k % 5)), i -> named_struct(
        'screen_name', concat('u', (user_id + 3 * i + k) % 150), 'id', (user_id + 3 * i + k) % 150))""",
    "retweeted_status_id": "if(k % 3 = 0 AND event_id > k, event_id - k - 1, NULL)",
    "in_reply_to_status_id": "if(k % 5 = 1 AND event_id > k, event_id - k - 1, NULL)",
}
STATUS_TEXT = """concat(event_type, ' by @', screen_name,
    array_join(transform(mentions, m -> concat(' @', m.screen_name)), ''),
    array_join(transform(hashtags, h -> concat(' #', h)), ''))"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_to_statuses(events: DataFrame) -> DataFrame:
    """Works on a table and on a stream; unused columns are pruned down to the scan."""
    # json_tuple parses once per row; a JSON path expression would be copied into every filter.
    parsed = events.select("*", F.json_tuple("props", "k").alias("k"))
    keyed = parsed.withColumn("k", F.col("k").cast("int"))
    return keyed.selectExpr(*[f"{e} AS {n}" for n, e in STATUS_EXPRS.items()]).withColumn(
        "text", F.expr(STATUS_TEXT)
    )


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_statuses(table(spark, sf_dir, "events"))


def event_files(spark: SparkSession, sf_dir: str, parts: int = 6, first: str | None = None) -> str:
    """``events`` in several files of a new shared folder, dealt by a hash of the id: in no order of time."""
    events = table(spark, sf_dir, "events")
    path = shared_dir(spark, "event-files")
    events = events.filter(first) if first else events
    events.repartition(parts, F.xxhash64("event_id")).write.parquet(path)
    return path


def status_stream(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """The statuses as a stream of files, one per micro-batch; event time needs a zoned timestamp there."""
    schema = table(spark, sf_dir, "events").schema
    events = stream_table(spark, path or event_files(spark, sf_dir), "*.parquet", schema, max_files=1)
    return events_to_statuses(events).withColumn("created_at", F.col("created_at").cast("timestamp"))


def replying_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses with the author of the status they reply to (NULL for other statuses)."""
    rows = statuses(spark, sf_dir)
    parents = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("in_reply_to_status_id"), F.col("user_id").alias("in_reply_to_user_id")
    )
    # Most statuses are no replies: they never match, and are not gathered under their missing key.
    joined = spread_left_join(rows, parents, "in_reply_to_status_id", ["status_id", "user_id", "created_at"])
    return joined.select(*rows.columns, "in_reply_to_user_id")


def landed_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested records as a source lands them: -1 for absent ids, NULL for absent structs."""
    rows = replying_statuses(spark, sf_dir)
    place = """named_struct('country', concat('C', user_id % 25), 'country_code', concat('c', user_id % 25),
        'name', concat('city', k), 'id', concat('p', k), 'street_address', CAST(NULL AS string))"""
    user = ", ".join(
        f"'{f}', {USER_EXPRS[f] if f in ('id', 'screen_name') else f'CAST(NULL AS {_user_type(f)})'}"
        for f in S.USER_FIELDS
    )
    return rows.selectExpr(
        "status_id AS id", "created_at", "element_at(array('en', 'fr', 'de'), k % 3 + 1) AS lang",
        "concat('app', k % 4) AS source", "text", "CAST(k % 9 AS bigint) AS favorite_count",
        "CAST(k % 6 AS bigint) AS retweet_count", "CAST(-1 AS bigint) AS current_user_retweet_id",
        "coalesce(in_reply_to_user_id, -1) AS in_reply_to_user_id",
        "coalesce(in_reply_to_status_id, -1) AS in_reply_to_status_id",
        "concat('u', in_reply_to_user_id) AS in_reply_to_screen_name",
        "k % 2 = 0 AS favorited", "k = 13 AS possibly_sensitive", "k % 8 = 7 AS retweeted",
        "k > 95 AS truncated",
        """if(retweeted_status_id IS NULL, NULL, named_struct('id', retweeted_status_id,
            'user', named_struct('id', CAST(NULL AS bigint), 'screen_name', CAST(NULL AS string))))
            AS retweeted_status""",
        "if(k % 10 = 5, named_struct('latitude', k / 4.0D, 'longitude', -k / 2.0D), NULL) AS geo",
        f"if(k % 4 = 0, {place}, NULL) AS place",
        "if(k % 11 = 0, array(user_id, user_id + 1), NULL) AS contributors",
        "if(k % 6 = 0, array(concat('http://m/', k)), NULL) AS media_urls",
        "if(k % 7 = 3, array(concat('S', k)), array()) AS symbols",
        "transform(slice(sequence(0, 1), 1, k % 3), i -> concat('http://l/', k, '/', i)) AS urls",
        "mentions",
        "if(k % 13 = 0, named_struct('place_ids', array(concat('p', k), concat('p', k + 1))), NULL) AS scopes",
        "hashtags", f"named_struct({user}, 'description_urls', CAST(NULL AS array<string>)) AS user",
        "filter_type", "original_user", "derived_user",
    )


def _user_type(field: str) -> str:
    return S._USER_TYPES.get(field, "string")


USER_EXPRS = {
    "name": "c_name", "id": "user_id", "location": "c_mktsegment",
    "created_at": "timestamp_ntz'2010-01-01 00:00:00' + make_dt_interval(CAST(user_id AS int))",
    "lang": "if(user_id % 2 = 0, 'en', 'fr')", "screen_name": "concat('u', user_id)",
    "time_zone": "concat('tz', c_nationkey)",
    "url": "if(user_id % 3 = 0, concat('http://u/', user_id), NULL)",
    "favourites_count": "user_id * 2", "followers_count": "user_id * 3",
    "friends_count": "user_id + 1", "listed_count": "user_id % 7",
    "statuses_count": "status_count", "utc_offset": "CAST((user_id % 24 - 12) * 3600 AS int)",
}
PROFILE_FIELDS = [f for f in S.USER_FIELDS if f not in USER_EXPRS]
USER_EXPRS.update(
    {f: f"if((user_id + {i}) % 5 = 0, NULL, concat('{f}/', user_id))" for i, f in enumerate(PROFILE_FIELDS)}
)
USER_URLS = "transform(slice(sequence(0, 3), 1, CAST(user_id % 4 AS int)), i -> concat('http://d/', user_id, '/', i))"


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One author record per user of ``events``, completed from ``customer``."""
    authors = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("status_count"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_name", "c_nationkey", "c_mktsegment"
    )
    return authors.join(customers, "user_id", "left").selectExpr(
        *[f"{USER_EXPRS[f]} AS {f}" for f in S.USER_FIELDS], f"{USER_URLS} AS description_urls"
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time-zone table; zones of every seventh nation are unmapped."""
    return table(spark, sf_dir, "nation").filter("n_nationkey % 7 <> 6").selectExpr(
        "concat('tz', n_nationkey) AS src_timezone", "n_name AS country"
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, screen_name, original_user) of the users that belong to an account's team."""
    return table(spark, sf_dir, "events").select("user_id").distinct().selectExpr(
        "user_id", "concat('u', user_id) AS screen_name", "concat('org', user_id % 10) AS original_user"
    )


def watched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(batch_name, screen_name) of the watched users."""
    return accounts(spark, sf_dir).filter("user_id % 4 = 0").selectExpr(
        "concat('batch', user_id % 3) AS batch_name", "screen_name", "user_id"
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS status_id", "text", "lang", "source"
    )


def dated_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with the author and time of the event of the same number, if there is one."""
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id AS status_id", "concat('u', user_id) AS user_code", "ts AS created_at"
    )
    return texts(spark, sf_dir).join(events, "status_id", "left")


def keywords(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({p}, '{org}', {k}, '{der}', '{tag}')" for p, org, k, der, tag in KEYWORDS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS kw(org_pos, org, kw_pos, der, tag)")


def long_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyword for every longer word of the texts: the word, and its first or last letters."""
    words = table(spark, sf_dir, "documents").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word"))
    listed = words.filter("length(word) BETWEEN 10 AND 11").distinct()
    return listed.selectExpr(
        "0 AS org_pos", "word AS org", "0 AS kw_pos", "word AS der",
        "if(length(word) % 2 = 0, substring(word, 1, 6), reverse(word)) AS tag",
    )


def landed_records(spark: SparkSession, sf_dir: str, retweets: bool = False) -> DataFrame:
    """``events`` in the landed schema, with the ids and texts that the jobs use.

    With ``retweets`` they hold the record of the retweeted status, else no references.
    """
    rows = statuses(spark, sf_dir)
    if retweets:
        inner = table(spark, sf_dir, "events").selectExpr("event_id AS retweeted_status_id", "user_id AS inner_user")
        rows = spread_left_join(rows, inner, "retweeted_status_id", ["status_id", "user_id", "created_at"])
    given = {
        "id": F.col("status_id"), "created_at": F.col("created_at").cast("timestamp"), "text": F.col("text"),
        "hashtags": F.col("hashtags"), "mentions": F.col("mentions"),
    }
    user = {"id": F.col("user_id"), "screen_name": F.col("screen_name")}
    schema = T.DataType.fromDDL(S.LANDED_STATUS_DDL)

    def value(field, known):
        if field.name == "user":
            return F.struct(*[value(f, user).alias(f.name) for f in field.dataType.fields])
        return known.get(field.name, F.lit(None)).cast(field.dataType)

    if retweets:
        kind = schema["retweeted_status"].dataType
        known = {"id": F.col("retweeted_status_id"), "text": F.lit("inside")}
        author = {"id": F.col("inner_user"), "screen_name": F.concat(F.lit("u"), F.col("inner_user"))}
        of_author = F.struct(*[value(f, author).alias(f.name) for f in kind["user"].dataType.fields])
        inside = F.struct(*[
            (of_author if f.name == "user" else value(f, known)).alias(f.name) for f in kind.fields
        ])
        given["retweeted_status"] = F.when(F.col("inner_user").isNotNull(), inside)
    return rows.select(*[value(f, given).alias(f.name) for f in schema.fields], "batch_name")


def threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as reply chains: each turn replies to the previous one."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id * 1000 + turn AS status_id", "turn AS created_at", "role AS screen_name",
        "if(turn > 0, conv_id * 1000 + turn - 1, NULL) AS in_reply_to_status_id",
    )
