"""The registered queries: (spark, folder of the given tables) -> DataFrame."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.functions.times import (
    format_batch_time, hour_stamp, long_date_text, parse_batch_time, parse_long_date,
)
from pulsegrid.functions.text import one_line, split_pattern, words
from pulsegrid.operators import (
    audit, classify, dedupe, flatten, hashtags, incremental, lineage, patterns, registry, rollups,
)
from pulsegrid.plans import bindings as B
from pulsegrid.plans import refresh
from pulsegrid.plans.backfill import Store, ready_batches, run_backfill
from pulsegrid.plans.live import has_ended, run_to_end, start_live
from pulsegrid.session import cut_lineage, shared_dir, use_utc
from pulsegrid.sinks.delimited import delimited_line, write_delimited
from pulsegrid.sinks.landing import land
from pulsegrid.sinks.load import load_files
from pulsegrid.sinks.routed import with_bucket, write_routed
from pulsegrid.sources import batch_config
from pulsegrid.sources.batch_config import batch_settings
from pulsegrid.sources.delimited import read_delimited
from pulsegrid.sources.history import History
from pulsegrid.sources.landing import read_landed, stream_folders
from pulsegrid.streaming import flows

REGISTRY = {}

# Date bounds used by the registered queries.
RANGE_START = "2024-01-05 06:00:00"
RANGE_END = "2024-01-21 18:30:00"
HALF_DAY = "2024-01-01 12:00:00"
STREAM_SPLIT = "2024-01-15 00:00:00"
RECORD_LIMIT = 700
MARK_START = "2024-01-08 00:00:00"
MARK_END = "2024-01-20 00:00:00"


def query(function):
    """Register under the function's name and pin the session zone before planning."""
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_utc(spark)
        return function(spark, sf_dir)

    REGISTRY[function.__name__] = run
    return run


def _time(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _id_or_absent(column, name: str):
    """Absent numbers as -1, so that a result column has no NULLs among integers."""
    return F.coalesce(column, F.lit(-1).cast("bigint")).alias(name)


def _big(name: str):
    return F.col(name).cast("bigint").alias(name)


# -- hashtags -------------------------------------------------------------------------


@query
def top_hashtags_per_org(spark, sf_dir):
    return hashtags.top_hashtags(B.statuses(spark, sf_dir)).select(
        "original_user", "derived_user", "hashtag", "record_count", _big("position")
    )


@query
def hashtag_normalize(spark, sf_dir):
    rows = B.statuses(spark, sf_dir).select("status_id", "hashtags")
    return hashtags.expand_hashtags(rows)


def _top_pairs(spark, sf_dir):
    return hashtags.top_hashtags(B.statuses(spark, sf_dir))


def _org_hashtag_pairs(spark, sf_dir):
    """Pairs whose pattern is shared by accounts: the user part is the batch, not the user."""
    rows = B.statuses(spark, sf_dir).withColumn("derived_user", F.col("batch_name"))
    return hashtags.top_hashtags(rows)


@query
def pattern_record_counts(spark, sf_dir):
    return hashtags.pattern_counts(_org_hashtag_pairs(spark, sf_dir))


@query
def pattern_weights(spark, sf_dir):
    counts = hashtags.pattern_counts(_org_hashtag_pairs(spark, sf_dir))
    return hashtags.pattern_weights(counts).select(
        "pattern", "record_count", _big("mean_count"), _big("weight"), _big("font_size"), "is_most_used"
    )


@query
def fluctuation_alert(spark, sf_dir):
    daily = (
        B.statuses(spark, sf_dir)
        .select("original_user", F.date_format("created_at", "yyyy-MM-dd").alias("day"),
                F.explode("hashtags").alias("hashtag"))
        .groupBy(F.concat_ws("+", "original_user", "hashtag").alias("pattern"), "day")
        .agg(F.count("*").alias("record_count"))
    )
    return hashtags.count_jumps(daily, "pattern", "day")


# -- flattening -----------------------------------------------------------------------


def _flattened(spark, sf_dir):
    landed = B.landed_statuses(spark, sf_dir)
    return flatten.flatten_status(
        landed, F.col("filter_type"), F.col("original_user"), F.col("derived_user"),
        load_time=F.expr("created_at + interval 5 minutes"),
    )


@query
def status_flatten(spark, sf_dir):
    return flatten.wide_status(hashtags.expand_hashtags(_flattened(spark, sf_dir)))


@query
def status_retype(spark, sf_dir):
    flat = _flattened(spark, sf_dir)
    wide = flatten.wide_status(hashtags.expand_hashtags(flat))
    return _retyped(flatten.typed_status(wide, flatten.wide_overflow(flat)))


def _retyped(rows):
    return rows.select(
        "status_id", "user_id", "hashtag", format_batch_time(F.col("created_at")).alias("created_text"),
        format_batch_time(F.col("system_create_ts")).alias("loaded_text"),
        _id_or_absent(F.col("in_reply_to_status_id"), "in_reply_to_status_id"),
        "is_reply", _id_or_absent(F.col("retweeted_status_id"), "retweeted_status_id"),
        _id_or_absent((F.col("latitude") * 4).cast("bigint"), "latitude_quarters"),
        F.col("place.name").alias("place_name"), F.size("mentions").cast("bigint").alias("mention_count"),
        _id_or_absent(F.get("mentions", F.lit(0))["id"], "first_mention_id"),
        _id_or_absent(F.get("contributors", F.lit(1)), "second_contributor"), F.array_join("urls", " ").alias("urls"),
        F.array_join("mentions.screen_name", " ").alias("mention_names"),
        F.array_join("scope_place_ids", " ").alias("scope_place_ids"),
    )


@query
def user_flatten(spark, sf_dir):
    landed = B.users(spark, sf_dir).select(F.struct("*").alias("user"))
    rows = flatten.flatten_user(
        landed, F.lit(S.BATCH_TIMELINE), F.concat(F.lit("org"), F.col("user.id") % 10),
        F.col("user.screen_name"), F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"),
    )
    return flatten.wide_user(rows)


@query
def entities_to_columns(spark, sf_dir):
    rows = B.texts(spark, sf_dir).withColumn("tokens", F.split(F.lower("text"), " "))
    return rows.select(
        "status_id", *flatten.entity_slots(F.col("tokens"), "token"),
        flatten.slot_overflow(F.col("tokens")).cast("bigint").alias("overflow"),
    )


@query
def scope_places(spark, sf_dir):
    rows = _flattened(spark, sf_dir).filter(F.col("scope_place_ids").isNotNull())
    return rows.select(
        "status_id", *flatten.entity_slots(F.col("scope_place_ids"), "statusScopePlaceIds"),
        flatten.slot_overflow(F.col("mentions")).cast("bigint").alias("mention_overflow"),
    )


@query
def project_by_config(spark, sf_dir):
    rows = B.statuses(spark, sf_dir).withColumn("favorite_count", (F.col("k") % 9).cast("bigint"))
    return flatten.project_names(rows, "status", ["Id", "Text", "FavoriteCount"])


@query
def wide_overflow(spark, sf_dir):
    rows = flatten.wide_overflow(_flattened(spark, sf_dir))
    return rows.select("status_id", "entity", _big("position"), "value")


@query
def records_limit(spark, sf_dir):
    rows = B.statuses(spark, sf_dir).select("status_id", "created_at", "screen_name")
    return flatten.limit_records(rows, RECORD_LIMIT).select("status_id", "screen_name")


# -- classification and patterns ------------------------------------------------------


@query
def status_classify(spark, sf_dir):
    rows = classify.classify_followed(
        B.statuses(spark, sf_dir), B.watched(spark, sf_dir), B.accounts(spark, sf_dir)
    )
    return rows.select("status_id", "batch_name", "filter_type", "original_user", "derived_user", "kind")


@query
def pattern_match(spark, sf_dir):
    rows = patterns.match_patterns(B.texts(spark, sf_dir), B.keywords(spark))
    return rows.select("status_id", "patterns", "orgs")


@query
def tracker_reject_split(spark, sf_dir):
    rows = classify.classify_tracked(patterns.match_patterns(B.texts(spark, sf_dir), B.keywords(spark)))
    return rows.withColumn("user_kind", classify.user_kind(F.col("batch_name"), F.col("original_user"))).select(
        "status_id", "filter_type", "derived_user", "original_user", "kind", "user_kind"
    )


@query
def keyword_tokens(spark, sf_dir):
    tokens = patterns.tracked_tokens(patterns.pattern_keywords(_top_pairs(spark, sf_dir)))
    return tokens.select(_big("list_no"), _big("position"), "token")


@query
def long_keyword_tokens(spark, sf_dir):
    """Far more tokens than one stream tracks: they fill several lists."""
    return patterns.tracked_tokens(B.long_keywords(spark, sf_dir)).select(_big("list_no"), _big("position"), "token")


@query
def long_pattern_match(spark, sf_dir):
    """Thousands of keywords, by the grams that their tokens start with."""
    rows = patterns.match_patterns_indexed(B.texts(spark, sf_dir), B.long_keywords(spark, sf_dir))
    return rows.select("status_id", "patterns", "orgs")


@query
def long_track_filter(spark, sf_dir):
    tokens = B.long_keywords(spark, sf_dir).filter("length(der) >= 11").select(F.col("der").alias("token"))
    return patterns.track_filter_indexed(B.texts(spark, sf_dir), tokens).select("status_id")


@query
def track_filter(spark, sf_dir):
    tokens = patterns.tracked_tokens(patterns.pattern_keywords(_top_pairs(spark, sf_dir)))
    return patterns.track_filter(B.statuses(spark, sf_dir), tokens).select("status_id", "text")


@query
def pattern_tokens(spark, sf_dir):
    pairs = _top_pairs(spark, sf_dir).select(hashtags.pattern_key().alias("pattern"))
    return pairs.select("pattern", F.explode(split_pattern(F.col("pattern"))).alias("token"))


# -- users and follow lists -----------------------------------------------------------


def _found_users(spark, sf_dir):
    """Back-fill statuses: their authors are the users a batch discovers."""
    return B.statuses(spark, sf_dir).filter(F.col("filter_type") == S.BATCH_TIMELINE)


@query
def user_registry(spark, sf_dir):
    rows = registry.register_users(_found_users(spark, sf_dir).withColumn(
        "original_user", F.concat(F.lit("org"), F.col("k") % 10)))
    return rows.select(
        "batch_name", "screen_name", "user_id", "original_user",
        F.col("first_seen.status_id").alias("first_status_id"),
        F.col("last_seen.status_id").alias("last_status_id"),
    )


@query
def account_map(spark, sf_dir):
    rows = registry.register_users(_found_users(spark, sf_dir).withColumn(
        "original_user", F.concat(F.lit("org"), F.col("k") % 10)))
    return registry.account_map(rows)


@query
def follow_list(spark, sf_dir):
    ids = B.accounts(spark, sf_dir).select("screen_name", "user_id")
    rows = registry.follow_list(
        B.watched(spark, sf_dir), registry.register_users(_found_users(spark, sf_dir)), ids
    )
    return rows.select("batch_name", _big("list_no"), _big("position"), "screen_name", "user_id")


@query
def follow_filter(spark, sf_dir):
    ids = B.accounts(spark, sf_dir).select("screen_name", "user_id")
    followed = registry.follow_list(
        B.watched(spark, sf_dir), registry.register_users(_found_users(spark, sf_dir)), ids
    )
    return registry.follow_filter(B.statuses(spark, sf_dir), followed).select("status_id", "batch_name", "user_id")


@query
def user_first_seen(spark, sf_dir):
    rows = B.statuses(spark, sf_dir).select("screen_name", "created_at", "status_id", "filter_type")
    return dedupe.first_per_user(rows).select("screen_name", "status_id", "filter_type")


@query
def user_anti_processed(spark, sf_dir):
    rows = B.statuses(spark, sf_dir).select("screen_name", "created_at", "status_id", "filter_type")
    processed = classify.within_cutoffs(rows, latest=_time(HALF_DAY)).select("screen_name").distinct()
    return dedupe.new_users(rows, processed).select("screen_name", "status_id")


@query
def status_anti_processed(spark, sf_dir):
    rows = B.statuses(spark, sf_dir).select("status_id", "retweeted_status_id")
    processed = rows.select(F.col("retweeted_status_id").alias("status_id")).filter("status_id IS NOT NULL")
    return dedupe.new_statuses(rows, processed).select("status_id")


# -- back-fill state ------------------------------------------------------------------


@query
def cutoff_filter(spark, sf_dir):
    rows = classify.within_cutoffs(B.statuses(spark, sf_dir), _time(RANGE_START), _time(RANGE_END))
    return rows.select("status_id", format_batch_time(F.col("created_at")).alias("created_text"))


@query
def user_watermarks(spark, sf_dir):
    return incremental.user_watermarks(B.statuses(spark, sf_dir))


@query
def incremental_extract(spark, sf_dir):
    rows = B.statuses(spark, sf_dir).select("status_id", "screen_name", "created_at")
    fetched = classify.within_cutoffs(rows.filter("screen_name NOT LIKE '%3'"), _time(MARK_START), _time(MARK_END))
    return incremental.beyond_watermarks(rows, incremental.user_watermarks(fetched)).select(
        "status_id", "screen_name", "direction"
    )


def _modes(spark, sf_dir):
    rows = B.statuses(spark, sf_dir)
    users = B.accounts(spark, sf_dir).selectExpr("concat('batch', user_id % 7) AS batch_name", "screen_name")
    return users, incremental.paging_modes(users, rows, _time(HALF_DAY))


@query
def user_paging_mode(spark, sf_dir):
    return _modes(spark, sf_dir)[1]


@query
def batch_mode(spark, sf_dir):
    return incremental.finished_batches(_modes(spark, sf_dir)[1])


@query
def unfinished_users(spark, sf_dir):
    users, modes = _modes(spark, sf_dir)
    return incremental.without_finished_users(users, modes)


@query
def cutoff_advance(spark, sf_dir):
    loaded = classify.within_cutoffs(B.statuses(spark, sf_dir), latest=_time(MARK_END))
    state = B.statuses(spark, sf_dir).groupBy("batch_name").agg(
        F.expr("""CASE batch_name WHEN 'batch0' THEN timestamp_ntz'2024-01-25 10:00:00'
                  WHEN 'batch1' THEN timestamp_ntz'2024-01-02 10:00:00' END""").alias("cutoff_min")
    )
    return incremental.advance_cutoffs(state, loaded)


def _definition_texts(spark, sf_dir):
    """Batch definitions of at most 20 users each, derived from the users of ``events``."""
    groups = (
        B.accounts(spark, sf_dir)
        .selectExpr("concat('batch', user_id % 3, '-', user_id div 60) AS name", "user_id", "screen_name")
        .groupBy("name").agg(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("user_id", "screen_name"))), lambda u: u["screen_name"]), ",").alias("names"),
            F.min("user_id").alias("lowest"))
    )
    return groups.select(batch_config.definition_text({
        "batchRunStartTime": F.lit(""),
        "batchCutOffMaxDate": F.when(F.col("lowest") % 2 == 0, "21/01/2024-18:30:00").otherwise(""),
        "batchName": F.col("name"),
        "batchCutOffMinDate": F.lit("05/01/2024-06:00:00"),
        "batchTrackStream": F.when(F.col("lowest") % 3 == 0, "true").otherwise("false"),
        "userNames": F.concat(F.lit(","), F.col("names"), F.lit(",,")),
        "dateFormat": F.lit("dd/MM/yyyy-HH:mm:ss"),
        "batchRefLevel": F.lit("5"),
    }).alias("definition"))


@query
def batch_config_users(spark, sf_dir):
    definitions = batch_config.parse_batch_definitions(_definition_texts(spark, sf_dir), "definition")
    return batch_config.watched_users(definitions).select("batch_name", _big("position"), "screen_name")


@query
def batch_config_settings(spark, sf_dir):
    definitions = batch_config.parse_batch_definitions(_definition_texts(spark, sf_dir), "definition")
    return batch_config.batch_settings(definitions).select(
        "batch_name", format_batch_time(F.col("cutoff_min")).alias("cutoff_min"),
        format_batch_time(F.col("cutoff_max")).alias("cutoff_max"), "track_stream", _big("ref_level"),
        F.col("start_time").isNull().alias("starts_now"),
    )


@query
def definition_advance(spark, sf_dir):
    definitions = batch_config.parse_batch_definitions(_definition_texts(spark, sf_dir), "definition")
    loaded = B.statuses(spark, sf_dir).selectExpr(
        "concat('batch', user_id % 3, '-', user_id div 60) AS batch_name", "created_at")
    advanced = refresh.advance_definitions(definitions, loaded)
    texts = advanced.select(batch_config.definition_text({c: F.col(c) for c in advanced.columns}).alias("definition"))
    return batch_config.parse_batch_definitions(texts, "definition").select(
        F.col("batchName").alias("batch_name"), F.col("batchCutOffMinDate").alias("cutoff_min"),
        F.col("batchCutOffMaxDate").alias("cutoff_max"),
    )


# -- lineage --------------------------------------------------------------------------


@query
def retweet_lineage(spark, sf_dir):
    rows = lineage.retweet_lineage(B.statuses(spark, sf_dir))
    return rows.select("origin_id", "ref_status_id", "status_id", _big("level"))


@query
def retweet_unroll(spark, sf_dir):
    rows = B.statuses(spark, sf_dir).drop("mentions", "hashtags")
    return lineage.unroll_retweets(rows).select(
        "origin_id", "ref_status_id", "status_id", "screen_name", "filter_type", "original_user"
    )


@query
def embedded_unroll(spark, sf_dir):
    """Only even statuses landed; of the odd ones there is what came inside retweets."""
    rows = B.statuses(spark, sf_dir).drop("mentions", "hashtags")
    landed = rows.filter("status_id % 2 = 0")
    inside = landed.select(F.col("retweeted_status_id").alias("status_id")).distinct()
    embedded = rows.join(inside, "status_id", "left_semi")
    return lineage.unroll_retweets(landed, embedded=embedded).select(
        "origin_id", "ref_status_id", "status_id", "screen_name", "filter_type", "original_user"
    )


@query
def reply_lookup(spark, sf_dir):
    rows = B.statuses(spark, sf_dir).select("status_id", "created_at", "in_reply_to_status_id", "screen_name")
    return lineage.reply_parents(rows, rows).select("status_id", "ref_status_id", "screen_name")


@query
def reply_threads(spark, sf_dir):
    rows = B.threads(spark, sf_dir)
    seeds = rows.filter(F.col("screen_name") == "user")
    return lineage.reply_threads(seeds, rows).select("status_id", "ref_status_id", _big("level"))


# -- files and loads ------------------------------------------------------------------


@query
def length_reject(spark, sf_dir):
    return audit.with_length_check(B.texts(spark, sf_dir)).select("status_id", _big("longest"), "accepted")


@query
def load_audit(spark, sf_dir):
    rows = B.texts(spark, sf_dir).withColumn("file_name", audit.source_file())
    return audit.load_counts(audit.with_length_check(rows))


@query
def delimited_roundtrip(spark, sf_dir):
    path = shared_dir(spark, "delimited")
    rows = B.texts(spark, sf_dir).withColumn("note", F.expr(
        "CASE status_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('a\\\\', status_id, '\"~null') END"))
    write_delimited(rows, path)
    back = read_delimited(spark, path, rows.columns)
    return back.select(F.col("status_id").cast("bigint").alias("status_id"), "text", "lang", "source", "note")


@query
def one_line_text(spark, sf_dir):
    return B.texts(spark, sf_dir).select("status_id", one_line(F.col("text")).alias("text"))


@query
def roll_windows(spark, sf_dir):
    rows = with_bucket(B.statuses(spark, sf_dir).select("created_at", "batch_name"))
    return rows.groupBy("batch_name", "bucket").agg(F.count("*").alias("record_count"))


@query
def routed_write(spark, sf_dir):
    """Follow and keyword stream, statuses and their authors: four kinds below their batches."""
    rows = B.statuses(spark, sf_dir)
    keywords = patterns.pattern_keywords(_top_pairs(spark, sf_dir))
    tracked = classify.classify_tracked(
        patterns.match_patterns(rows.filter(F.col("filter_type") == S.STREAM_TRACKER), keywords))
    followed = classify.classify_followed(
        rows.filter(F.col("filter_type") != S.STREAM_TRACKER), B.watched(spark, sf_dir), B.accounts(spark, sf_dir))
    columns = ["status_id", "created_at", "batch_name", "kind", "screen_name", "original_user"]
    found = followed.select(columns).unionByName(tracked.select(columns))
    authors = dedupe.one_per_status(
        found.withColumn("kind", classify.user_kind(F.col("batch_name"), F.col("original_user"))),
        ("batch_name", "kind", "screen_name"),
    )
    path = shared_dir(spark, "routed")
    routed = found.unionByName(authors).drop("screen_name", "original_user")
    write_routed(with_bucket(routed, interval="1 day"), path)
    return spark.read.parquet(path).groupBy("batch_name", "kind", F.col("bucket").cast("string").alias("bucket")).agg(
        F.count("*").alias("record_count"), F.sum("status_id").alias("id_sum")
    )


def _delimited_lines(spark, sf_dir):
    """The texts as lines of a file, every seventh also as a line with one field only, and every ninth with five."""
    rows = one_line(F.col("text"))
    columns = ["status_id", "text", "lang", "source"]
    line = delimited_line(columns)
    short = F.when(F.col("status_id") % 7 == 0, F.array(F.concat(F.lit('"'), F.col("status_id"), F.lit('"'))))
    more = F.when(F.col("status_id") % 9 == 0, F.array(F.concat(line, F.lit('~"x"'))))
    none = F.array().cast("array<string>")
    texts = B.texts(spark, sf_dir).withColumn("text", rows)
    return texts.select("status_id", F.explode(F.concat(
        F.array(line), F.coalesce(short, none), F.coalesce(more, none))).alias("value"))


def _write_with_headers(lines, columns, path):
    """Files of the lines, one per partition that has any, each with the header at its head."""
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # place within the partition
    header = F.when(at == 0, F.concat(F.lit("~".join(columns) + "\n"), "value"))
    lines.select(F.coalesce(header, "value").alias("value")).write.text(path)


@query
def load_runs(spark, sf_dir):
    """Two folders of files, loaded twice: what the tables hold, and what the second load adds."""
    root = shared_dir(spark, "load-runs")
    lines = _delimited_lines(spark, sf_dir)
    columns = ["status_id", "text", "lang", "source"]
    for name, part in (("one", "status_id % 2 = 0"), ("two", "status_id % 2 = 1")):
        _write_with_headers(lines.filter(part), columns, f"{root}/in/{name}")
    first = load_files(spark, f"{root}/in", f"{root}/table", f"{root}/audit", columns)
    again = load_files(spark, f"{root}/in", f"{root}/table", f"{root}/audit", columns)
    table, rejects = spark.read.parquet(f"{root}/table"), spark.read.parquet(f"{root}/table-rejects")
    size = F.sum(F.col("status_id").cast("bigint"))
    return (
        table.agg(F.lit("accepted").alias("outcome"), F.count("*").alias("rows"), size.alias("id_sum"))
        .unionByName(rejects.groupBy(F.col("reason").alias("outcome")).agg(F.count("*").alias("rows"), F.lit(0).cast("bigint").alias("id_sum")))
        .unionByName(first.agg(F.lit("audited").alias("outcome"), F.sum(F.col("accepted_rows") + F.col("rejected_rows")).alias("rows"), F.lit(0).cast("bigint").alias("id_sum")))
        .unionByName(again.agg(F.lit("second load").alias("outcome"), F.count("*").alias("rows"), F.lit(0).cast("bigint").alias("id_sum")))
    )


@query
def load_by_name(spark, sf_dir):
    """Wide rows written as files, loaded into the layout that the files' name stands for, and typed again."""
    root = shared_dir(spark, "load-by-name")
    flat = _flattened(spark, sf_dir)
    write_delimited(flatten.wide_status(hashtags.expand_hashtags(flat)), f"{root}/batch0-status-20240201")
    load_files(spark, f"{root}/batch0-status-20240201", f"{root}/table", f"{root}/audit")
    return _retyped(flatten.typed_status(spark.read.parquet(f"{root}/table"), flatten.wide_overflow(flat)))


@query
def timestamp_parse(spark, sf_dir):
    rows = B.statuses(spark, sf_dir).select("status_id", "created_at", "k").withColumn(
        "zone", F.element_at(F.array(*map(F.lit, ["UTC", "IST", "EST", "XXX"])), F.col("k") % 4 + 1)
    )
    texts = rows.withColumn(
        "long_text", F.replace(long_date_text(F.col("created_at")), F.lit("UTC"), F.col("zone"))
    ).withColumn("batch_text", F.when(F.col("k") % 10 == 0, "").otherwise(format_batch_time(F.col("created_at"))))
    return texts.select(
        "status_id", "long_text",
        format_batch_time(parse_long_date(F.col("long_text"))).alias("long_utc"),
        format_batch_time(parse_batch_time(F.col("batch_text"))).alias("batch_utc"),
        hour_stamp(F.col("created_at")).alias("hour_stamp"),
    )


# -- derived tables -------------------------------------------------------------------


@query
def timezone_country(spark, sf_dir):
    users = B.users(spark, sf_dir)
    return rollups.user_countries(users, B.zones(spark, sf_dir))


@query
def sentiment_score(spark, sf_dir):
    return rollups.sentiment(B.dated_texts(spark, sf_dir), B.LEXICON).select(
        "ssoid", "user_code", "keyword", "sentiment_score", "sentiment_type", "analysis_name",
        _big("day"), _big("month"), _big("year"),
    )


@query
def status_sentiment(spark, sf_dir):
    return B.texts(spark, sf_dir).select(
        "status_id", rollups.text_score(F.col("text"), B.LEXICON).cast("bigint").alias("score"),
        F.size(words(F.col("text"))).cast("bigint").alias("word_count"),
    )


@query
def non_responded_users(spark, sf_dir):
    return rollups.non_responded_users(B.replying_statuses(spark, sf_dir), B.accounts(spark, sf_dir))


def _countries(spark, sf_dir):
    return rollups.user_countries(B.users(spark, sf_dir), B.zones(spark, sf_dir))


@query
def rollup_client_country_hour(spark, sf_dir):
    rows = rollups.client_country_hours(
        B.replying_statuses(spark, sf_dir), _countries(spark, sf_dir), B.accounts(spark, sf_dir), B.LEXICON
    )
    return rows.select(
        "ssoid", "client", "country", "sentiment_score", "non_responded_user_count",
        _big("hour"), _big("day"), _big("month"), _big("year"),
    )


@query
def rollup_hashtag_country_day(spark, sf_dir):
    rows = rollups.hashtag_country_days(B.statuses(spark, sf_dir), _countries(spark, sf_dir), B.LEXICON)
    return rows.select(
        "ssoid", "country", "hashtag", "sentiment_score", "num_of_users",
        _big("day"), _big("month"), _big("year"),
    )


# -- jobs -----------------------------------------------------------------------------


def _job_definitions(spark, watched, earliest, latest):
    """Definitions of at most 50 of the watched users each, no following of references."""
    names = watched.groupBy("batch_name", F.expr("user_id div 200").alias("slice")).agg(
        F.array_join(F.array_sort(F.collect_set("screen_name")), ",").alias("names"))
    keys = {
        "batchRunStartTime": F.lit(""), "batchCutOffMaxDate": F.lit(latest), "batchName": F.col("batch_name"),
        "batchCutOffMinDate": F.lit(earliest), "batchTrackStream": F.lit("false"),
        "userNames": F.col("names"), "dateFormat": F.lit("dd/MM/yyyy-HH:mm:ss"), "batchRefLevel": F.lit("0"),
    }
    return names.select(*[c.alias(k) for k, c in keys.items()])


@query
def backfill_runs(spark, sf_dir):
    """Three runs over a history that lands in waves of interleaved ids, some of them twice, for batches that share users.

    Each run reads the landing before it; the batch that joins at the last run reads the folders of its users in
    the older ones, too.
    """
    landed = B.landed_records(spark, sf_dir).drop("batch_name")
    store, history = Store(shared_dir(spark, "backfill")), History(shared_dir(spark, "landed"), buckets=8)
    watched = B.watched(spark, sf_dir)
    wide = watched.filter("user_id % 8 = 0").withColumn("batch_name", F.lit("wide"))
    first = cut_lineage(_job_definitions(spark, watched, "05/01/2024-06:00:00", "21/01/2024-18:30:00"), "definitions")
    last = first.unionByName(_job_definitions(spark, wide, "", "18/01/2024-00:00:00"))
    for run, (wave, definitions) in enumerate(((1, first), (0, first), (2, last))):
        part = landed.filter(f"id % 3 = {wave}")
        history.append(part.unionByName(part.filter("id % 5 = 0")), run)
        run_backfill(spark, history, definitions, store, run)
    return spark.read.parquet(store.table("statuses")).select("status_id", "batch_name", "original_user", "filter_type")


@query
def handover(spark, sf_dir):
    """Back-fill of what landed first, then the stream of everything: each status is stored once, late ones by the stream."""
    users = B.accounts(spark, sf_dir).selectExpr("concat('batch', user_id % 3) AS batch_name", "screen_name", "user_id")
    landed = B.landed_records(spark, sf_dir)
    store, path, keywords = (Store(shared_dir(spark, "handover")), *(shared_dir(spark, n) for n in ("landed", "keywords")))
    definitions = cut_lineage(_job_definitions(spark, users, "", ""), "definitions")

    def third(number):
        return F.pmod(F.xxhash64("id"), F.lit(3)) == number

    early = landed.filter((F.col("created_at") < STREAM_SPLIT) & (F.col("id") % 3 != 0)).drop("batch_name")
    early.write.parquet(f"{path}/early")
    for run in (0, 1):  # the second run finds nothing, which ends the histories
        run_backfill(spark, read_landed(spark, f"{path}/early"), definitions, store, run)
    ready = cut_lineage(ready_batches(spark, store, 2), "ready")
    taken = landed.join(ready, "batch_name", "left_semi").select(landed.columns)
    land(taken.filter(third(0)), f"{path}/all", "0", "id")
    patterns.pattern_keywords(_top_pairs(spark, sf_dir)).write.parquet(keywords)
    accounts = B.accounts(spark, sf_dir).select("screen_name", "original_user")
    running = start_live(
        stream_folders(spark, f"{path}/all", landed.schema), users, accounts, keywords, store,
        shared_dir(spark, "checkpoint"), {"processingTime": "1 second"},
        settings=batch_settings(definitions).dropDuplicates(["batch_name"]), hand_over=True,
    )
    try:
        running.processAllAvailable()
        for part in (1, 2):
            land(taken.filter(third(part)), f"{path}/all", str(part), "id")
            running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.parquet(store.table("statuses")).select("status_id", "batch_name", "filter_type")


@query
def stream_until_date(spark, sf_dir):
    """A running stream of folders in order of time that ends by itself behind the latest date of all batches."""
    users = B.accounts(spark, sf_dir).selectExpr("concat('batch', user_id % 3) AS batch_name", "screen_name", "user_id")
    landed = B.landed_records(spark, sf_dir)
    store, path, keywords = (Store(shared_dir(spark, "until")), *(shared_dir(spark, n) for n in ("landed", "keywords")))
    bounds = ["2024-01-08", "2024-01-16", "2024-01-20", "2024-01-24"]
    parts = []
    for low, high in zip([None, *bounds], [*bounds, None]):
        part = landed if low is None else landed.filter(F.col("created_at") >= low)
        parts.append(part if high is None else part.filter(F.col("created_at") < high))
    definitions = cut_lineage(_job_definitions(spark, users, "", "15/01/2024-00:00:00"), "definitions")
    settings = batch_settings(definitions).dropDuplicates(["batch_name"])
    patterns.pattern_keywords(_top_pairs(spark, sf_dir)).write.parquet(keywords)
    accounts = B.accounts(spark, sf_dir).select("screen_name", "original_user")
    land(parts[0], path, "0", "id")
    running = start_live(
        stream_folders(spark, path, landed.schema), users, accounts, keywords, store, shared_dir(spark, "checkpoint"),
        {"processingTime": "1 second"}, settings=settings, stop_at_latest=True,
    )
    try:
        for number, part in enumerate(parts[1:], 1):
            if not has_ended(spark, store, settings):
                running.processAllAvailable()
            land(part, path, str(number), "id")
        run_to_end(running, store, settings)
    finally:
        running.stop()
    return spark.read.parquet(store.table("statuses")).select("status_id", "batch_name", "filter_type")


@query
def stream_discovered_users(spark, sf_dir):
    """Authors that watched users retweet in one micro-batch are followed from the next one on."""
    landed = B.landed_records(spark, sf_dir, retweets=True).withColumn("batch_name", F.lit("all"))
    store, path, keywords, checkpoint = (
        Store(shared_dir(spark, "discovered")), *(shared_dir(spark, n) for n in ("landed", "keywords", "checkpoint")))
    users = B.accounts(spark, sf_dir).filter("user_id % 10 = 0").selectExpr("'all' AS batch_name", "screen_name")
    accounts = B.accounts(spark, sf_dir).select("screen_name", "original_user")
    patterns.pattern_keywords(_top_pairs(spark, sf_dir)).write.parquet(keywords)
    for wave in (0, 1):
        landed.filter(f"id % 2 = {wave}").write.mode("append").parquet(path)
        source = spark.readStream.schema(landed.schema).parquet(path)
        flows.finish(start_live(source, users, accounts, keywords, store, checkpoint, follow_registered=True))
    rows = spark.read.parquet(store.table("statuses")).filter("ref_status_id IS NULL")
    return rows.select("status_id", "batch_name", "filter_type", F.col("original_user").alias("account"))


@query
def stream_refresh(spark, sf_dir):
    """Derived tables kept up to date by a running stream: two waves, the second with late replies and messages."""
    rows = B.replying_statuses(spark, sf_dir).select(
        "status_id", "original_user", "user_id", F.col("screen_name").alias("user_code"), "created_at", "text",
        "hashtags", "in_reply_to_user_id",
    )
    root, path = shared_dir(spark, "refresh"), shared_dir(spark, "loaded")
    waves = (rows.filter("status_id % 4 <> 0"), rows.filter("status_id % 4 = 0"))
    waves[0].write.mode("append").parquet(path)
    running = refresh.start_refresh(
        spark.readStream.schema(rows.schema).parquet(path), cut_lineage(_countries(spark, sf_dir), "countries"),
        B.accounts(spark, sf_dir), B.LEXICON, root, shared_dir(spark, "checkpoint"), {"processingTime": "1 second"},
    )
    try:
        running.processAllAvailable()
        waves[1].write.mode("append").parquet(path)
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.parquet(f"{root}/client_country").select(
        "ssoid", "client", "country", "sentiment_score", "non_responded_user_count",
        _big("hour"), _big("day"), _big("month"), _big("year"),
    )


# -- streams --------------------------------------------------------------------------


@query
def stream_classify(spark, sf_dir):
    out = shared_dir(spark, "stream-classified")
    flows.finish(flows.classify_to_files(
        B.status_stream(spark, sf_dir), B.watched(spark, sf_dir), B.accounts(spark, sf_dir),
        out, shared_dir(spark, "checkpoint"),
    ))
    return spark.read.parquet(out).select(
        "status_id", "batch_name", "filter_type", "original_user", "derived_user", "kind"
    )


@query
def stream_dedupe_users(spark, sf_dir):
    out = shared_dir(spark, "stream-users")
    flows.finish(flows.first_users_to_files(B.status_stream(spark, sf_dir), out, shared_dir(spark, "checkpoint")))
    return spark.read.parquet(out)


@query
def stream_first_seen(spark, sf_dir):
    """The first status of every user, while files arrive in no order of time."""
    out = shared_dir(spark, "stream-first")
    rows = B.status_stream(spark, sf_dir)
    flows.finish(flows.first_seen_to_epochs(rows, out, shared_dir(spark, "checkpoint"), compact_every=3))
    return flows.read_first_seen(spark, out).select("screen_name", "status_id", "filter_type")


@query
def stream_roll_counts(spark, sf_dir):
    out = shared_dir(spark, "stream-rolls")
    flows.finish(flows.roll_counts(B.status_stream(spark, sf_dir), out, shared_dir(spark, "checkpoint")))
    return flows.read_roll_counts(spark, out)


@query
def stream_keyword_refresh(spark, sf_dir):
    """The pattern table changes while the stream runs: the second half meets the second table.

    Each refresh reads only the statuses of its half and adds their counts to those before.
    """
    counts, table, out, checkpoint = (
        shared_dir(spark, n) for n in ("pattern-counts", "patterns", "stream-tracked", "checkpoint"))
    path, split = shared_dir(spark, "event-files"), _time(STREAM_SPLIT)
    events, rows = B.table(spark, sf_dir, "events"), B.statuses(spark, sf_dir)
    halves = ((events.filter(F.col("ts") < split), rows.filter(F.col("created_at") < split)),
              (events.filter(F.col("ts") >= split), rows.filter(F.col("created_at") >= split)))
    for epoch, (landed, loaded) in enumerate(halves):
        flows.refresh_patterns(loaded, counts, table, epoch)
        landed.repartition(2, F.xxhash64("event_id")).write.mode("append").parquet(path)
        tracked = B.status_stream(spark, sf_dir, path).filter(F.col("filter_type") == S.STREAM_TRACKER)
        flows.finish(flows.track_to_epochs(tracked, table, out, checkpoint))
    return spark.read.parquet(out).select("status_id", "derived_user", "original_user", "kind")


@query
def stream_user_registry(spark, sf_dir):
    out = shared_dir(spark, "stream-registry")
    found = B.status_stream(spark, sf_dir).filter(F.col("filter_type") == S.BATCH_TIMELINE).withColumn(
        "original_user", F.concat(F.lit("org"), F.col("k") % 10))
    schema = registry.register_users(B.statuses(spark, sf_dir).withColumn(
        "created_at", F.col("created_at").cast("timestamp"))).schema
    flows.finish(flows.register_users_stream(found, out, shared_dir(spark, "checkpoint")))
    return flows.read_registrations(spark, out, schema).select(
        "batch_name", "screen_name", "user_id", "original_user",
        F.col("first_seen.status_id").alias("first_status_id"),
        F.col("last_seen.status_id").alias("last_status_id"),
    )
