"""Streaming queries over status streams.

Each function returns a started query. Checkpoints and outputs belong in folders shared by
all executors. Stateless steps reuse the batch operators unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from pulsegrid.operators import hashtags
from pulsegrid.operators.classify import classify_followed, classify_tracked
from pulsegrid.operators.patterns import match_keywords, pattern_keywords
from pulsegrid.operators.registry import REGISTRY_KEYS, merge_registrations, register_users
from pulsegrid.operators.skew import BROADCAST_ROWS
from pulsegrid.functions.times import file_stamp
from pulsegrid.session import cut_lineage
from pulsegrid.sinks.buckets import read_keyed, upsert
from pulsegrid.sinks.state import (
    LIVE, compact_epochs, read_epochs, read_table, replace_epoch, replace_table, write_epoch,
)

# What is waiting now is read and the query ends; pass {"processingTime": ..} to keep running.
AVAILABLE_NOW = {"availableNow": True}
COMPACT_EVERY = 100


def finish(query: StreamingQuery, timeout_sec: int | None = None) -> None:
    """Wait for a bounded query; with a limit, stop it and fail when it does not end in time."""
    if timeout_sec is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_sec):
        query.stop()
        raise TimeoutError(f"stream did not finish in {timeout_sec} s")


def _started(writer: DataStreamWriter, checkpoint: str, trigger: dict) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def classify_to_files(statuses: DataFrame, watched: DataFrame, accounts: DataFrame, out: str,
                      checkpoint: str, trigger: dict = AVAILABLE_NOW) -> StreamingQuery:
    """Follow stream: route each status and append it below its batch and kind."""
    rows = classify_followed(statuses, watched, accounts)
    writer = rows.writeStream.format("parquet").option("path", out).partitionBy("batch_name", "kind")
    return _started(writer.outputMode("append"), checkpoint, trigger)


def first_users_to_files(statuses: DataFrame, out: str, checkpoint: str,
                         trigger: dict = AVAILABLE_NOW) -> StreamingQuery:
    """Every screen name once over the whole life of the stream.

    The state holds one key per user ever seen, as exact de-duplication must; with the
    RocksDB provider it lives on disk and spills by itself.
    """
    users = statuses.select("screen_name", "user_id").dropDuplicates(["screen_name"])
    writer = users.writeStream.format("parquet").option("path", out)
    return _started(writer.outputMode("append"), checkpoint, trigger)


_FIRST = "screen_name string, created_at timestamp, status_id bigint, filter_type string"


def _earliest(rows: DataFrame) -> DataFrame:
    first = F.min(F.struct("created_at", "status_id", "filter_type")).alias("first")
    return rows.groupBy("screen_name").agg(first).select("screen_name", "first.*")


def first_seen_to_epochs(statuses: DataFrame, out: str, checkpoint: str, trigger: dict = AVAILABLE_NOW,
                         compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """The first status of every user by time and id, exact also where earlier ones arrive later.

    The stream holds no state. A micro-batch is reduced to one row per user, and adds those that are new or
    earlier than what the table of users has; only the users of the micro-batch are looked up, without shuffling
    the table. The closed epochs are merged every ``compact_every`` ones.
    """
    def keep(rows: DataFrame, epoch: int) -> None:
        spark = rows.sparkSession
        schema = spark.createDataFrame([], _FIRST).schema
        if epoch and epoch % compact_every == 0:
            compact_epochs(spark, out, schema, LIVE, epoch - 1, _earliest)
        first = cut_lineage(_earliest(rows.select(*schema.names)), "first-seen")
        names = first.select("screen_name")
        few = names.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        known = _earliest(read_epochs(spark, out, schema, LIVE, epoch).join(
            F.broadcast(names) if few else names, "screen_name", "left_semi"))
        at = F.struct(F.col("created_at"), F.col("status_id"))
        older = known.select("screen_name", at.alias("known_at"))
        news = first.join(older, "screen_name", "left").filter(F.col("known_at").isNull() | (at < F.col("known_at")))
        write_epoch(news.select(*schema.names), out, LIVE, epoch)

    return _started(statuses.writeStream.foreachBatch(keep), checkpoint, trigger)


def read_first_seen(spark: SparkSession, out: str) -> DataFrame:
    return _earliest(read_epochs(spark, out, spark.createDataFrame([], _FIRST).schema))


_ROLLS = "batch_name string, bucket string, record_count bigint"


def _sum_rolls(rows: DataFrame) -> DataFrame:
    return rows.groupBy("batch_name", "bucket").agg(F.sum("record_count").alias("record_count"))


def roll_counts(statuses: DataFrame, out: str, checkpoint: str, interval: str = "8 minutes",
                trigger: dict = AVAILABLE_NOW, compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Rows per batch and time bucket, whatever order the statuses arrive in.

    Each micro-batch writes its own partial counts as an epoch and keeps no state;
    ``read_roll_counts`` adds them up, so a row is never too late. Every ``compact_every`` epochs the closed
    ones are summed into one, so what is read follows the buckets and not the age of the stream.
    """
    def count(rows: DataFrame, epoch: int) -> None:
        spark = rows.sparkSession
        if epoch and epoch % compact_every == 0:
            compact_epochs(spark, out, spark.createDataFrame([], _ROLLS).schema, LIVE, epoch - 1, _sum_rolls)
        counts = rows.groupBy("batch_name", F.window("created_at", interval).alias("bucket")).agg(
            F.count("*").alias("record_count")
        )
        stamped = counts.select("batch_name", file_stamp(F.col("bucket.end")).alias("bucket"), "record_count")
        write_epoch(stamped, out, LIVE, epoch)

    return _started(statuses.writeStream.foreachBatch(count), checkpoint, trigger)


def read_roll_counts(spark: SparkSession, out: str) -> DataFrame:
    """The sum of all epochs' partial counts."""
    return _sum_rolls(read_epochs(spark, out, spark.createDataFrame([], _ROLLS).schema))


_COUNTS = "original_user string, derived_user string, hashtag string, record_count bigint"
_KEYWORDS = "org_pos int, org string, kw_pos int, der string, tag string"


def refresh_patterns(new_rows: DataFrame, counts_path: str, path: str, epoch: int, top: int = 5,
                     compact_every: int = COMPACT_EVERY) -> None:
    """Bring the pattern table up to date with the statuses loaded since the last refresh.

    Only the new rows are read: their counts per account, user and hashtag are added as an epoch, and the top
    patterns come from the summed counts, which are as many as there are pairs, not statuses. A refresh that is
    repeated replaces its epoch. The table gets a new version; streams that read the version before go on.
    """
    spark = new_rows.sparkSession
    schema = spark.createDataFrame([], _COUNTS).schema
    if epoch and epoch % compact_every == 0:
        compact_epochs(spark, counts_path, schema, LIVE, epoch - 1, hashtags.merge_counts)
    write_epoch(hashtags.hashtag_counts(new_rows), counts_path, LIVE, epoch)
    counts = hashtags.merge_counts(read_epochs(spark, counts_path, schema))
    replace_table(pattern_keywords(hashtags.top_counted(counts, top)), path, "patterns")


def read_keywords(spark: SparkSession, path: str) -> DataFrame:
    """The pattern table as it is now."""
    return read_table(spark, path, spark.createDataFrame([], _KEYWORDS).schema)


def track_to_epochs(statuses: DataFrame, pattern_path: str, out: str, checkpoint: str,
                    trigger: dict = AVAILABLE_NOW) -> StreamingQuery:
    """Keyword stream: match against the pattern table as it is at each micro-batch.

    A refresh of the table takes effect with the next micro-batch; the stream need not be
    torn down. Matched rows, accepted or rejected (``kind``), go to the epoch's folder.
    """
    def match(rows: DataFrame, epoch: int) -> None:
        keywords = read_keywords(rows.sparkSession, pattern_path)
        replace_epoch(classify_tracked(match_keywords(rows, keywords)), out, LIVE, epoch)

    return _started(statuses.writeStream.foreachBatch(match), checkpoint, trigger)


def register_users_stream(statuses: DataFrame, out: str, checkpoint: str,
                          trigger: dict = AVAILABLE_NOW) -> StreamingQuery:
    """Discovered users per batch: each micro-batch merges its registrations into the buckets of its users."""
    def register(rows: DataFrame, epoch: int) -> None:
        upsert(register_users(rows), out, LIVE, epoch, REGISTRY_KEYS, merge_registrations)

    return _started(statuses.writeStream.foreachBatch(register), checkpoint, trigger)


def read_registrations(spark: SparkSession, out: str, schema) -> DataFrame:
    """One row per batch and user; writers that both know a user are merged."""
    return merge_registrations(read_keyed(spark, out, schema))

