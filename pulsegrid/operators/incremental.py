"""High-water marks, paging modes and cut-off dates of the back-fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.functions.times import format_batch_time
from pulsegrid.operators.skew import BROADCAST_ROWS, lookup_join
from pulsegrid.session import cut_lineage


USER = ("screen_name",)
BATCH_USER = ("batch_name", "screen_name")
MAX_DAYS = 1000


def user_watermarks(statuses: DataFrame, keys: tuple[str, ...] = USER) -> DataFrame:
    """Smallest and largest status id seen per user, or per batch and user."""
    return statuses.groupBy(*keys).agg(
        F.min("status_id").alias("since_id"),
        F.max("status_id").alias("max_id"),
        F.count("*").alias("status_count"),
    )


def merge_watermarks(marks: DataFrame, keys: tuple[str, ...] = USER) -> DataFrame:
    """One row per user (or batch and user) from the marks of several runs."""
    return marks.groupBy(*keys).agg(
        F.min("since_id").alias("since_id"),
        F.max("max_id").alias("max_id"),
        F.sum("status_count").alias("status_count"),
    )


def _directed(statuses: DataFrame, watermarks: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    direction = (
        F.when(F.col("max_id").isNull(), "INITIAL")
        .when(F.col("status_id") > F.col("max_id"), S.MODE_FORWARD)
        .when(F.col("status_id") < F.col("since_id"), S.MODE_REVERSE)
    )
    marks = watermarks.select(*keys, "since_id", "max_id")
    return lookup_join(statuses, marks, list(keys)).withColumn("direction", direction).drop("since_id", "max_id")


def beyond_watermarks(statuses: DataFrame, watermarks: DataFrame, keys: tuple[str, ...] = USER) -> DataFrame:
    """Statuses not fetched yet, with the ``direction`` in which they extend the known range.

    FORWARD: newer than the user's largest id. REVERSE: older than the smallest one. INITIAL:
    the user has no marks. Ids on or between the marks count as fetched; where they may land late,
    ``unstored`` looks at each of them.
    """
    return _directed(statuses, watermarks, keys).filter(F.col("direction").isNotNull())


def id_day(time: Column) -> Column:
    """The folder in which the id of a status of that time is remembered."""
    return F.coalesce(F.date_format(time, "yyyyMMdd"), F.lit("none"))


def unstored(statuses: DataFrame, watermarks: DataFrame, stored: DataFrame) -> DataFrame:
    """Statuses whose (batch, id) was not stored before, wherever it lies.

    Beyond the marks of its batch and user a status is new. Ids between the marks may have landed late:
    these, narrowed to key and day, are compared with ``stored`` (batch_name, status_id, day), of which only
    their days are read, up to ``MAX_DAYS`` days. The few late ones found that way pick their rows.
    """
    directed = _directed(statuses, watermarks, BATCH_USER)
    beyond = directed.filter(F.col("direction").isNotNull()).drop("direction")
    inside = directed.filter(F.col("direction").isNull()).drop("direction")
    key = ["batch_name", "status_id"]
    narrow = inside.select(*key, id_day(F.col("created_at")).alias("day")).distinct()
    days = [r.day for r in narrow.select("day").distinct().limit(MAX_DAYS + 1).collect()]
    if not days:
        return beyond
    if len(days) <= MAX_DAYS:
        stored = stored.filter(F.col("day").isin(days))
    late = cut_lineage(narrow.join(stored, [*key, "day"], "left_anti").select(key), "late-ids")
    few = late.limit(BROADCAST_ROWS + 1).count()
    if few == 0:
        return beyond
    picked = F.broadcast(late) if few <= BROADCAST_ROWS else late
    return beyond.unionByName(inside.join(picked, key, "left_semi").select(beyond.columns))


def paging_modes(watched: DataFrame, statuses: DataFrame, earliest: Column | None = None,
                 latest: Column | None = None) -> DataFrame:
    """Paging mode of every watched user after a run.

    FORWARD when the run found nothing in the date range or met a status older than it (the
    history is exhausted); REVERSE while older pages remain. A status newer than the range says
    nothing about the history.
    """
    inside, older = F.lit(True), F.lit(False)
    if earliest is not None:
        inside, older = F.col("created_at") >= earliest, F.col("created_at") < earliest
    if latest is not None:
        inside = inside & (F.col("created_at") <= latest)
    seen = statuses.groupBy("screen_name").agg(
        F.count_if(inside).alias("inside"), F.count_if(older).alias("older")
    )
    exhausted = (F.coalesce("inside", F.lit(0)) == 0) | (F.coalesce("older", F.lit(0)) > 0)
    return watched.join(seen, "screen_name", "left").select(
        "batch_name", "screen_name",
        F.when(exhausted, S.MODE_FORWARD).otherwise(S.MODE_REVERSE).alias("paging_mode"),
    )


def finished_batches(modes: DataFrame) -> DataFrame:
    """A batch may switch to the live stream when all its users are in FORWARD mode."""
    forward = F.coalesce("paging_mode", F.lit("")) == S.MODE_FORWARD
    return modes.groupBy("batch_name").agg(
        F.count("*").alias("user_count"),
        F.count_if(forward).alias("forward_count"),
        F.bool_and(forward).alias("is_finished"),
    )


def without_finished_users(watched: DataFrame, modes: DataFrame) -> DataFrame:
    """Users the next back-fill run still has to read."""
    done = modes.filter(F.col("paging_mode") == S.MODE_FORWARD)
    return watched.join(done.select("batch_name", "screen_name"), ["batch_name", "screen_name"], "left_anti")


def advance_cutoffs(batch_state: DataFrame, loaded: DataFrame) -> DataFrame:
    """Move each batch's earliest date to the newest event time loaded for it, never back.

    ``batch_state``: (batch_name, cutoff_min timestamp, may be NULL).
    """
    newest = loaded.groupBy("batch_name").agg(F.max("created_at").alias("newest"))
    return batch_state.join(newest, "batch_name", "left").select(
        "batch_name",
        format_batch_time(F.greatest("cutoff_min", "newest")).alias("cutoff_min_text"),
    )
