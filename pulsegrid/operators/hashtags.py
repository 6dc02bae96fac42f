"""Hashtag expansion and the top hashtags per watched account."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid import schemas as S


def expand_hashtags(statuses: DataFrame) -> DataFrame:
    """One row per hashtag, duplicates kept; a status without hashtags gives one NULL row."""
    others = [c for c in statuses.columns if c != "hashtags"]
    return statuses.select(*others, F.explode_outer("hashtags").alias("hashtag"))


def hashtag_counts(statuses: DataFrame) -> DataFrame:
    """Rows per (original_user, derived_user, hashtag), keyword-stream rows left out.

    Takes statuses with their ``hashtags`` array, or rows already expanded to ``hashtag``.
    """
    tag = F.col("hashtag") if "hashtag" in statuses.columns else F.explode("hashtags").alias("hashtag")
    return (
        statuses.filter(F.col("filter_type") != S.STREAM_TRACKER)
        .select("original_user", "derived_user", tag)
        .filter(F.col("hashtag").isNotNull())
        .groupBy("original_user", "derived_user", "hashtag")
        .agg(F.count("*").alias("record_count"))
    )


def top_hashtags(statuses: DataFrame, top: int = 5, for_users: DataFrame | None = None) -> DataFrame:
    """The most used ``derived_user + hashtag`` pairs of each original user, ranked from 1.

    One grouped plan serves all accounts. The counts are combined map-side, and the rank
    filter becomes a partial group limit, so at most ``top`` rows per account and task are
    shuffled for the ranking, also for an account that owns most of the data.
    """
    counts = hashtag_counts(statuses)
    if for_users is not None:
        counts = counts.join(for_users.select("original_user"), "original_user", "left_semi")
    return top_counted(counts, top)


def merge_counts(counts: DataFrame) -> DataFrame:
    """The sums of ``hashtag_counts`` over parts of the statuses."""
    return counts.groupBy("original_user", "derived_user", "hashtag").agg(F.sum("record_count").alias("record_count"))


def top_counted(counts: DataFrame, top: int = 5) -> DataFrame:
    """The largest ``top`` counts of each original user, ranked from 1; ties by name."""
    order = Window.partitionBy("original_user").orderBy(F.desc("record_count"), "derived_user", "hashtag")
    return counts.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= top)


def pattern_key() -> Column:
    return F.concat_ws("+", "derived_user", "hashtag")


def pattern_counts(top_pairs: DataFrame, order: DataFrame | None = None) -> DataFrame:
    """One count per ``user+hashtag`` pattern; of two accounts with the same one, the later wins.

    Later is by ``order`` (original_user, org_pos), the account list, and by name without it.
    """
    place = F.lit(0)
    if order is not None:
        top_pairs = top_pairs.join(order.select("original_user", "org_pos"), "original_user", "left")
        place = F.coalesce("org_pos", F.lit(2147483647))
    return (
        top_pairs.groupBy(pattern_key().alias("pattern"))
        .agg(F.max_by("record_count", F.struct(place.alias("place"), "original_user")).alias("record_count"))
    )


def pattern_weights(counts: DataFrame) -> DataFrame:
    """Weight of each pattern against the mean count, its font size, and the most used one.

    The totals are one-row aggregates read as scalar subqueries, so nothing is gathered in a
    single window partition. A zero mean gives NULL weights.
    """
    mean = counts.agg(F.expr("nullif(sum(record_count) div count(*), 0)")).scalar()
    first = counts.agg(
        F.min_by("pattern", F.struct(-F.col("record_count"), F.col("pattern")))
    ).scalar()
    return (
        counts.withColumn("mean_count", mean)
        .withColumn("weight", F.expr("record_count * 30 div mean_count"))
        .withColumn(
            "font_size", F.when(F.col("weight") > 50, 50).when(F.col("weight") < 10, 10).otherwise(20)
        )
        .withColumn("is_most_used", F.col("pattern") == first)
    )


def count_jumps(counts: DataFrame, key: str, period: str, min_percent: int = 100,
                min_records: int = 10) -> DataFrame:
    """Periods whose count rose by both thresholds over the key's previous observed period.

    Expects one row per (key, period) with a ``record_count``, so a window group holds one
    row per period, never the underlying statuses.
    """
    order = Window.partitionBy(key).orderBy(period)
    rise = F.col("record_count") - F.col("previous_count")
    return (
        counts.withColumn("previous_count", F.lag("record_count").over(order))
        .filter((rise >= min_records) & (rise * 100 >= F.col("previous_count") * min_percent))
    )
