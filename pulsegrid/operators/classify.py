"""How a streamed status was found, which account it belongs to, and where it goes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.functions.text import equals_ignoring_case
from pulsegrid.operators.skew import lookup_join


def mentioned_names(mentions: Column) -> Column:
    """Screen names of the mentioned users, joined with ``+``."""
    return F.array_join(mentions["screen_name"], "+")


def is_tracker(batch_name: Column) -> Column:
    return equals_ignoring_case(batch_name, F.lit(S.STREAM_TRACKER))


def is_rejected(batch_name: Column, original_user: Column) -> Column:
    """Keyword-stream rows that belong to no account."""
    no_account = F.coalesce(original_user, F.lit("")).isin("", S.STREAM_KEYWORD)
    return (batch_name == S.STREAM_TRACKER) & no_account


def status_kind(batch_name: Column, original_user: Column) -> Column:
    return F.when(is_rejected(batch_name, original_user), S.KIND_REJECTED_STATUS).otherwise(S.KIND_STATUS)


def user_kind(batch_name: Column, original_user: Column) -> Column:
    return F.when(is_rejected(batch_name, original_user), S.KIND_REJECTED_USER).otherwise(S.KIND_USER)


def classify_followed(statuses: DataFrame, watched: DataFrame, accounts: DataFrame) -> DataFrame:
    """Route the statuses of a follow stream.

    A status by a user its batch watches is a TIMELINE status of that user and of the
    account the user was derived from; any other is a REFERENCE status, named after the
    users it mentions and without account.

    ``watched``: (batch_name, screen_name); ``accounts``: (screen_name, original_user), one
    row per watched user. They are joined to each other first, so that the statuses meet one
    table, with the rows of very active users spread.
    """
    directory = (
        watched.select("batch_name", "screen_name").distinct()
        .join(accounts.select("screen_name", F.col("original_user").alias("account")), "screen_name", "left")
        .withColumn("is_watched", F.lit(True))
    )
    found = lookup_join(
        statuses.drop("filter_type", "original_user", "derived_user"), directory, ["batch_name", "screen_name"]
    )
    timeline = F.col("is_watched").isNotNull()
    return (
        found.withColumn("filter_type", F.when(timeline, S.STREAM_TIMELINE).otherwise(S.STREAM_REFERENCE))
        .withColumn("original_user", F.when(timeline, F.col("account")))
        .withColumn(
            "derived_user",
            F.when(timeline, F.col("screen_name")).otherwise(mentioned_names(F.col("mentions"))),
        )
        .withColumn("kind", status_kind(F.col("batch_name"), F.col("original_user")))
        .drop("account", "is_watched")
    )


def classify_tracked(matched: DataFrame) -> DataFrame:
    """Route pattern-matched statuses of the keyword stream; see ``patterns.match_patterns``."""
    return (
        matched.withColumn("batch_name", F.lit(S.STREAM_TRACKER))
        .withColumn("filter_type", F.lit(S.STREAM_TRACKER))
        .withColumn("original_user", F.col("orgs"))
        .withColumn("derived_user", F.col("patterns"))
        .withColumn("kind", status_kind(F.col("batch_name"), F.col("original_user")))
        .drop("orgs", "patterns")
    )


def within_cutoffs(statuses: DataFrame, earliest: Column | None = None, latest: Column | None = None) -> DataFrame:
    """Statuses created between both bounds, inclusive; a missing bound is open."""
    if earliest is not None:
        statuses = statuses.filter(F.col("created_at") >= earliest)
    if latest is not None:
        statuses = statuses.filter(F.col("created_at") <= latest)
    return statuses
