"""Users known per batch, and the list of users a stream follows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.times import arrival, arrival_key
from pulsegrid.operators.skew import lookup_join

# One stream follows at most this many users; a batch with more of them has several lists.
LIST_SIZE = 200
RANK_SLICE = 100_000

# What a registration is kept under.
REGISTRY_KEYS = ("batch_name", "screen_name")


def register_users(statuses: DataFrame) -> DataFrame:
    """Distinct (batch_name, screen_name) with the first user id and the last account seen.

    Arrival order is (created_at, status_id). A hash aggregation with the arrival packed in one
    number leaves a row per (batch, user, id, account); only those few rows are compared by
    ``min_by``, so no task sorts its statuses and no list of users is built.
    """
    key = arrival_key(statuses)
    few = statuses.groupBy("batch_name", "screen_name", "user_id", "original_user").agg(
        F.min(key).alias("first"), F.max(key).alias("last")
    )
    return few.groupBy("batch_name", "screen_name").agg(
        F.min_by("user_id", "first").alias("user_id"),
        F.max_by("original_user", "last").alias("original_user"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    ).select(
        "batch_name", "screen_name", "user_id", "original_user",
        arrival("first", statuses).alias("first_seen"), arrival("last", statuses).alias("last_seen"),
    )


def merge_registrations(*parts: DataFrame) -> DataFrame:
    """Registrations of several runs as one, with the same first/last rules."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("batch_name", "screen_name").agg(
        F.min_by("user_id", "first_seen").alias("user_id"),
        F.max_by("original_user", "last_seen").alias("original_user"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )


def account_map(registered: DataFrame) -> DataFrame:
    """screen_name to original_user over all batches; the last registration wins."""
    return registered.groupBy("screen_name").agg(
        F.max_by("original_user", F.struct("last_seen", "batch_name")).alias("original_user")
    )


def follow_list(watched: DataFrame, registered: DataFrame, user_ids: DataFrame,
                size: int = LIST_SIZE) -> DataFrame:
    """All users to follow per batch: watched ones first, then registered ones, each once.

    Names without a known id are left out. ``watched`` and ``registered`` hold (batch_name,
    screen_name), ``user_ids`` (screen_name, user_id). ``list_no`` numbers lists of ``size`` users, as a stream
    follows no more; nobody is dropped. Positions are ranked within slices of the id range and
    shifted by the sizes of the slices before, so a batch of any size is ranked by many tasks.
    """
    candidates = (
        watched.select("batch_name", "screen_name", F.lit(0).alias("origin"))
        .unionByName(registered.select("batch_name", "screen_name", F.lit(1).alias("origin")))
        .groupBy("batch_name", "screen_name").agg(F.min("origin").alias("origin"))
        .join(user_ids, "screen_name")
        .withColumn("slice", F.floor(F.col("user_id") / RANK_SLICE))
    )
    keys = ["batch_name", "origin", "slice"]
    before = Window.partitionBy("batch_name").orderBy("origin", "slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = candidates.groupBy(*keys).agg(F.count("*").alias("n")).select(
        *keys, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")
    )
    order = Window.partitionBy(*keys).orderBy("user_id", "screen_name")
    position = (F.col("shift") + F.row_number().over(order)).cast("int")
    return (
        candidates.join(shifts, keys)
        .withColumn("position", position)
        .withColumn("list_no", F.expr(f"CAST((position - 1) div {size} AS int)"))
        .select("batch_name", "list_no", "position", "screen_name", "user_id")
    )


def follow_filter(statuses: DataFrame, followed: DataFrame) -> DataFrame:
    """Statuses of their batch's followed users, on whichever list they are."""
    users = followed.select("batch_name", "user_id").distinct()
    return lookup_join(statuses, users, ["batch_name", "user_id"], "inner").select(statuses.columns)
