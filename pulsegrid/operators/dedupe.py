"""First occurrence per key, and exclusion of what was processed before."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.times import arrival_key
from pulsegrid.operators.skew import lookup_join
from pulsegrid.session import cut_lineage


_LAST = Decimal(10 ** 38 - 1)


def _arrival(statuses: DataFrame) -> Column:
    """(created_at, status_id) as one number; rows without one of them come last."""
    return F.coalesce(arrival_key(statuses), F.lit(_LAST).cast("decimal(38, 0)"))


def _first_arrivals(statuses: DataFrame) -> DataFrame:
    """(screen_name, first arrival): a hash aggregation of narrow rows, combined before the shuffle."""
    named = statuses.filter(F.col("screen_name").isNotNull())
    return named.groupBy("screen_name").agg(F.min(_arrival(statuses)).alias("_first"))


def _rows_of(statuses: DataFrame, firsts: DataFrame) -> DataFrame:
    """The rows that arrived first, one per user; repeated arrivals are told apart by a hash of all columns.

    The narrow arrivals are written, counted and brought to the rows, so no task sorts whole rows
    and a user's rows are not gathered. Only the rows found are ranked.
    """
    firsts = cut_lineage(firsts, "first-arrivals")
    found = lookup_join(statuses.withColumn("_at", _arrival(statuses)), firsts, "screen_name", "inner")
    found = found.filter("_at = _first").select(statuses.columns)
    order = Window.partitionBy("screen_name").orderBy(F.xxhash64(*[F.col(c) for c in statuses.columns]))
    return found.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def first_per_user(statuses: DataFrame) -> DataFrame:
    """The first status of every screen name by (created_at, status_id).

    Rows without a screen name belong to no user.
    """
    return _rows_of(statuses, _first_arrivals(statuses))


def new_users(statuses: DataFrame, processed: DataFrame) -> DataFrame:
    """First status of each user whose screen name was not processed before.

    Processed users leave as names, before any whole row is read.
    """
    names = processed.select("screen_name").distinct()
    return _rows_of(statuses, _first_arrivals(statuses).join(names, "screen_name", "left_anti"))


def new_statuses(statuses: DataFrame, processed: DataFrame) -> DataFrame:
    """Statuses whose id was not processed before, each id once.

    Optional for timeline statuses (off by default there), always on for reply parents.
    """
    return one_per_status(statuses).join(
        processed.select("status_id").distinct(), "status_id", "left_anti"
    )


def one_per_status(statuses: DataFrame, keys: tuple[str, ...] = ("status_id",), last: str | None = None) -> DataFrame:
    """One row per id: that of the greatest ``last`` column if given, else the first by arrival.

    Rows that agree there are told apart by a hash of all columns, so that the choice does not depend on
    partitions. The rank runs as a partial group limit before the shuffle.
    """
    order = [F.col(c) for c in ("created_at",) if c in statuses.columns]
    if last is not None:
        order = [F.col(last).desc_nulls_last(), *order]
    whole = F.xxhash64(*[F.col(c) for c in statuses.columns])
    ranked = Window.partitionBy(*keys).orderBy(*order, whole)
    return statuses.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")
