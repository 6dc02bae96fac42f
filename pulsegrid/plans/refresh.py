"""Periodic jobs after a load: derived tables, pattern weights and batch definitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.operators import hashtags, rollups
from pulsegrid.operators.incremental import MAX_DAYS, id_day
from pulsegrid.session import cut_lineage
from pulsegrid.sinks.state import LIVE, compact_epochs, read_epochs, write_epoch
from pulsegrid.streaming.flows import COMPACT_EVERY

EVERY_HALF_HOUR = {"processingTime": "30 minutes"}


def _write_days(rows: DataFrame, path: str) -> None:
    """Replace exactly the days present in ``rows``."""
    (
        rows.hint("rebalance", "year", "month", "day").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("year", "month", "day").parquet(path)
    )


def refresh_tables(statuses: DataFrame, users: DataFrame, zones: DataFrame, accounts: DataFrame,
                   lexicon: dict[str, int], root: str, since: str | None = None) -> None:
    """Recompute the three derived tables from the day ``since`` on (all days when None).

    Expects the typed columns and ``user_code``. A late reply changes an earlier hour's
    non-responded users, so ``since`` should reach back as far as replies may come late.
    """
    if since is not None:
        # whole days are replaced, so a time of day counts as its day
        statuses = statuses.filter(F.col("created_at") >= F.date_trunc("day", F.lit(since).cast("timestamp")))
    _write_tables(statuses, rollups.user_countries(users, zones), accounts, lexicon, root)


def _write_tables(statuses: DataFrame, countries: DataFrame, accounts: DataFrame, lexicon: dict[str, int],
                  root: str, replied: DataFrame | None = None) -> None:
    """Replace the days of ``statuses``, which hold these days whole, in the three derived tables."""
    _write_days(rollups.sentiment(statuses, lexicon), f"{root}/sentiment")
    hours = rollups.client_country_hours(statuses, countries, accounts, lexicon, replied)
    _write_days(hours, f"{root}/client_country")
    _write_days(rollups.hashtag_country_days(statuses, countries, lexicon), f"{root}/hashtag_country")


def _last_replies(rows: DataFrame) -> DataFrame:
    return rows.groupBy("client", "user_id").agg(F.max("replied_at").alias("replied_at"))


def _asked_days(rows: DataFrame) -> DataFrame:
    return rows.groupBy("client", "user_id", "day").agg(F.max("asked_at").alias("asked_at"))


def refresh_epoch(loaded: str, schema: T.StructType, countries: DataFrame, accounts: DataFrame,
                  lexicon: dict[str, int], root: str, epoch: int) -> list[str] | None:
    """Bring the derived tables up to date with one epoch of the state table ``loaded``, which is parted by ``day``.

    The days to recompute are those of the new rows, and those of older messages that a new reply of a client's
    team answers. The latter come from two small state tables: the last reply per (client, user), and the last
    message per (client, user, day). So history is not read to find them, and of the statuses only
    the affected days are read. A repeated epoch gives the same. Returns the days, or None where there are
    more than ``MAX_DAYS`` and all are recomputed.
    """
    spark = countries.sparkSession
    rows = read_epochs(spark, loaded, schema, LIVE, only=epoch)
    pairs = cut_lineage(rollups.message_pairs(rows), "message-pairs")
    replies = _last_replies(rollups.team_replies(pairs))
    asked = _asked_days(rollups.asked_messages(pairs, accounts).withColumn("day", id_day(F.col("hour_start"))))

    replied_path, asked_path = f"{root}/state/replied", f"{root}/state/asked"
    before = _last_replies(read_epochs(spark, replied_path, replies.schema, LIVE, epoch))
    news = replies.join(before.withColumnRenamed("replied_at", "old_at"), ["client", "user_id"], "left").filter(
        F.col("old_at").isNull() | (F.col("replied_at") > F.col("old_at"))
    )
    answered = _asked_days(read_epochs(spark, asked_path, asked.schema, LIVE, epoch)).join(
        news.select("client", "user_id", "old_at"), ["client", "user_id"]
    ).filter(F.col("old_at").isNull() | (F.col("asked_at") > F.col("old_at")))
    affected = rows.select("day").unionByName(answered.select("day")).distinct().limit(MAX_DAYS + 1)
    days = sorted(r.day for r in affected.collect())

    write_epoch(replies, replied_path, LIVE, epoch)
    write_epoch(asked, asked_path, LIVE, epoch)
    statuses = read_epochs(spark, loaded, schema, LIVE, epoch + 1)
    if len(days) <= MAX_DAYS:
        statuses = statuses.filter(F.col("day").isin(days))
    replied = _last_replies(read_epochs(spark, replied_path, replies.schema, LIVE, epoch + 1))
    _write_tables(statuses, countries, accounts, lexicon, root, replied)
    if epoch and epoch % COMPACT_EVERY == 0:
        compact_epochs(spark, replied_path, replies.schema, LIVE, epoch - 1, _last_replies)
        compact_epochs(spark, asked_path, asked.schema, LIVE, epoch - 1, _asked_days)
    return days if len(days) <= MAX_DAYS else None


def start_refresh(statuses: DataFrame, countries: DataFrame, accounts: DataFrame, lexicon: dict[str, int],
                  root: str, checkpoint: str, trigger: dict = EVERY_HALF_HOUR) -> StreamingQuery:
    """Keep the derived tables up to date with a stream of loaded statuses.

    Each micro-batch is stored by day as an epoch of ``<root>/loaded``, and the days that it affects are
    recomputed (``refresh_epoch``). Expects the typed columns and ``user_code``.
    """
    def handle(rows: DataFrame, epoch: int) -> None:
        parted = rows.withColumn("day", id_day(F.col("created_at")))
        write_epoch(parted.hint("rebalance", "day"), f"{root}/loaded", LIVE, epoch, ("day",))
        refresh_epoch(f"{root}/loaded", parted.schema, countries, accounts, lexicon, root, epoch)

    return (
        statuses.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(**trigger).start()
    )


def refresh_weights(statuses: DataFrame, path: str, top: int = 5) -> None:
    """The pattern weights the periodic alert draws from."""
    counts = hashtags.pattern_counts(hashtags.top_hashtags(statuses, top))
    hashtags.pattern_weights(counts).write.mode("overwrite").parquet(path)


def advance_definitions(definitions: DataFrame, loaded: DataFrame) -> DataFrame:
    """Definitions whose earliest date is the newest event time loaded for the batch.

    The date keeps each definition's own format and never moves back; batches without loaded
    rows are unchanged.
    """
    newest = loaded.groupBy(F.col("batch_name").alias("batchName")).agg(F.max("created_at").alias("newest"))
    current = F.try_to_timestamp(F.nullif(F.col("batchCutOffMinDate"), F.lit("")), F.col("dateFormat"))
    return (
        definitions.join(newest, "batchName", "left")
        .withColumn("latest", F.greatest(current, F.col("newest")))
        .withColumn("batchCutOffMinDate", F.coalesce(F.expr("date_format(latest, dateFormat)"), "batchCutOffMinDate"))
        .select(definitions.columns)
    )
