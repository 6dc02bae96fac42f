"""Back-fill: read the watched users' history once, follow it, store it, remember how far it got."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.operators import dedupe, flatten, incremental, lineage, registry
from pulsegrid.operators.skew import lookup_join
from pulsegrid.session import cut_lineage, use_utc
from pulsegrid.sinks.buckets import upsert
from pulsegrid.sinks.routed import with_bucket, write_routed
from pulsegrid.sinks.state import BACKFILL, epoch_path, read_epochs, replace_epoch, write_epoch
from pulsegrid.sources.batch_config import batch_settings, watched_users
from pulsegrid.sources.history import History

_WATERMARKS = "batch_name string, screen_name string, since_id bigint, max_id bigint, status_count bigint"
_STORED = "batch_name string, status_id bigint, day string"
_MODES = "batch_name string, screen_name string, paging_mode string"
_PROCESSED = "status_id bigint"
_USERS = "screen_name string"


@dataclass(frozen=True)
class Store:
    """Folders of a deployment: result tables and the state carried between runs."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def state(self, name: str) -> str:
        return f"{self.root}/state/{name}"


def _schema(spark: SparkSession, ddl: str):
    return spark.createDataFrame([], ddl).schema


def current_modes(spark: SparkSession, store: Store, before: int) -> DataFrame:
    """Latest paging mode per batch and user over all runs before ``before``."""
    path, schema = store.state("paging_modes"), _schema(spark, f"run bigint, {_MODES}")
    return read_epochs(spark, path, schema, BACKFILL, before).groupBy("batch_name", "screen_name").agg(
        F.max_by("paging_mode", "run").alias("paging_mode")
    )


def ready_batches(spark: SparkSession, store: Store, before: int) -> DataFrame:
    """Batches whose users' histories are all exhausted: the live stream may take over."""
    return incremental.finished_batches(current_modes(spark, store, before)).filter("is_finished").select("batch_name")


def timeline_rows(landed: DataFrame, watched: DataFrame, settings: DataFrame) -> DataFrame:
    """Statuses of watched users inside their batch's date range, as typed rows.

    A user may be watched by several batches, each with its own range; the status is a row of each.
    """
    # one row per name with its batches, so that the rows of very active users can be spread
    batches = watched.select("batch_name", "screen_name").distinct().join(settings, "batch_name").groupBy("screen_name").agg(
        F.collect_set(F.struct("batch_name", "cutoff_min", "cutoff_max")).alias("batches")
    )
    named = landed.withColumn("screen_name", F.col("user.screen_name"))
    found = lookup_join(named, batches, "screen_name", "inner").withColumn("batch", F.explode("batches"))
    inside = found.filter(
        F.coalesce(F.col("created_at") >= F.col("batch.cutoff_min"), F.lit(True))
        & F.coalesce(F.col("created_at") <= F.col("batch.cutoff_max"), F.lit(True))
    ).withColumn("batch_name", F.col("batch.batch_name"))
    name = F.col("screen_name")
    return flatten.flatten_status(
        inside, F.lit(S.BATCH_TIMELINE), name, name, keep=("batch_name", "user")
    ).withColumn("screen_name", F.col("user.screen_name"))


def stored_ids(spark: SparkSession, store: Store, before: int | None = None) -> DataFrame:
    """(batch_name, status_id, day) of what the back-fill stored, in folders by day."""
    schema = _schema(spark, _STORED)
    return read_epochs(spark, store.state("stored_ids"), schema, BACKFILL if before is not None else None, before)


def backfill_marks(spark: SparkSession, store: Store, before: int | None = None) -> DataFrame:
    """The marks of every batch and user over all runs (before ``before``)."""
    marks = read_epochs(
        spark, store.state("watermarks"), _schema(spark, _WATERMARKS), BACKFILL if before is not None else None, before
    )
    return incremental.merge_watermarks(marks, incremental.BATCH_USER)


def all_rows(landed: DataFrame) -> DataFrame:
    """Every landed status as a typed row, for looking up retweeted and replied-to ones."""
    typed = flatten.flatten_status(landed, F.lit(S.BATCH_TIMELINE), keep=("user",))
    return typed.withColumn("screen_name", F.col("user.screen_name"))


def embedded_records(landed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The records inside retweets, in the shape of landed ones; ``keep`` carries columns of the retweet."""
    inside = landed.filter(F.col("retweeted_status.id").isNotNull())
    none = F.lit(None).cast(landed.schema["retweeted_status"].dataType).alias("retweeted_status")
    return inside.select("retweeted_status.*", *keep).select("*", none)


def referenced_rows(timeline: DataFrame, landed: DataFrame, processed: DataFrame,
                    max_level: int | None = None) -> DataFrame:
    """Retweeted and replied-to statuses of the timeline, found the way their seed was found.

    A retweeted status is taken from its own landed record, or else from inside the retweet. The
    ``ref_level`` of the timeline's rows limits how far they are followed (NULL: to the end).
    """
    seed = timeline.select(F.col("status_id").alias("found_id"), "batch_name", "original_user", "derived_user")
    body = all_rows(landed).withColumn("is_embedded", F.lit(0)).unionByName(
        all_rows(embedded_records(landed)).withColumn("is_embedded", F.lit(1))
    ).drop("original_user", "derived_user", "ref_status_id")
    links = body.groupBy("status_id").agg(
        F.min("created_at").alias("created_at"), F.max("retweeted_status_id").alias("retweeted_status_id"),
        F.max("in_reply_to_status_id").alias("in_reply_to_status_id"),
    )
    steps = lineage.follow_references(timeline.select("status_id", "ref_level"), links, processed, max_level)
    found = lookup_join(steps, body, "status_id", "inner", count_dim=False).join(seed, "found_id")
    step = ("batch_name", "found_id", "ref_status_id", "status_id", "via")
    return dedupe.one_per_status(found.withColumn("own", 1 - F.col("is_embedded")), step, "own").drop("own", "is_embedded")


def wanted_parts(spark: SparkSession, history: History, watched: DataFrame, settings: DataFrame, store: Store,
                 run: int) -> list[tuple[DataFrame, DataFrame]]:
    """What a run has to read of the history: pairs of (statuses, their watched users).

    That is what landed since the run before, of all watched users, and the older landings of those
    users only whose batch or date range is new.
    """
    asked = watched.select("batch_name", "screen_name").distinct().join(
        settings.select("batch_name", "cutoff_min", "cutoff_max"), "batch_name"
    )
    asked = asked.withColumn("wish", F.xxhash64(F.coalesce(F.col("cutoff_min").cast("string"), F.lit("")),
                                                F.coalesce(F.col("cutoff_max").cast("string"), F.lit(""))))
    wishes = asked.select("batch_name", "screen_name", "wish", F.lit(history.last(spark)).cast("bigint").alias("landing"))
    schema = wishes.schema
    before = read_epochs(spark, store.state("wishes"), schema, BACKFILL, run).groupBy("batch_name", "screen_name", "wish").agg(
        F.max("landing").alias("landing"))
    upto = before.agg(F.max("landing")).first()[0]
    write_epoch(wishes, store.state("wishes"), BACKFILL, run)
    if upto is None:
        return [(history.rows(spark, users=watched), watched)]
    fresh = cut_lineage(
        wishes.select("batch_name", "screen_name", "wish")
        .join(before.filter(F.col("landing") == upto), ["batch_name", "screen_name", "wish"], "left_anti"), "new-wishes",
    )
    parts = [(history.rows(spark, after=upto, users=watched), watched)]
    if not fresh.isEmpty():
        listed = watched.join(fresh, ["batch_name", "screen_name"], "left_semi")
        parts.append((history.rows(spark, upto=upto, users=fresh), listed))
    return parts


def run_backfill(spark: SparkSession, landed: DataFrame | History, definitions: DataFrame, store: Store,
                 run: int, max_level: int | None = None) -> None:
    """One back-fill run; ``run`` numbers the runs from 0.

    Repeating a run replaces its own results, and a run over unchanged input finds nothing
    new. Marks belong to a batch and a user; ids beyond them are new, and ids between them are compared
    with the ids stored, so what lands late is stored, too, and a user in several batches is read for
    each. Every watched user is read in every run. A batch may come in several definitions that list
    different users; their settings agree. A status that landed several times is
    stored once. References are followed as far as the batch's definition says, to the end where it
    says nothing, and never beyond ``max_level`` if that is given.
    """
    use_utc(spark)
    settings = batch_settings(definitions).dropDuplicates(["batch_name"])
    watched = watched_users(definitions)
    processed = read_epochs(spark, store.state("processed_replies"), _schema(spark, _PROCESSED), BACKFILL, run)
    seen_users = read_epochs(spark, store.state("processed_users"), _schema(spark, _USERS), BACKFILL, run)

    # a plain table is read whole; of a history only what is new or newly wanted
    parts = [(landed, watched)] if isinstance(landed, DataFrame) else wanted_parts(
        spark, landed, watched, settings, store, run)
    everything = landed if isinstance(landed, DataFrame) else landed.rows(spark)
    in_range = reduce(DataFrame.unionByName, [timeline_rows(rows, users, settings) for rows, users in parts])
    known = cut_lineage(backfill_marks(spark, store, run), "marks")
    fresh = incremental.unstored(in_range, known, stored_ids(spark, store, run))
    timeline = cut_lineage(dedupe.one_per_status(fresh, ("batch_name", "status_id")), "timeline")
    levels = timeline.join(F.broadcast(settings.select("batch_name", "ref_level")), "batch_name", "left")
    columns = [*timeline.columns, "via"]
    rows = timeline.withColumn("via", F.lit("timeline")).select(columns)
    if not settings.filter("ref_level IS NULL OR ref_level > 0").isEmpty():
        rows = rows.unionByName(referenced_rows(levels, everything, processed, max_level).select(columns))
    rows = cut_lineage(rows.withColumn("kind", F.lit(S.KIND_STATUS)), "statuses")
    write_routed(
        with_bucket(rows.drop("user", "screen_name", "via"), "system_create_ts"),
        epoch_path(store.table("statuses"), BACKFILL, run), "overwrite",
    )

    authors = dedupe.new_users(rows, seen_users)
    users = flatten.flatten_user(
        authors, F.col("filter_type"), F.col("original_user"), F.col("derived_user"), F.col("system_create_ts")
    )
    replace_epoch(users, store.table("users"), BACKFILL, run)
    written = spark.read.parquet(epoch_path(store.table("users"), BACKFILL, run))
    write_epoch(written.select("screen_name"), store.state("processed_users"), BACKFILL, run)
    upsert(registry.register_users(rows), store.state("registry"), BACKFILL, run,
           registry.REGISTRY_KEYS, registry.merge_registrations)
    ids = timeline.select("batch_name", "status_id", incremental.id_day(F.col("created_at")).alias("day"))
    write_epoch(ids.hint("rebalance", "day"), store.state("stored_ids"), BACKFILL, run, ("day",))
    write_epoch(
        incremental.user_watermarks(timeline, incremental.BATCH_USER), store.state("watermarks"), BACKFILL, run
    )
    write_epoch(rows.filter("via = 'reply'").select("status_id"), store.state("processed_replies"), BACKFILL, run)

    names = [r.select(F.col("user.screen_name").alias("screen_name"), "created_at") for r, _ in parts]
    seen = reduce(DataFrame.unionByName, names).groupBy("screen_name").agg(F.min("created_at").alias("oldest"))
    write_epoch(seen, store.state("oldest"), BACKFILL, run)
    oldest = read_epochs(spark, store.state("oldest"), seen.schema, BACKFILL, run + 1)
    write_epoch(
        run_modes(watched, settings, timeline, oldest, known).withColumn("run", F.lit(run).cast("bigint")),
        store.state("paging_modes"), BACKFILL, run,
    )


def run_modes(watched: DataFrame, settings: DataFrame, timeline: DataFrame, oldest: DataFrame,
              known: DataFrame) -> DataFrame:
    """Paging mode of every user after a run.

    A user's history is exhausted (FORWARD) once it reaches below the range, or a run finds nothing
    beyond the marks of the runs before. A user of whom nothing has landed yet is not exhausted,
    and neither a status above the range nor the mode keeps later runs from reading the user.
    """
    found = timeline.groupBy("batch_name", "screen_name").agg(F.count("*").alias("found"))
    oldest = oldest.groupBy("screen_name").agg(F.min("oldest").alias("oldest"))
    below = F.coalesce(F.col("oldest") < F.col("cutoff_min"), F.lit(False))
    nothing_new = (F.coalesce("found", F.lit(0)) == 0) & F.col("max_id").isNotNull()
    return (
        watched.select("batch_name", "screen_name").distinct()
        .join(settings.select("batch_name", "cutoff_min"), "batch_name")
        .join(found, ["batch_name", "screen_name"], "left")
        .join(oldest, "screen_name", "left")
        .join(known.select("batch_name", "screen_name", "max_id"), ["batch_name", "screen_name"], "left")
        .select("batch_name", "screen_name",
                F.when(below | nothing_new, S.MODE_FORWARD).otherwise(S.MODE_REVERSE).alias("paging_mode"))
    )
