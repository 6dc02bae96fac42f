"""Live collection: classify what the follow and keyword streams deliver, and store it."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsegrid import schemas as S
from pulsegrid.operators import classify, dedupe, flatten, incremental, patterns, registry
from pulsegrid.operators.skew import lookup_join
from pulsegrid.plans.backfill import Store, backfill_marks, embedded_records, stored_ids
from pulsegrid.sinks.buckets import read_keyed, upsert
from pulsegrid.sinks.routed import with_bucket, write_routed
from pulsegrid.sinks.state import LIVE, compact_epochs, epoch_path, read_epochs, replace_epoch, write_epoch
from pulsegrid.streaming.flows import AVAILABLE_NOW, read_keywords


MAX_BROADCAST_NAMES = 500_000
COMPACT_EVERY = 100


def classify_landed(landed: DataFrame, watched: DataFrame, accounts: DataFrame, keywords: DataFrame) -> DataFrame:
    """Typed rows with filter type, account, derived user and kind.

    ``landed`` carries ``batch_name``: the batch whose follow stream delivered the status, or
    STREAM_TRACKER for the keyword stream.
    """
    typed = flatten.flatten_status(
        landed, F.lit(None).cast("string"), keep=("batch_name", "user", "retweeted_status")
    ).withColumn("screen_name", F.col("user.screen_name"))
    tracker = classify.is_tracker(F.col("batch_name"))
    followed = classify.classify_followed(typed.filter(~tracker), watched, accounts)
    tracked = classify.classify_tracked(patterns.match_keywords(typed.filter(tracker), keywords))
    return followed.unionByName(tracked)


def _only(seen: DataFrame, names: DataFrame) -> DataFrame:
    """The processed users among ``names``, without shuffling the whole state table.

    The names of a micro-batch are broadcast after a check of their number; a larger set is
    joined by shuffle.
    """
    few = names.limit(MAX_BROADCAST_NAMES + 1).count() <= MAX_BROADCAST_NAMES
    return seen.join(F.broadcast(names) if few else names, "screen_name", "left_semi")


def before_cutoff(landed: DataFrame, settings: DataFrame) -> DataFrame:
    """Statuses created before the latest date of their batch; an empty date is open.

    Batches without settings (the keyword stream) have no bound.
    """
    bounds = settings.select("batch_name", "cutoff_max")
    bounded = landed.join(bounds, "batch_name", "left")
    return bounded.filter(F.col("cutoff_max").isNull() | (F.col("created_at") < F.col("cutoff_max"))).drop("cutoff_max")


def unfetched(landed: DataFrame, store: Store) -> DataFrame:
    """What the back-fill has not stored, and the whole keyword stream.

    This is how a batch is handed over: the stream goes on where the back-fill ended, and takes what
    landed late between its marks.
    """
    spark = landed.sparkSession
    tracker = classify.is_tracker(F.col("batch_name"))
    named = landed.filter(~tracker).withColumns({"screen_name": F.col("user.screen_name"), "status_id": F.col("id")})
    fresh = incremental.unstored(named, backfill_marks(spark, store), stored_ids(spark, store))
    return fresh.select(landed.columns).unionByName(landed.filter(tracker))


def of_followed(landed: DataFrame, watched: DataFrame, store: Store, epoch: int) -> DataFrame:
    """Statuses of watched and of registered users of their batch, and the whole keyword stream.

    The registry is read at each micro-batch, in the buckets of its users, so a user that was
    discovered is followed from the next one on.
    """
    spark = landed.sparkSession
    schema = spark.createDataFrame([], "batch_name string, screen_name string").schema
    tracker = classify.is_tracker(F.col("batch_name"))
    named = landed.filter(~tracker).withColumn("screen_name", F.col("user.screen_name"))
    registered = read_keyed(
        spark, store.state("registry"), schema, LIVE, epoch, of=named, keys=registry.REGISTRY_KEYS)
    names = watched.select("batch_name", "screen_name").unionByName(registered).distinct()
    followed = lookup_join(named, names, ["batch_name", "screen_name"], "inner")
    return followed.select(landed.columns).unionByName(landed.filter(tracker))


def unrolled(rows: DataFrame) -> DataFrame:
    """The records inside accepted retweets as rows of their own, found as the retweet was."""
    marked = rows.filter(F.col("kind") == S.KIND_STATUS).withColumn("found", F.struct(
        "batch_name", "kind", "status_id", "filter_type", "original_user", "derived_user", "system_create_ts"
    ))
    inside = embedded_records(marked, ("found",)).select("*", "found.batch_name", "found.kind")
    typed = flatten.flatten_status(
        inside, F.col("found.filter_type"), F.col("found.original_user"), F.col("found.derived_user"),
        F.col("found.status_id"), F.col("found.system_create_ts"),
        keep=("batch_name", "user", "retweeted_status", "kind"),
    )
    return typed.withColumn("screen_name", F.col("user.screen_name")).select(rows.columns)


def compact_state(spark: SparkSession, store: Store, upto: int) -> None:
    """Merge the stream's processed users up to an epoch that is closed."""
    users = spark.createDataFrame([], "screen_name string").schema
    compact_epochs(spark, store.state("processed_users"), users, LIVE, upto, lambda rows: rows.distinct())


def store_micro_batch(rows: DataFrame, store: Store, epoch: int) -> None:
    """Write one classified micro-batch; a replay of the epoch replaces what it wrote.

    The retweeted records inside accepted rows become rows of their own. Users are written once over all epochs and the back-fill; retweeted authors of accepted rows are merged into
    the registry's buckets. Every ``COMPACT_EVERY`` epochs the state of the closed ones is merged, so that a
    micro-batch reads few folders however long the stream has run.
    """
    spark = rows.sparkSession
    if epoch and epoch % COMPACT_EVERY == 0:
        compact_state(spark, store, epoch - 1)
    rows = rows.persist()
    try:
        stored = rows.unionByName(unrolled(rows))
        write_routed(
            with_bucket(stored.drop("user", "screen_name", "retweeted_status"), "system_create_ts"),
            epoch_path(store.table("statuses"), LIVE, epoch), "overwrite",
        )
        accepted = rows.filter(F.col("kind") == S.KIND_STATUS)
        user_path = store.state("processed_users")
        present = stored.filter(F.col("kind") == S.KIND_STATUS)
        names = present.select("screen_name").distinct()
        seen = read_epochs(spark, user_path, names.schema, LIVE, epoch)
        authors = dedupe.new_users(present, _only(seen, names))
        users = flatten.flatten_user(
            authors, F.col("filter_type"), F.col("original_user"), F.col("derived_user"), F.col("system_create_ts")
        )
        replace_epoch(users, store.table("users"), LIVE, epoch)
        written = spark.read.parquet(epoch_path(store.table("users"), LIVE, epoch))
        write_epoch(written.select("screen_name"), user_path, LIVE, epoch)
        discovered = accepted.filter(F.col("retweeted_status.user.screen_name").isNotNull()).select(
            "batch_name", "original_user", "created_at", "status_id",
            F.col("retweeted_status.user.screen_name").alias("screen_name"),
            F.col("retweeted_status.user.id").alias("user_id"),
        )
        upsert(registry.register_users(discovered), store.state("registry"), LIVE, epoch,
               registry.REGISTRY_KEYS, registry.merge_registrations)
    finally:
        rows.unpersist()


def note_progress(landed: DataFrame, store: Store, epoch: int) -> None:
    """The newest status time that each batch has met in this micro-batch, as state."""
    newest = landed.groupBy("batch_name").agg(F.max("created_at").alias("newest"))
    write_epoch(newest, store.state("progress"), LIVE, epoch)
    if epoch and epoch % COMPACT_EVERY == 0:
        compact_epochs(landed.sparkSession, store.state("progress"), newest.schema, LIVE, epoch - 1, _newest)


def _newest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("batch_name").agg(F.max("newest").alias("newest"))


class BatchesEnded(Exception):
    """Raised in place of a micro-batch that begins when all batches have passed their latest dates."""


def has_ended(spark: SparkSession, store: Store, settings: DataFrame, before: int | None = None) -> bool:
    """Whether every batch has met a status at or behind its latest date; an open date never ends."""
    schema = spark.createDataFrame([], "batch_name string, newest timestamp").schema
    seen = _newest(read_epochs(spark, store.state("progress"), schema, LIVE, before))
    left = settings.join(seen, "batch_name", "left").filter(
        F.col("cutoff_max").isNull() | F.col("newest").isNull() | (F.col("newest") < F.col("cutoff_max"))
    )
    return left.isEmpty()


def run_to_end(query: StreamingQuery, store: Store, settings: DataFrame, poll_sec: float = 5,
               timeout_sec: int | None = None) -> None:
    """Wait until a query of ``start_live(stop_at_latest=True)`` has ended; an idle one is stopped here.

    No micro-batch is cut off: a busy query ends before its next one, which stays unread in the checkpoint.
    """
    waited = 0.0
    try:
        while not query.awaitTermination(poll_sec):
            waited += poll_sec
            status = query.status
            idle = not status["isDataAvailable"] and not status["isTriggerActive"]
            if idle and has_ended(settings.sparkSession, store, settings):
                query.stop()
                return
            if timeout_sec is not None and waited >= timeout_sec:
                query.stop()
                raise TimeoutError(f"batches did not reach their latest dates in {timeout_sec} s")
    except StreamingQueryException as error:
        if BatchesEnded.__name__ not in str(error):
            raise


def start_live(landed: DataFrame, watched: DataFrame, accounts: DataFrame, keyword_path: str, store: Store,
               checkpoint: str, trigger: dict = AVAILABLE_NOW, settings: DataFrame | None = None,
               hand_over: bool = False, follow_registered: bool = False,
               stop_at_latest: bool = False) -> StreamingQuery:
    """Start collecting; the pattern table is read anew for every micro-batch.

    ``settings`` (see ``batch_config.batch_settings``) end each batch at its latest date;
    with ``stop_at_latest`` the query ends when all are past it (``run_to_end``). ``hand_over`` takes
    what the back-fill has not stored. ``follow_registered`` keeps what watched and discovered users
    write. A checkpoint belongs to one store: epochs continue where it left off.
    """
    def handle(batch: DataFrame, epoch: int) -> None:
        if stop_at_latest:
            if has_ended(batch.sparkSession, store, settings, epoch):
                raise BatchesEnded("all batches are past their latest dates")
            note_progress(batch, store, epoch)
        if settings is not None:
            batch = before_cutoff(batch, settings)
        if hand_over:
            batch = unfetched(batch, store)
        if follow_registered:
            batch = of_followed(batch, watched, store, epoch)
        keywords = read_keywords(batch.sparkSession, keyword_path)
        store_micro_batch(classify_landed(batch, watched, accounts, keywords), store, epoch)

    return (
        landed.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(**trigger).start()
    )
