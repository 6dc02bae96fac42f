"""Follow retweets and replies to the statuses they refer to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.times import arrival_id, arrival_key
from pulsegrid.operators.skew import lookup_counted, lookup_join
from pulsegrid.session import cut_lineage


def retweet_lineage(statuses: DataFrame, max_level: int | None = None) -> DataFrame:
    """The chain of retweeted statuses of every status, one row per step.

    Columns: origin_id, ref_status_id (the retweeting status), status_id (the retweeted one), level (1
    for a direct retweet). Chains are followed to their ends, or to ``max_level`` if given; a
    step to a status that the chain has reached before ends it, so cycles end, too. A status retweets
    one other; where copies of it disagree, the greatest id counts.

    Chains double their reach in each round: the steps known of the status at a chain's end are put
    behind it, so a chain of n steps takes about log2(n) rounds. Only ids travel. Many chains may end at one
    status, which is met as one row with all its steps, with hot ids salted. Ids that only point
    backwards cannot form cycles; otherwise each round drops the steps to statuses reached before.
    """
    edges = cut_lineage(
        statuses.filter(F.col("retweeted_status_id").isNotNull())
        .groupBy("status_id").agg(F.max("retweeted_status_id").alias("next")), "retweet-edges",
    )
    may_cycle = not edges.filter("next >= status_id").isEmpty()
    steps = added = edges.select(
        F.col("status_id").alias("origin_id"), F.col("status_id").alias("ref_status_id"),
        F.col("next").alias("status_id"), F.lit(1).alias("level"),
    )
    reach = 1
    while max_level is None or reach < max_level:
        ends = added.filter(F.col("level") == reach).select("origin_id", F.col("status_id").alias("end_id"))
        known = steps.groupBy(F.col("origin_id").alias("end_id")).agg(
            F.collect_list(F.struct("ref_status_id", "status_id", (F.col("level") + reach).alias("level"))).alias("steps")
        )
        if max_level is not None:
            known = known.withColumn("steps", F.filter("steps", lambda s: s["level"] <= max_level))
        met = lookup_join(ends, known, "end_id", "inner").select("origin_id", F.inline("steps"))
        if may_cycle:
            met = met.join(steps.select("origin_id", "status_id"), ["origin_id", "status_id"], "left_anti")
        added = cut_lineage(met.select(steps.columns), "retweet-round")
        if added.isEmpty():
            break
        steps = steps.unionByName(added)
        reach *= 2
    return steps


def unroll_retweets(
    statuses: DataFrame, max_level: int | None = None, embedded: DataFrame | None = None,
) -> DataFrame:
    """The retweeted statuses as rows of their own, tagged with ``ref_status_id``.

    They inherit how the retweeting status was found. ``embedded`` holds statuses that came
    inside retweets, with the columns of ``statuses`` but for how they were found; they give
    rows for retweeted statuses that are not in the table, and extend the chains. A status that
    is in neither gives no row.
    """
    found_by = statuses.select(
        F.col("status_id").alias("origin_id"), "filter_type", "original_user", "derived_user"
    )
    content = statuses.drop("filter_type", "original_user", "derived_user", "ref_status_id")
    chains = statuses.select("status_id", "retweeted_status_id")
    if embedded is not None:
        content = with_embedded(content, embedded)
        chains = content.select("status_id", "retweeted_status_id")
    own = statuses.filter(F.col("retweeted_status_id").isNotNull()).select(F.col("status_id").alias("origin_id"))
    steps = retweet_lineage(chains, max_level)
    if embedded is not None:
        steps = steps.join(own.distinct(), "origin_id", "left_semi")
    return lookup_join(steps, content, "status_id", "inner").join(found_by, "origin_id")


def with_embedded(content: DataFrame, embedded: DataFrame) -> DataFrame:
    """``content`` and those of the ``embedded`` statuses whose ids it lacks, each id once."""
    extra = embedded.select(content.columns).dropDuplicates(["status_id"])
    return content.unionByName(extra.join(content.select("status_id"), "status_id", "left_anti").select(content.columns))


def last_replies(children: DataFrame) -> DataFrame:
    """The latest reply to each parent: (status_id of the parent, ref_status_id).

    Combined map-side, so a parent with any number of replies is one row after the shuffle.
    Expects status_id, created_at, in_reply_to_status_id.
    """
    return (
        children.filter(F.col("in_reply_to_status_id").isNotNull())
        .groupBy(F.col("in_reply_to_status_id").alias("parent_id"))
        .agg(F.max(arrival_key(children)).alias("last"))
        .select(F.col("parent_id").alias("status_id"), arrival_id("last").alias("ref_status_id"))
    )


def reply_parents(children: DataFrame, statuses: DataFrame) -> DataFrame:
    """The statuses that were replied to, once each, tagged with their last reply.

    Both sides are unique in ``status_id``, so the join cannot be skewed.
    """
    return statuses.drop("ref_status_id").join(last_replies(children), "status_id")


def reply_threads(seeds: DataFrame, statuses: DataFrame, max_level: int | None = None) -> DataFrame:
    """Follow replies upwards from the seed statuses, to the roots (or ``max_level`` steps).

    Each status reached is returned once, at its smallest number of steps (``level``), with
    the latest of the replies that reached it (``ref_status_id``).

    Every status of a thread holds a pointer some steps up and its distance to the nearest seed below, as far
    as known. A round hands distances over the pointers and then doubles them, so a thread of n
    levels takes about log2(n) rounds. It ends when no distance gets shorter: farther ones can only
    follow from those, in cycles, too. Distances to one status are combined map-side; a pointer to it is looked up
    with hot ids salted.
    """
    links = statuses.select("status_id", "created_at", "in_reply_to_status_id")
    pointers = links.groupBy("status_id").agg(F.max("in_reply_to_status_id").alias("up"))
    parents = links.select(F.col("in_reply_to_status_id").alias("status_id")).dropna().distinct()
    replies, roots = pointers.filter("up IS NOT NULL"), pointers.filter("up IS NULL")
    start = seeds.select("status_id").distinct().withColumn("steps", F.lit(0))
    nodes = cut_lineage(
        replies.unionByName(roots.join(parents, "status_id", "left_semi")).join(start, "status_id", "left"),
        "reply-nodes",
    )
    reach = 1
    while max_level is None or reach <= max_level:
        arrived = nodes.filter("up IS NOT NULL AND steps IS NOT NULL").groupBy(F.col("up").alias("status_id")).agg(
            (F.min("steps") + reach).alias("arrived")
        )
        shorter = F.coalesce(F.col("arrived") < F.col("steps"), F.col("arrived").isNotNull())
        handed = nodes.join(arrived, "status_id", "left").select(
            "status_id", "up", F.least("steps", "arrived").alias("steps"), shorter.alias("is_shorter")
        )
        jumps = nodes.select(F.col("status_id").alias("up"), F.col("up").alias("far"))
        nodes = cut_lineage(
            lookup_join(handed, jumps, "up").select("status_id", F.col("far").alias("up"), "steps", "is_shorter"),
            "reply-round",
        )
        if nodes.filter("is_shorter").isEmpty():
            break
        reach *= 2
    below = links.filter("in_reply_to_status_id IS NOT NULL").join(
        nodes.filter("steps IS NOT NULL").select("status_id", "steps"), "status_id"
    )
    last = below.groupBy(F.col("in_reply_to_status_id").alias("parent_id")).agg(
        F.min(F.struct("steps", (-arrival_key(links)).alias("before"))).alias("first")
    ).select(
        F.col("parent_id").alias("status_id"), (-F.col("first.before")).alias("last"),
        (F.col("first.steps") + 1).alias("level"),
    )
    found = last.join(nodes.select("status_id"), "status_id", "left_semi")
    if max_level is not None:
        found = found.filter(F.col("level") <= max_level)
    return found.select("status_id", arrival_id("last").alias("ref_status_id"), "level")


def follow_references(
    seeds: DataFrame, links: DataFrame, processed: DataFrame, max_level: int | None = None,
) -> DataFrame:
    """Everything the seed statuses refer to, through any mix of retweets and replies.

    A retweet gives a row per retweeting status. A replied-to status gives one row overall,
    for its latest reply, and none when it is in ``processed`` (status_id). Columns: found_id
    (the seed), ref_status_id, status_id, via (``retweet`` or ``reply``), level. References are
    followed to their ends; ``max_level`` ends them earlier, as does a column ``ref_level`` of ``seeds``
    (NULL is no limit). A step that was made before ends its path, so cycles end, too.

    ``links``: (status_id, created_at, retweeted_status_id, in_reply_to_status_id), one row per
    status. ``seeds``: (status_id).
    """
    links = cut_lineage(links, "reference-links")
    if "ref_level" not in seeds.columns:
        seeds = seeds.withColumn("ref_level", F.lit(None).cast("int"))
    # a status that several batches found is followed as far as the farthest of them asks
    asked = seeds.groupBy("status_id").agg(
        F.max(F.coalesce("ref_level", F.lit(2147483647))).alias("ref_level")
    )
    frontier = links.join(asked, "status_id").withColumn("found_id", F.col("status_id"))
    done, found, level = processed.select("status_id"), None, 0
    while max_level is None or level < max_level:
        level += 1
        open_ = frontier.filter(F.col("ref_level") >= level)
        retweets = open_.filter(F.col("retweeted_status_id").isNotNull()).select(
            "found_id", F.col("status_id").alias("ref_status_id"),
            F.col("retweeted_status_id").alias("status_id"), F.lit("retweet").alias("via"), "ref_level",
        )
        if found is not None:
            step = ["found_id", "ref_status_id", "status_id"]
            retweets = retweets.join(found.filter("via = 'retweet'").select(step), step, "left_anti")
        replies = (
            open_.filter(F.col("in_reply_to_status_id").isNotNull())
            .groupBy(F.col("in_reply_to_status_id").alias("parent_id"))
            .agg(F.max(F.struct("created_at", "status_id", "found_id", "ref_level")).alias("last"))
            .select("last.found_id", F.col("last.status_id").alias("ref_status_id"),
                    F.col("parent_id").alias("status_id"), F.lit("reply").alias("via"), "last.ref_level")
            .join(done, "status_id", "left_anti")
        )
        steps = cut_lineage(retweets.unionByName(replies.select(retweets.columns)), "reference-steps")
        size = steps.count()
        if size == 0 and found is not None:
            break
        frontier = cut_lineage(
            lookup_counted(steps, size, links, "status_id").withColumn("level", F.lit(level)), "reference-round"
        )
        found = frontier if found is None else found.unionByName(frontier)
        done = done.unionByName(frontier.filter("via = 'reply'").select("status_id"))
    return found.select("found_id", "ref_status_id", "status_id", "via", "level")
