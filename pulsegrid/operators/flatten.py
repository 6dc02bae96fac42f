"""Flatten landed status and author records to typed rows, and typed rows to the wide layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid import schemas as S
from pulsegrid.functions.text import absent_id_to_null
from pulsegrid.functions.times import (
    format_batch_time, long_date_text, parse_batch_time, parse_long_date,
)

def _or_null(text: Column | None) -> Column:
    return F.lit(None).cast("string") if text is None else text


def flatten_status(
    landed: DataFrame,
    filter_type: Column,
    original_user: Column | None = None,
    derived_user: Column | None = None,
    ref_status_id: Column | None = None,
    load_time: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One typed row per landed status; how it was found is given by the column arguments.

    ``keep`` names extra landed columns to carry through (such as ``batch_name``).
    """
    ref = F.lit(None) if ref_status_id is None else absent_id_to_null(ref_status_id)
    reply_to = absent_id_to_null(F.col("in_reply_to_status_id"))
    columns = {
        "filter_type": filter_type,
        "original_user": _or_null(original_user),
        "derived_user": _or_null(derived_user),
        "system_create_ts": F.current_timestamp() if load_time is None else load_time,
        "status_id": F.col("id"),
        "user_id": F.col("user.id"),
        "created_at": F.col("created_at"),
        "ref_status_id": ref.cast("bigint"),
        "lang": F.col("lang"),
        "source": F.col("source"),
        "text": F.col("text"),
        "favorite_count": F.col("favorite_count"),
        "retweet_count": F.col("retweet_count"),
        "current_user_retweet_id": absent_id_to_null(F.col("current_user_retweet_id")),
        "in_reply_to_user_id": absent_id_to_null(F.col("in_reply_to_user_id")),
        "in_reply_to_status_id": reply_to,
        "is_reply": reply_to.isNotNull(),
        "in_reply_to_screen_name": F.col("in_reply_to_screen_name"),
        "is_favorited": F.col("favorited"),
        "is_possibly_sensitive": F.col("possibly_sensitive"),
        "is_retweet": F.col("retweeted_status").isNotNull(),
        "is_retweeted": F.col("retweeted"),
        "is_truncated": F.col("truncated"),
        "retweeted_status_id": F.col("retweeted_status.id"),
        "latitude": F.col("geo.latitude"),
        "longitude": F.col("geo.longitude"),
        "place": F.col("place"),
        "contributors": F.col("contributors"),
        "media_urls": F.col("media_urls"),
        "symbols": F.col("symbols"),
        "urls": F.col("urls"),
        "mentions": F.col("mentions"),
        "scope_place_ids": F.col("scopes.place_ids"),
        "hashtags": F.col("hashtags"),
    }
    return landed.select(*[c.alias(n) for n, c in columns.items()], *keep)


def flatten_user(
    landed: DataFrame,
    filter_type: Column,
    original_user: Column | None = None,
    derived_user: Column | None = None,
    load_time: Column | None = None,
) -> DataFrame:
    """The author of each landed status as a typed row (one row per status; see ``dedupe``)."""
    return landed.select(
        filter_type.alias("filter_type"),
        _or_null(original_user).alias("original_user"),
        _or_null(derived_user).alias("derived_user"),
        (F.current_timestamp() if load_time is None else load_time).alias("system_create_ts"),
        *[F.col(f"user.{name}").alias(name) for name in S.USER_FIELDS],
        F.col("user.description_urls").alias("description_urls"),
    )


def entity_slots(array: Column, prefix: str, slots: int = S.SLOTS) -> list[Column]:
    """The first ``slots`` elements as text columns ``prefix_0 ..``, padded with NULL."""
    return [
        F.get(array, F.lit(i)).cast("string").alias(name)
        for i, name in enumerate(S.slot_names(prefix, slots))
    ]


def slot_overflow(array: Column, slots: int = S.SLOTS) -> Column:
    """How many elements do not fit in the slots (they stay in the array)."""
    return F.greatest(F.coalesce(F.size(array), F.lit(0)) - slots, F.lit(0))


def _as_text(typed: str, column: Column) -> Column:
    if typed == "created_at":
        return long_date_text(column)
    if typed == "system_create_ts":
        return format_batch_time(column)
    return column.cast("string")


def wide_status(statuses: DataFrame) -> DataFrame:
    """The wide all-text layout; expects hashtags already expanded to a ``hashtag`` column."""
    scalars = [_as_text(t, F.col(t)).alias(w) for w, t in S.STATUS_SCALARS]
    slots = [s for prefix, t in S.STATUS_SLOT_GROUPS for s in entity_slots(F.col(t), prefix)]
    return statuses.select(*scalars, *slots, F.col("hashtag").alias(S.STATUS_HASHTAG))


_SCOPES = "scope_place_ids"


def wide_overflow(statuses: DataFrame, slots: int = S.SLOTS) -> DataFrame:
    """(status_id, entity, position, value): what the wide layout has no room for.

    Elements from number ``slots`` on, and all place ids of the scope, which the layout lacks. Written next
    to the wide rows it makes them complete; see ``typed_status``.
    """
    def rest(typed: str, first: int) -> Column:
        values = F.col(typed).cast("array<string>")
        element = "struct<entity:string,position:int,value:string>"
        listed = F.transform(values, lambda v, i: F.struct(
            F.lit(typed).alias("entity"), i.alias("position"), v.alias("value")))
        return F.coalesce(
            F.filter(listed, lambda e: e["position"] >= first), F.expr(f"CAST(array() AS array<{element}>)")
        )

    parts = [rest(typed, slots) for _, typed in S.STATUS_SLOT_GROUPS] + [rest(_SCOPES, 0)]
    return statuses.select("status_id", F.inline(F.concat(*parts)))


def wide_user(users: DataFrame) -> DataFrame:
    scalars = [_as_text(t, F.col(t)).alias(w) for w, t in S.USER_SCALARS]
    prefix, urls = S.USER_SLOT_GROUP
    return users.select(*scalars, *entity_slots(F.col(urls), prefix))


def typed_status(wide: DataFrame, overflow: DataFrame | None = None) -> DataFrame:
    """Typed rows from the wide layout, one per hashtag as loaded (column ``hashtag``).

    The inverse of ``wide_status``: absent ids (-1 or NULL) become NULL, slots become arrays
    again, malformed numbers and dates become NULL. With the rows of ``wide_overflow`` the arrays are
    complete; without them they end at the last slot and scope place ids are unknown.
    """
    types = {f.name: f.dataType for f in T.DataType.fromDDL(S.STATUS_DDL).fields}

    def scalar(name: str, text: Column) -> Column:
        if name == "created_at":
            return parse_long_date(text)
        if name == "system_create_ts":
            return parse_batch_time(text)
        value = text.try_cast(types[name])
        return absent_id_to_null(value) if name.endswith("_id") and name != "status_id" else value

    rest = None
    if overflow is not None:
        entries = overflow.groupBy("status_id", "entity").agg(
            F.array_sort(F.collect_set(F.struct("position", "value"))).alias("e")
        )
        rest = entries.groupBy(F.col("status_id").alias("_owner")).agg(F.map_from_entries(
            F.collect_list(F.struct("entity", F.transform("e", lambda x: x["value"])))).alias("_rest"))
        # a status has few overflow rows; statuses without any keep their slots. The few are hashed, so that
        # no task sorts wide rows
        status_id = F.col("statusId").cast("bigint")
        wide = wide.join(rest.hint("shuffle_hash"), status_id == F.col("_owner"), "left")

    def slots(typed: str, element: str = "string") -> Column:
        """The slots as they are, NULLs included, with what did not fit."""
        values = F.array(*[F.col(c) for c in S.slot_names(groups[typed])])
        if rest is not None:
            values = F.concat(values, _beyond(typed))
        return F.transform(values, lambda v: v.try_cast(element))

    def present(values: Column) -> Column:
        return F.filter(values, lambda v: v.isNotNull())

    text_of = {typed: F.col(name) for name, typed in S.STATUS_SCALARS}
    place = {typed.split(".")[1]: text for typed, text in text_of.items() if typed.startswith("place.")}
    columns = [scalar(t, c).alias(t) for t, c in text_of.items() if not t.startswith("place.")]
    has_place = F.coalesce(*place.values()).isNotNull()
    columns.append(F.when(has_place, F.struct(*[c.alias(n) for n, c in place.items()])).alias("place"))
    groups = {typed: prefix for prefix, typed in S.STATUS_SLOT_GROUPS}
    columns.append(present(slots("contributors", "bigint")).alias("contributors"))
    columns += [present(slots(t)).alias(t) for t in ("media_urls", "symbols", "urls")]
    # names and ids are paired by position before empty pairs are dropped
    pairs = F.zip_with(
        slots("mentions.screen_name"), slots("mentions.id", "bigint"),
        lambda name, id: F.struct(name.alias("screen_name"), id.alias("id")),
    )
    mentions = F.filter(pairs, lambda m: m["screen_name"].isNotNull() | m["id"].isNotNull())
    scopes = F.lit(None).cast("array<string>") if rest is None else F.try_element_at("_rest", F.lit(_SCOPES))
    return wide.select(
        *columns, mentions.alias("mentions"), scopes.alias(_SCOPES), F.col(S.STATUS_HASHTAG).alias("hashtag")
    )


def _beyond(typed: str) -> Column:
    return F.coalesce(F.try_element_at("_rest", F.lit(typed)), F.expr("CAST(array() AS array<string>)"))


# The names a projection list may use, with the typed column each one stands for.
PROJECTION_NAMES = {
    "status": {"Id": "status_id", "Text": "text", "FavoriteCount": "favorite_count"},
    "user": {"Name": "name", "Location": "location", "FollowersCount": "followers_count"},
}


def project_names(df: DataFrame, record: str, names: list[str]) -> DataFrame:
    """Projection by a configured list of qualified names."""
    known = PROJECTION_NAMES[record]
    unknown = [n for n in names if n not in known]
    if unknown:
        raise ValueError(f"unknown {record} fields: {unknown}")
    return df.select([F.col(known[n]) for n in names])


def limit_records(statuses: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` statuses in arrival order (a configured cap on one run's output).

    Counts per day, then per minute of the one day in which the limit is reached, give the
    minute behind which no row is needed; later rows are filtered at the scan. Only what is
    left is ranked, instead of ``limit`` rows of every task.
    """
    kind = statuses.schema["created_at"].dataType

    def reached(rows: DataFrame, unit: str, before: Column):
        """(start of the unit that holds the last row, rows before it)."""
        units = rows.groupBy(F.date_trunc(unit, "created_at").cast(kind).alias("start")).agg(F.count("*").alias("n"))
        order = Window.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        sums = units.select("start", (before + F.coalesce(F.sum("n").over(order), F.lit(0))).alias("before"))
        return sums.filter(F.col("before") < limit).agg(F.max(F.struct("start", "before")).alias("last"))

    day = reached(statuses, "day", F.lit(0)).first().last
    if day is None:
        return statuses.limit(0)
    start = F.lit(day.start).cast(kind)
    of_day = statuses.filter((F.col("created_at") >= start) & (F.col("created_at") < start + F.expr("interval 1 day")))
    minute = reached(of_day, "minute", F.lit(day.before)).first().last.start
    behind = F.lit(minute).cast(kind) + F.expr("interval 1 minute")
    return statuses.filter(F.col("created_at") < behind).orderBy("created_at", "status_id").limit(limit)
