"""Time formats of batch definitions, file stamps and the long date text.

All functions assume the UTC session zone (``session.use_utc``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Formats used in definitions, file names and logs.
BATCH_FORMAT = "dd/MM/yyyy-HH:mm:ss"
FILE_STAMP_FORMAT = "yyyyMMddHHmmss"
HOUR_STAMP_FORMAT = "yyyyMMddHH"

# Minutes east of UTC for the zone names met in date texts. Names that are
# used for several zones take the one of the source deployment (IST is India).
ZONE_MINUTES = {
    "UTC": 0, "GMT": 0, "BST": 60, "CET": 60, "CEST": 120, "IST": 330, "SGT": 480, "JST": 540,
    "EDT": -240, "EST": -300, "CDT": -300, "CST": -360, "MDT": -360, "MST": -420,
    "PDT": -420, "PST": -480,
}


def parse_batch_time(col: Column, fmt: str = BATCH_FORMAT) -> Column:
    """Timestamp of a definition's text; empty or malformed text gives NULL."""
    return F.try_to_timestamp(col, F.lit(fmt))


def format_batch_time(col: Column) -> Column:
    return F.date_format(col, BATCH_FORMAT)


def file_stamp(col: Column) -> Column:
    return F.date_format(col, FILE_STAMP_FORMAT)


def hour_stamp(col: Column) -> Column:
    return F.date_format(col, HOUR_STAMP_FORMAT)


def long_date_text(col: Column) -> Column:
    """``Fri Oct 10 14:13:24 UTC 2014``."""
    return F.date_format(col, "EEE MMM dd HH:mm:ss 'UTC' yyyy")


def parse_long_date(col: Column) -> Column:
    """Read ``Fri Oct 10 14:13:24 IST 2014`` as a UTC timestamp.

    The weekday is ignored and the zone name goes through ``ZONE_MINUTES``; an unknown
    zone gives NULL rather than a silently shifted time.
    """
    zones = F.create_map(*[F.lit(x) for pair in ZONE_MINUTES.items() for x in pair])

    def read(part: Column) -> Column:
        wall = F.try_to_timestamp(
            F.concat_ws(" ", *[F.get(part, F.lit(i)) for i in (1, 2, 3, 5)]), F.lit("MMM dd HH:mm:ss yyyy")
        )
        return F.timestamp_add("MINUTE", -F.try_element_at(zones, F.get(part, F.lit(4))), wall)

    # the parts are split once: they are the variable of a one-element transform
    return F.get(F.transform(F.array(F.split(col, " ")), read), F.lit(0))


_ID_RANGE = "18446744073709551616BD"
_HALF_RANGE = "9223372036854775808BD"
_TIMES = (T.TimestampType, T.TimestampNTZType)


def arrival_key(rows: DataFrame, time: str = "created_at", id: str = "status_id") -> Column:
    """(time, id) of ``rows`` as one number in the same order, which hash aggregates can hold.

    NULL if the time or the id is.
    """
    is_time = isinstance(rows.schema[time].dataType, _TIMES)
    number = f"unix_micros(CAST({time} AS timestamp))" if is_time else f"CAST({time} AS bigint)"
    return F.expr(f"CAST({number} AS decimal(19, 0)) * {_ID_RANGE} + {id}").cast("decimal(38, 0)")


def arrival_id(key: str) -> Column:
    """The id in an ``arrival_key``."""
    return F.expr(f"CAST(pmod({key} + {_HALF_RANGE}, {_ID_RANGE}) - {_HALF_RANGE} AS bigint)")


def arrival_time(key: str, rows: DataFrame, time: str = "created_at") -> Column:
    """The time in an ``arrival_key``, with the type that it has in ``rows``."""
    kind = rows.schema[time].dataType
    shifted = f"({key} + {_HALF_RANGE})"
    number = F.expr(f"CAST(({shifted} - pmod({shifted}, {_ID_RANGE})) / {_ID_RANGE} AS bigint)")
    return (F.timestamp_micros(number) if isinstance(kind, _TIMES) else number).cast(kind)


def arrival(key: str, rows: DataFrame) -> Column:
    """The struct (created_at, status_id) of an ``arrival_key``."""
    return F.struct(arrival_time(key, rows).alias("created_at"), arrival_id(key).alias("status_id"))
