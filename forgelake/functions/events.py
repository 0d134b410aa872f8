"""Column expressions over raw events and silver rows."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from forgelake.schemas import COMMON_PATHS, TYPE_PATHS

# Fixed value: how events write their time, with or without fractions of a second.
ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX"


# Fixed value: how nearly all events write it. A cast reads such a text as the pattern above does, at
# a fraction of the cost, and its instant lies in the years 1 to 9999.
PLAIN_INSTANT = r"^(?!0000)\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z\z"
# Fixed value: how any text begins that ISO_INSTANT reads.
MAY_BE_INSTANT = r"^[+-]?\d{4,}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}"
# The first and the last microsecond of the years 1 to 9999, from the epoch.
FIRST_INSTANT, LAST_INSTANT = -62_135_596_800_000_000, 253_402_300_799_999_999


def instant_of(column: str) -> Column:
    """The instant that an ISO text with date, time and zone names; other texts give NULL.

    A cast would also read "12:30:00" as a time of the day of the run, and "2024" as a day. A column
    that is a timestamp already stays as it is; its type is known before any row is read.
    """
    text = F.col(column)
    # the pattern fails by an exception, which costs more than all else that is done to a line
    read = F.when(F.rlike(text, F.lit(MAY_BE_INSTANT)), F.try_to_timestamp(text, F.lit(ISO_INSTANT)))
    return F.when(F.typeof(text) == "timestamp", text.try_cast("timestamp")).otherwise(read)


def event_time() -> Column:
    """The event's instant; NULL where the text is none in the years 1 to 9999.

    Other years have no eight-digit date_id, and without them the number of days is bounded.
    """
    text, instant = F.col("created_at"), instant_of("created_at")
    bounded = F.when(F.unix_micros(instant).between(FIRST_INSTANT, LAST_INSTANT), instant)
    return F.when(F.rlike(text, F.lit(PLAIN_INSTANT)), text.try_cast("timestamp")).otherwise(bounded)


def common_columns() -> list[Column]:
    return [
        (event_time() if name == "created_at" else F.col(path)).alias(name)
        for name, path in COMMON_PATHS.items()
    ]


def type_columns(event_type: str) -> list[Column]:
    """The columns of one event type, for input that holds only that type."""
    return [F.col(path).alias(name) for name, (path, _) in TYPE_PATHS[event_type].items()]


def sparse_columns() -> list[Column]:
    """The columns of all event types, each NULL off its own type.

    One path feeds several columns (``payload.action`` alone feeds four), so the type
    decides which of them takes the value.
    """
    return [
        F.when(F.col("type") == event_type, F.col(path)).alias(name)
        for event_type, fields in TYPE_PATHS.items()
        for name, (path, _) in fields.items()
    ]


def recency() -> Column:
    """One number that orders events by (created_at, numeric event_id).

    A struct would order the same way, but an aggregate over it sorts its whole input;
    a decimal stays in the hash aggregate. The instant in microseconds times 10^19 plus a
    BIGINT id stays below 10^37.
    """
    instant = F.unix_micros("created_at").cast("decimal(18,0)")
    event = F.coalesce(F.col("event_id").try_cast("bigint"), F.lit(0))
    return (instant * F.lit(Decimal(10**19)) + event.cast("decimal(19,0)")).cast(
        "decimal(38,0)"
    )


def actor_type(login: Column) -> Column:
    return F.when(login.endswith("[bot]"), F.lit("Bot")).otherwise(F.lit("User"))


def count_where(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, one digit, as DOUBLE."""
    return F.round(F.lit(100.0).cast("double") * part / whole, 1)
