"""Raw events to the sparse, typed silver table."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.functions.calendar import utc_day
from forgelake.functions.events import common_columns, event_time, sparse_columns, type_columns
from forgelake.schemas import COMMON_PATHS, SILVER_TYPES, TYPE_PATHS


def is_core() -> Column:
    """Whether a raw event is of a known type and carries an id and a readable time."""
    return F.col("type").isin(*TYPE_PATHS) & F.col("id").isNotNull() & event_time().isNotNull()


def core_events(bronze: DataFrame) -> DataFrame:
    return bronze.filter(is_core())


def flatten(bronze: DataFrame, event_date: Column | None = None, *extra: str) -> DataFrame:
    """All types in one pass: no shuffle, no cache, no job per type.

    ``event_date`` is the slice a row is stored under; by default the day of the event. ``extra``
    keeps further columns of bronze, such as the hour.
    """
    slice_day = utc_day(event_time()) if event_date is None else event_date
    return core_events(bronze).select(
        *common_columns(), *sparse_columns(), slice_day.cast("date").alias("event_date"), *extra
    )


def flatten_type(bronze: DataFrame, event_type: str) -> DataFrame:
    """One event type with only its own columns, straight from raw events."""
    rows = bronze.filter(F.col("type") == event_type)
    return core_events(rows).select(*common_columns(), *type_columns(event_type))


def of_type(silver: DataFrame, event_type: str) -> DataFrame:
    """One event type as a projection of the sparse table."""
    return silver.filter(F.col("event_type") == event_type).select(
        *COMMON_PATHS, *TYPE_PATHS[event_type]
    )


def union_types(frames: Iterable[DataFrame]) -> DataFrame:
    """Per-type frames back into one sparse frame; columns a frame lacks become NULL."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.select(*[c for c in SILVER_TYPES if c in stacked.columns])


def event_types_present(bronze: DataFrame) -> DataFrame:
    return bronze.select(F.col("type").alias("event_type")).distinct()


def counts_by_type(silver: DataFrame) -> DataFrame:
    return silver.groupBy("event_date", "event_type").agg(F.count(F.lit(1)).alias("events"))


def drop_repeats(silver: DataFrame) -> DataFrame:
    """One row per event_id of a silver table, by content where copies differ."""
    rows = silver.select("event_id", F.struct(*silver.columns).alias("row"))
    order = F.struct(F.col("row.event_date"), F.xxhash64("row"))
    return rows.groupBy("event_id").agg(F.min_by("row", order).alias("row")).select("row.*")
