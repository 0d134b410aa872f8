"""The three facts: a filter and a projection of silver each, with no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.functions.calendar import date_id, utc_day
from forgelake.schemas import FACTS, SILVER_TYPES


def fact(silver: DataFrame, name: str, *extra: str) -> DataFrame:
    """One row per event. ``extra`` keeps further silver columns, such as the slice day."""
    columns = []
    for column, sql_type in FACTS[name]["columns"].items():
        if column == "date_id":
            columns.append(date_id(utc_day(F.col("created_at"))).alias("date_id"))
        elif SILVER_TYPES[column] != sql_type:
            # Raw integers are BIGINT; one that does not fit the narrower type becomes NULL.
            columns.append(F.col(column).try_cast(sql_type).alias(column))
        else:
            columns.append(F.col(column))
    return silver.filter(F.col("event_type").isin(*FACTS[name]["types"])).select(*columns, *extra)
