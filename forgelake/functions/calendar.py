"""Calendar expressions. All compile to code, and none depends on the session's time zone."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def day_number(moment: Column) -> Column:
    """Days from the epoch to the UTC day of an instant, for exact arithmetic over days."""
    micros = F.unix_micros(moment)
    # DIV cuts towards zero; without the part of a day nothing is left to cut
    return F.call_function("div", micros - F.pmod(micros, F.lit(MICROS_PER_DAY)), F.lit(MICROS_PER_DAY))


def utc_day(moment: Column) -> Column:
    """The UTC day of an instant."""
    return F.date_from_unix_date(day_number(moment).cast("int"))


def date_id(day: Column) -> Column:
    """YYYYMMDD of a DATE as an INT."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def date_id_of(day: date) -> int:
    return int(day.strftime("%Y%m%d"))


def calendar_columns(day: Column) -> list[Column]:
    return [
        date_id(day).alias("date_id"),
        day.alias("date_actual"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"),
        F.weekofyear(day).alias("week_of_year"),
        F.date_format(day, "EEEE").alias("weekday_name"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        F.extract(F.lit("YEAROFWEEK"), day).cast("int").alias("iso_year"),
    ]
