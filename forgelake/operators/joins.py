"""Joins that hold up when one key owns a large share of the rows.

Most questions need none of this: they aggregate by id before they join names. Where rows or
pairs must meet names, a plain join does: Spark broadcasts the names if they are small, and if
not, adaptive execution splits the partition of a heavy key, since both sides come straight out
of a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_calendar(fact: DataFrame, dim_date: DataFrame, *columns: str) -> DataFrame:
    """Join calendar columns to a fact without moving the fact.

    Dim_Date has one row per day, and four-digit years hold 3.65 million days: with the
    few narrow columns taken here the broadcast stays under 150 MB however many events
    there are, and at some thousand rows in practice.
    """
    return fact.join(F.broadcast(dim_date.select("date_id", *columns)), "date_id")


def repeat_rows(df: DataFrame, times: str, most: int = 1_000_000) -> DataFrame:
    """Each row as often as column ``times`` says, which is dropped.

    Rows with few copies are repeated where they lie. Large numbers are cut into pieces of at
    most ``most``, and only these are dealt to other tasks, so that no task has to hold or write
    all copies of one row.
    """
    keys = [c for c in df.columns if c != times]

    def repeated(rows: DataFrame, copies: Column) -> DataFrame:
        return rows.select(*keys, F.explode(F.sequence(F.lit(1).cast("bigint"), copies)).alias("_copy")).select(*keys)

    few, many = df.filter(F.col(times) <= most), df.filter(F.col(times) > most)
    pieces = many.select(
        *keys,
        times,
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({times} - 1) DIV {most}"))).alias("_piece"),
    ).repartition(*keys, "_piece")
    left = F.col(times) - F.col("_piece") * most
    return repeated(few, F.col(times)).unionAll(repeated(pieces, F.least(left, F.lit(most).cast("bigint"))))
