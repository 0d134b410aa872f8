"""The stored star schema: read from one snapshot, so that facts and dimensions belong together."""

from __future__ import annotations

from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from forgelake.schemas import DIMENSIONS, FACTS
from forgelake.sources.snapshot import Snapshot, snapshot
from forgelake.tables import Gold


def slices_of(view: Snapshot, table: str, first: date | None = None, last: date | None = None) -> list[str]:
    """The stored slices of a table between two days."""
    low, high = f"event_date={first or date.min}", f"event_date={last or date.max}"
    return [p for p in sorted(view.pieces(table)) if low <= p <= high]


def gold_in(view: Snapshot, first: date | None = None, last: date | None = None, with_slice: bool = False) -> Gold:
    """The gold tables of a snapshot with exactly the documented columns.

    ``first`` and ``last`` limit the facts to some slices; ``with_slice`` keeps their
    ``event_date``.
    """

    def dimension(name: str) -> DataFrame:
        return view.read(name, DIMENSIONS[name])

    def fact(name: str) -> DataFrame:
        columns = FACTS[name]["columns"]
        rows = view.read(name, {**columns, "event_date": "DATE"}, slices_of(view, name, first, last))
        return rows if with_slice else rows.select(*columns)

    return Gold(
        {
            **{name: partial(dimension, name) for name in DIMENSIONS},
            **{name: partial(fact, name) for name in FACTS},
        }
    )


def read_gold(spark: SparkSession, path: str, first: date | None = None, last: date | None = None, with_slice: bool = False) -> Gold:
    """The gold tables as the last whole run has left them; later runs do not change what is read."""
    return gold_in(snapshot(spark, path), first, last, with_slice)
