"""The set of gold tables that questions are put to."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class Gold(Mapping[str, DataFrame]):
    """The gold tables by name; each plan is made when the table is first asked for.

    A question touches two or three of the seven, and analysing the others would cost more
    driver time than a short query takes.
    """

    def __init__(self, tables: Mapping[str, Callable[[], DataFrame]]):
        self._make = dict(tables)
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._make[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._make)

    def __len__(self) -> int:
        return len(self._make)

    def with_tables(self, **tables: DataFrame) -> Gold:
        """The same tables with some replaced, for instance by an enriched dimension."""
        return Gold({**self._make, **{name: lambda df=df: df for name, df in tables.items()}})
