"""Bronze to silver, with each event id stored once.

The JSON is parsed once, into flat rows that lie in a folder of the run. What is to be found out
about repeats is found out from their ids: which occur twice among these rows, and which other
slices have (see ``operators.repeats``). Then the rows are written to their slices, without
those that another copy goes before.

Of all copies of an id that bronze holds, that in the earliest slice is stored, in it that of the
earliest hour. A run that brings a slice in front of stored ones therefore changes these too,
where they have an id of its; and a slice that comes again without an id gives it back to the
next slice that has it. Those later slices are renewed in the same run, so that silver does not depend
on the order of runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from forgelake.functions.events import common_columns, sparse_columns
from forgelake.operators.repeats import IDS, ID_TYPES, elsewhere, put_ids, sightings, verdicts, without_repeats
from forgelake.operators.silver import flatten, is_core
from forgelake.schemas import SILVER_TYPES
from forgelake.session import prepare, room_for, together
from forgelake.sources.bronze import bad_line, read_bronze, read_bronze_dated
from forgelake.sources.lake import (
    bytes_of,
    day_slices,
    days_between,
    exists,
    hadoop_path,
    read_silver,
    replace_slices,
    stored_days,
)
from forgelake.sources.snapshot import Run

#: Digits of the mark that orders copies by content.
MARK = 10**15


@dataclass
class Renewed:
    """The rows stored, and the days beyond those of the run whose silver changed with them."""

    rows: int
    changed: list[date]


def write_silver(rows: DataFrame, path: str, slices: Iterable[str], seen: Observation | None = None) -> None:
    """Rows lie sorted by type in each file, so a filter on the type skips pages and row groups."""
    replace_slices(rows.select(*SILVER_TYPES), path, ("event_date",), slices, sort_by=("event_type",), seen=seen)


def write_quarantine(bad: DataFrame, base: str, slices: Iterable[str]) -> None:
    replace_slices(bad, f"{base}/quarantine", ("event_date",), slices)


def staged(events: DataFrame, bad_lines: bool) -> DataFrame:
    """All that one pass over raw events is to find: flat rows, and bad lines beside or instead of them.

    ``core`` tells which rows silver takes; ``bad`` is what quarantine takes, NULL for good lines.
    """
    is_bad, columns = bad_line()
    bad = F.when(is_bad, F.struct(*columns)) if bad_lines else F.lit(None).cast("string")
    rows = events.select(
        is_core().alias("core"), *common_columns(), *sparse_columns(), F.col("event_date").cast("date").alias("event_date"),
        "event_hour", bad.alias("bad"),
    )
    return rows.filter(F.col("core") | F.col("bad").isNotNull())


def numbered(rows: DataFrame) -> DataFrame:
    """With ``number``, unique in the table that is written from it, and ``mark``, a hash of the content."""
    mark = F.pmod(F.xxhash64(*[c for c in SILVER_TYPES if c != "event_date"]), F.lit(MARK))
    return rows.withColumns({"number": F.monotonically_increasing_id(), "mark": mark})


def renew_silver(
    spark: SparkSession,
    base: str,
    first: date,
    last: date | None = None,
    dedupe: bool = True,
    dated: bool = False,
    bad_lines: bool = False,
) -> Renewed:
    """Bronze of some days to silver and, with ``bad_lines``, to quarantine, in one pass over the JSON.

    All days must be in bronze: a day that is missing there stops the run before anything stored
    is touched. A day without core events leaves an empty slice. ``dedupe`` stores an id once;
    ``dated`` reads bronze laid out as ``2024/01/31/05.json``.
    """
    last, bronze = last or first, f"{base}/bronze"
    days, slices, seen = days_between(first, last), day_slices(first, last), Observation("silver")
    if not dated:
        missing = set(slices) - set(stored_days(spark, bronze, first, last))
        if missing:
            raise ValueError(f"nothing in {bronze} for {', '.join(sorted(missing))}")
    read = read_bronze_dated if dated else read_bronze
    events = read(prepare(spark), bronze, first, last)
    with room_for(spark, bytes_of(events)):
        if not dedupe and not bad_lines:
            write_silver(flatten(events, event_date=F.col("event_date")), f"{base}/silver", slices, seen)
            return Renewed(seen.get["rows"], [])
        stage = f"{base}/staging/{uuid.uuid4().hex}"
        try:
            numbered(staged(events, bad_lines)).write.parquet(f"{stage}/rows")
            rows = spark.read.parquet(f"{stage}/rows")
            core, changed = rows.filter("core").drop("core", "bad"), []

            def fill_silver() -> None:
                if dedupe:
                    changed.extend(_without_repeats(spark, base, core, days, read, stage, seen))
                else:
                    write_silver(core, f"{base}/silver", slices, seen)

            def set_aside() -> None:
                write_quarantine(rows.filter("bad IS NOT NULL").select("bad.*", "event_date"), base, slices)

            together(spark, fill_silver, *[set_aside] * bad_lines)
            return Renewed(seen.get["rows"], changed)
        finally:
            files, folder = hadoop_path(spark, stage)
            files.delete(folder, True)


def _later_slices(index: Run, ids: DataFrame, days: list[date], stage: str) -> list[date]:
    """The stored slices, not of these days, that hold an id which an earlier one of these days has got or lost."""
    pieces = [f"event_date={d}" for d in days]
    others = [p for p in index.parts.get(IDS, {}) if p not in pieces and p > pieces[0]]
    if not others:
        return []
    now = ids.select(*ID_TYPES)
    before = index.read(IDS, ID_TYPES, pieces)
    moved = now.exceptAll(before).union(before.exceptAll(now)) if set(pieces) & set(index.parts[IDS]) else now
    moved.write.parquet(f"{stage}/moved")
    found = elsewhere(index, index.spark.read.parquet(f"{stage}/moved"), others, f"{stage}/later")
    # a day per slice that changes
    return sorted(r.other for r in found.filter(F.col("other") > F.col("event_date")).select("other").distinct().collect())


def _again(spark: SparkSession, base: str, days: list[date], read, dated: bool) -> DataFrame:
    """Flat rows of further days: from bronze, or from silver where bronze has been cleaned up."""
    bronze = f"{base}/bronze"
    there = [d for d in days if exists(spark, f"{bronze}/{d:%Y/%m/%d}" if dated else f"{bronze}/event_date={d}")]
    gone = [d for d in days if d not in there]
    parts = []
    if there:
        parts.append(staged(read(spark, bronze, there[0], there[0], there[1:]), False).filter("core").drop("core", "bad"))
    if gone:
        kept = read_silver(spark, f"{base}/silver", gone[0], gone[0], gone[1:])
        parts.append(kept.withColumn("event_hour", F.lit(0)))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # beyond all numbers of the first stage
    return numbered(rows).withColumn("number", F.col("number") + F.lit(1 << 61))


def _without_repeats(spark, base, rows, days, read, stage, seen) -> list[date]:
    """Store the rows, and those of later slices that change with them, without repeats; the days of these slices."""
    index = Run(spark, f"{base}/silver_ids")
    own_days = list(days)

    def sighted(frame: DataFrame, name: str) -> DataFrame:
        sightings(frame).write.parquet(f"{stage}/{name}")
        return spark.read.parquet(f"{stage}/{name}")

    ids = sighted(rows, "ids")
    changed = _later_slices(index, ids, own_days, stage)
    if changed:
        _again(spark, base, changed, read, read is read_bronze_dated).write.parquet(f"{stage}/again")
        more = spark.read.parquet(f"{stage}/again")
        rows, ids = rows.unionByName(more), ids.unionByName(sighted(more, "ids_again"))
        days = sorted([*days, *changed])
    pieces = [f"event_date={d}" for d in days]
    others = [p for p in index.parts.get(IDS, {}) if p not in pieces and p < pieces[-1]]
    known = elsewhere(index, ids.select(*ID_TYPES), others, f"{stage}/earlier")
    verdicts(rows, ids, known.select("event_id", "other")).write.parquet(f"{stage}/decided")
    decided = spark.read.parquet(f"{stage}/decided")
    kept = rows if decided.isEmpty() else without_repeats(rows, decided)
    together(spark, lambda: write_silver(kept, f"{base}/silver", pieces, seen), lambda: put_ids(index, ids, pieces))
    # behind silver: a run that breaks off before it finds the same to do again
    index.publish()
    return changed
