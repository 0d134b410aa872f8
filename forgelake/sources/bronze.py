"""Raw events: landing hourly dumps, reading bronze, setting bad lines aside."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from forgelake.functions.events import event_time
from forgelake.schemas import BRONZE_DDL
from forgelake.session import settings
from forgelake.sources.lake import (
    dated_folders,
    folder_day,
    hadoop_path,
    read_slices,
    replace_slices,
)

SLICES_DDL = "event_date DATE, event_hour INT"
# Fixed value: an hourly dump is named by day and hour, the hour without a leading zero.
DUMP_NAME = r"(\d{4}-\d{2}-\d{2})-(\d{1,2})\.json"
# How lines that do not parse are read: as rows of NULLs with the text.
CORRUPT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def read_events(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON-lines events under the fixed schema; plain or gzipped files.

    A line that does not parse becomes a row of NULLs with the text in ``_corrupt_record``,
    instead of failing the file.
    """
    return spark.read.schema(BRONZE_DDL).options(**CORRUPT).json(path)


def find_dumps(
    spark: SparkSession, landing: str, first: date, last: date, hour: int | None = None
) -> dict[tuple[date, int], str]:
    """The landed dumps of some days, or of one hour of each, by day and hour: one listing."""
    files, folder = hadoop_path(spark, landing)
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    found = {}
    for name in names:
        parts = re.fullmatch(DUMP_NAME + r"\.gz", name)
        if parts is None:
            continue
        day, at = date.fromisoformat(parts[1]), int(parts[2])
        if first <= day <= last and hour in (None, at):
            found[day, at] = f"{landing}/{name}"
    if not found:
        raise ValueError(f"no hourly dumps in {landing} for {first} to {last}, hour {hour}")
    return found


def _with_slice(df: DataFrame) -> DataFrame:
    name, dump = F.col("_metadata.file_path"), ".*" + DUMP_NAME
    return df.select(
        *df.columns,
        F.regexp_extract(name, dump, 1).cast("date").alias("event_date"),
        F.regexp_extract(name, dump, 2).cast("int").alias("event_hour"),
    )


def read_dumps(
    spark: SparkSession, landing: str, first: date, last: date, hour: int | None = None
) -> DataFrame:
    """Events straight from landed hourly dumps, with the slice taken from the file name.

    A gzip file is one task, so a day gives up to 24 and a range reads all its hours at once.
    A dump may also be a folder of gzip parts under the same name.
    """
    dumps = find_dumps(spark, landing, first, last, hour)
    return _with_slice(read_events(spark, list(dumps.values())))


def land_dumps(
    spark: SparkSession,
    landing: str,
    bronze: str,
    first: date,
    last: date | None = None,
    hour: int | None = None,
    **options: str,
) -> int:
    """Store landed dumps in bronze by day and hour, replacing the hours found; the lines stored.

    An hour that has no dump, as when landing was cleaned up, stays as it is in bronze.

    Lines are kept as they are: bronze holds every field and every malformed line. There is no
    shuffle; a task reads a dump and writes the file of its hour. The plain text can be split
    again when it is read, which the gzipped dump could not.
    """
    dumps = find_dumps(spark, landing, first, last or first, hour)
    seen = Observation("landed")
    # A task may keep several files open, or it would have to sort its lines by hour first.
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": "24"}):
        replace_slices(
            _with_slice(spark.read.text(list(dumps.values()))),
            bronze,
            ("event_date", "event_hour"),
            [f"event_date={day.isoformat()}/event_hour={h}" for day, h in dumps],
            fmt="text",
            balance=False,
            seen=seen,
            **options,
        )
    return seen.get["rows"]


def read_bronze(
    spark: SparkSession, bronze: str, first: date | None = None, last: date | None = None, also: Iterable[date] = ()
) -> DataFrame:
    """Stored bronze events, or those of some days."""
    schema = f"{BRONZE_DDL}, {SLICES_DDL}"
    return read_slices(spark, "json", schema, bronze, first, last, also, **CORRUPT)


def read_bronze_dated(
    spark: SparkSession, bronze: str, first: date, last: date, also: Iterable[date] = ()
) -> DataFrame:
    """Bronze events in the plain layout ``bronze/2024/01/31/05.json``, hours padded."""
    folders = dated_folders(spark, bronze, first, last, all_days=True)
    folders += [f"{bronze}/{d:%Y/%m/%d}" for d in also]
    events = read_events(spark, folders)
    hour = F.regexp_extract(F.col("_metadata.file_path"), r".*/(\d{2})\.json", 1).cast("int")
    return events.select(
        *events.columns, folder_day().alias("event_date"), hour.alias("event_hour")
    )


def bad_line() -> tuple[Column, list[Column]]:
    """Whether a line did not decode whole or cannot be placed by silver, and what to keep of it.

    ``kept`` tells whether silver still has the row, with the unreadable field NULL.
    ``decoded`` shows what could be read.
    """
    decoded = F.to_json(F.struct("actor", "repo", "org", "payload"))
    usable = F.col("id").isNotNull() & F.col("type").isNotNull() & event_time().isNotNull()
    # The reader skips fields that nobody asks for and then never finds them unreadable.
    # Naming the decoded fields here keeps all of them in the scan, whatever is selected later.
    corrupt = F.col("_corrupt_record").isNotNull() & decoded.isNotNull()
    reason = (
        F.when(corrupt & usable, "unreadable field")
        .when(corrupt, "unreadable line")
        .when(F.col("id").isNull() | F.col("type").isNull(), "missing id or type")
        .otherwise("unreadable time")
    )
    return corrupt | ~usable, [
        F.col("id").alias("event_id"),
        F.col("type").alias("event_type"),
        F.col("created_at").alias("created_at"),
        reason.alias("reason"),
        usable.alias("kept"),
        decoded.alias("decoded"),
        F.col("_corrupt_record").alias("line"),
    ]


def quarantine(events: DataFrame, *extra: str) -> DataFrame:
    """The bad lines of some events."""
    bad, columns = bad_line()
    return events.filter(bad).select(*columns, *extra)
