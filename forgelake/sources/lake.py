"""Layout of the lake and replacement of slices.

Bronze is stored by (event_date, event_hour), silver by event_date, facts by event_date and
date_id (see ``snapshot`` for gold). ``event_date`` is always the slice, the day whose files a row came from, and never
the row's own clock: a stray event stamped the day before must not make a run of its slice
replace the day before. Facts add date_id, the day of the event, so that queries prune by it.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from forgelake.functions.events import instant_of
from forgelake.schemas import SILVER_TYPES, ddl


def days_between(first: date, last: date) -> list[date]:
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


def hadoop_path(spark: SparkSession, path: str):
    """A path with the file system that holds it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or any match of a glob, exists."""
    files, folder = hadoop_path(spark, path)
    return bool(files.globStatus(folder))


def folders_in(spark: SparkSession, path: str) -> dict[str, str]:
    """The folders right below a path, by name: one listing; none if the path does not exist."""
    files, folder = hadoop_path(spark, path)
    if not files.exists(folder):
        return {}
    found = [s.getPath() for s in files.listStatus(folder) if s.isDirectory()]
    return {p.getName(): p.toString() for p in found}


def _stored_files(spark: SparkSession, path: str, slices: Iterable[str], depth: int) -> dict[str, set[str]]:
    """Per partition folder of the slices its files: one listing of the table, one per slice."""
    wanted = {piece.split("/")[0]: [] for piece in slices}
    for piece in slices:
        wanted[piece.split("/")[0]].append(piece)
    tops = folders_in(spark, path)
    any_top = "event_date=*" in wanted
    out: dict[str, set[str]] = {}
    for name, top in tops.items():
        pieces = ["event_date=*"] if any_top else wanted.get(name)
        if not pieces:
            continue
        files, folder = hadoop_path(spark, top)
        whole = any("/" not in p for p in pieces)
        below = {p.split("/", 1)[1] for p in pieces if "/" in p}
        listed = files.listFiles(folder, True)
        while listed.hasNext():
            file = listed.next().getPath()
            partition = file.getParent().toString()
            inner = partition.removeprefix(folder.toString()).strip("/")
            if (whole or inner in below) and inner.count("/") + bool(inner) == depth - 1:
                out.setdefault(partition, set()).add(file.toString())
    return out


def replace_slices(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...],
    slices: Iterable[str],
    fmt: str = "parquet",
    sort_by: tuple[str, ...] = (),
    balance: bool = True,
    seen: Observation | None = None,
    **options: str,
) -> None:
    """Make the rows of ``df`` the whole content of ``slices``; other slices stay untouched.

    A slice is a partition path such as ``event_date=2024-01-31``. Dynamic overwrite replaces
    the partitions that receive rows and leaves the others as an earlier run wrote them. Those
    are recognised by an old file that is still there, and removed; a folder that holds nothing
    but files of this run is never touched. A second run with the same
    input gives the same table, also after a run that broke off.

    With ``balance`` rows are shuffled before the write: small groups share a file, a large
    group is cut into several, so neither many tiny files nor one huge task result from uneven
    days or types. Without it every task writes what it read, which is right where the input
    files are of a good size already. ``seen`` observes the number of ``rows`` written.
    """
    spark = df.sparkSession
    slices = list(slices)
    before = _stored_files(spark, path, slices, len(partition_by))
    rows = df
    if balance:
        rows = rows.hint("rebalance", *partition_by)
    if sort_by:
        rows = rows.sortWithinPartitions(*partition_by, *sort_by)
    if seen is not None:
        # on top of the plan: an observation further down is lost where nothing comes out
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.options(**options).partitionBy(*partition_by).format(fmt).save(path)
    after = _stored_files(spark, path, slices, len(partition_by)) if before else {}
    for partition, old in before.items():
        if old & after.get(partition, set()):
            files, folder = hadoop_path(spark, partition)
            files.delete(folder, True)


def no_rows(spark: SparkSession, schema: str) -> DataFrame:
    """An empty table that Spark knows to be empty, unlike one made from a list."""
    return spark.range(0).select(F.from_json(F.lit("{}"), schema).alias("row")).select("row.*")


def day_slices(first: date, last: date) -> list[str]:
    return [f"event_date={day.isoformat()}" for day in days_between(first, last)]


def stored_days(spark: SparkSession, path: str, first: date, last: date) -> list[str]:
    """The slices ``first`` to ``last`` that have a folder."""
    there = folders_in(spark, path)
    return [piece for piece in day_slices(first, last) if piece in there]


def read_slices(
    spark: SparkSession,
    fmt: str,
    schema: str,
    path: str,
    first: date | None,
    last: date | None,
    also: Iterable[date] = (),
    **options: str,
) -> DataFrame:
    """A stored table, or its slices ``first`` to ``last`` and some others; the filter prunes partitions.

    Between two given days only their folders are read, so that a daily job does not walk
    through years of folders to find its own. Days without a folder have no rows.
    """
    reader = spark.read.format(fmt).schema(schema).options(**options).option("basePath", path)
    also = list(also)
    if first is not None and last is not None:
        there = folders_in(spark, path)
        wanted = dict.fromkeys([*day_slices(first, last), *[f"event_date={d}" for d in also]])
        found = [piece for piece in wanted if piece in there]
        if not found:
            return no_rows(spark, schema)
        rows = reader.load([f"{path}/{piece}" for piece in found])
        day = F.col("event_date")
        return rows.filter(day.between(F.lit(first), F.lit(last)) | (day.isin(*also) if also else F.lit(False)))
    rows = reader.load(path)
    if first is not None:
        rows = rows.filter(F.col("event_date") >= F.lit(first))
    if last is not None:
        rows = rows.filter(F.col("event_date") <= F.lit(last))
    return rows


def bytes_of(*frames: DataFrame) -> int:
    """What Spark reckons that the frames read, from the listing that it has made already."""
    return sum(int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) for df in frames)


def dated_folders(
    spark: SparkSession, root: str, first: date, last: date, all_days: bool = False
) -> list[str]:
    """The folders ``root/2024/01/31`` that exist; ``root`` may be a glob."""
    folders = {day: f"{root}/{day:%Y/%m/%d}" for day in days_between(first, last)}
    there = set()
    for month in sorted({f"{day:%Y/%m}" for day in folders}):  # one listing for a month
        files, pattern = hadoop_path(spark, f"{root}/{month}/*")
        there |= {f"{month}/{s.getPath().getName()}" for s in files.globStatus(pattern) or ()}
    found = {day: f for day, f in folders.items() if f"{day:%Y/%m/%d}" in there}
    if not found or all_days and len(found) < len(folders):
        missing = ", ".join(str(d) for d in folders if d not in found)
        raise ValueError(f"nothing in {root} for {missing}")
    return list(found.values())


def folder_day() -> Column:
    """The day that the folders of the row's file name; folders further up may look like one."""
    path, parts = F.col("_metadata.file_path"), r".*/(\d{4})/(\d{2})/(\d{2})/"
    return F.concat_ws("-", *[F.regexp_extract(path, parts, n) for n in (1, 2, 3)]).cast("date")


def read_silver_dated(spark: SparkSession, root: str, first: date, last: date) -> DataFrame:
    """Silver kept as a table per type and day, ``root/PushEvent/2024/01/31``.

    Such tables have the columns of their type alone, and the time as text. Under the given
    schema they read as one sparse table; without it Spark would take the columns of one file.
    """
    stored = {c: t for c, t in SILVER_TYPES.items() if c != "event_date"}
    tables = spark.read.schema(ddl({**stored, "created_at": "STRING"}))
    rows = tables.parquet(*dated_folders(spark, f"{root}/*", first, last))
    rows = rows.select(*stored, folder_day().alias("event_date"))
    return rows.withColumn("created_at", instant_of("created_at")).filter(
        F.col("event_id").isNotNull() & F.col("created_at").isNotNull()
    )


def read_silver(
    spark: SparkSession, path: str, first: date | None = None, last: date | None = None, also: Iterable[date] = ()
) -> DataFrame:
    """The silver table.

    The schema is given, not taken from a file, so days written before a column existed
    read as NULL there.
    """
    return read_slices(spark, "parquet", ddl(SILVER_TYPES), path, first, last, also).select(*SILVER_TYPES)
