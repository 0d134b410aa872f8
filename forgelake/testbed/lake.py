"""Lakes filled from the driver's ``events``, each in a fresh shared folder."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.operators.silver import flatten, of_type
from forgelake.schemas import TYPE_PATHS
from forgelake.session import shared_folder
from forgelake.sources.lake import folders_in, hadoop_path, replace_slices
from forgelake.testbed.adapter import raw_events, raw_lines


def span(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """First and last day of the events."""
    day = F.to_date("ts")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    row = events.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
    return row["first"], row["last"]


def write_bronze(lines: DataFrame, bronze: str) -> None:
    """JSON lines with their slice, stored as landed files would be."""
    rows = lines.select("value", "event_date", "event_hour")
    replace_slices(rows, bronze, ("event_date", "event_hour"), [], fmt="text")


def bronze_lake(spark: SparkSession, sf_dir: str) -> str:
    base = shared_folder(spark, "lake")
    write_bronze(raw_lines(spark, sf_dir), f"{base}/bronze")
    return base


def awaited_lake(spark: SparkSession, sf_dir: str) -> str:
    """Bronze with an hour of every day fetched twice, none of it arrived: it lies in ``base/awaited``."""
    base = shared_folder(spark, "lake")
    write_bronze(refetched_lines(spark, sf_dir), f"{base}/awaited")
    return base


def arrive(spark: SparkSession, base: str, days: Iterable[date]) -> None:
    """Move the files of some days from ``base/awaited`` to ``base/bronze``; a day may have none."""
    files, bronze = hadoop_path(spark, f"{base}/bronze")
    files.mkdirs(bronze)
    awaited = folders_in(spark, f"{base}/awaited")
    for piece in [f"event_date={day}" for day in days]:
        if piece in awaited and not files.rename(hadoop_path(spark, awaited[piece])[1], hadoop_path(spark, f"{base}/bronze/{piece}")[1]):
            raise RuntimeError(f"{piece} can't be moved to {base}/bronze")


def landing_lake(spark: SparkSession, sf_dir: str) -> str:
    """Gzipped hourly dumps under their usual names in ``base/landing``."""
    base = shared_folder(spark, "lake")
    staged = f"{base}/staged"
    lines = raw_lines(spark, sf_dir).withColumn(
        "dump", F.concat_ws("-", F.col("event_date").cast("string"), F.col("event_hour").cast("string"))
    )
    rows = lines.select("value", "dump")
    replace_slices(rows, staged, ("dump",), [], fmt="text", compression="gzip")
    files, folder = hadoop_path(spark, f"{staged}/dump=*")
    landing = hadoop_path(spark, f"{base}/landing")[1]
    files.mkdirs(landing)
    for status in files.globStatus(folder):
        name = status.getPath().getName().removeprefix("dump=")
        files.rename(status.getPath(), hadoop_path(spark, f"{base}/landing/{name}.json.gz")[1])
    return base


def clean_landing(spark: SparkSession, base: str, keep_hours: tuple[int, ...]) -> None:
    """Remove the dumps of all other hours, as retention would."""
    files, landing = hadoop_path(spark, f"{base}/landing")
    for status in files.listStatus(landing):
        name = status.getPath().getName()
        if int(name.removesuffix(".json.gz").rsplit("-", 1)[1]) not in keep_hours:
            files.delete(status.getPath(), True)


def age_files(spark: SparkSession, bronze: str, day: date, days: int) -> None:
    """Set back the modification times of a day's files."""
    files, folder = hadoop_path(spark, f"{bronze}/event_date={day}")
    listed = files.listFiles(folder, True)
    while listed.hasNext():
        status = listed.next()
        files.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


def dated_lake(spark: SparkSession, sf_dir: str) -> str:
    """Bronze in the plain layout ``2024/01/31/05.json``."""
    base = shared_folder(spark, "lake")
    staged = f"{base}/staged"
    day, hour = F.date_format("event_date", "yyyy/MM/dd"), F.format_string("%02d", "event_hour")
    rows = raw_lines(spark, sf_dir).select("value", F.concat_ws("/", day, hour).alias("place"))
    # a partition value may not hold the slashes: they become folders when it is moved
    rows = rows.withColumn("place", F.translate("place", "/", "-"))
    rows.repartition("place").write.partitionBy("place").text(staged)
    for name, path in folders_in(spark, staged).items():
        y, m, d, h = name.removeprefix("place=").split("-")
        files, target = hadoop_path(spark, f"{base}/bronze/{y}/{m}/{d}/{h}.json")
        files.mkdirs(target.getParent())
        files.rename(files.listFiles(hadoop_path(spark, path)[1], False).next().getPath(), target)
    return base


def type_tables(spark: SparkSession, sf_dir: str) -> str:
    """Silver as a table per type and day, ``root/PushEvent/2024/01/31``, the time as text."""
    root = shared_folder(spark, "lake")
    staged = f"{root}/staged"
    silver = flatten(raw_events(spark, sf_dir))
    text = F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    for kind in TYPE_PATHS:
        rows = of_type(silver, kind).withColumn("day", F.date_format("created_at", "yyyy-MM-dd"))
        rows = rows.withColumn("created_at", text)
        rows.write.partitionBy("day").parquet(f"{staged}/{kind}")
        for name, path in folders_in(spark, f"{staged}/{kind}").items():
            y, m, d = name.removeprefix("day=").split("-")
            files, target = hadoop_path(spark, f"{root}/tables/{kind}/{y}/{m}/{d}")
            files.mkdirs(target.getParent())
            files.rename(hadoop_path(spark, path)[1], target)
    return f"{root}/tables"


def spoiled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which some are damaged, by event type, in the ways real dumps are.

    Delete events are cut off, fork events carry text as actor id, wiki events lack the type,
    and create events have a time that is none.
    """
    lines = raw_lines(spark, sf_dir)
    value = F.col("value")
    kind = F.get_json_object(value, "$.type")
    spoiled = (
        F.when(kind == "DeleteEvent", F.substring(value, 1, 40))
        .when(kind == "ForkEvent", F.regexp_replace(value, r'"actor":\{"id":\d+', '"actor":{"id":"x"'))
        .when(kind == "GollumEvent", F.regexp_replace(value, r'"type":"GollumEvent",', ""))
        .when(kind == "CreateEvent", F.regexp_replace(value, r'"created_at":"[^"]*"', '"created_at":"soon"'))
        .otherwise(value)
    )
    return lines.withColumn("value", spoiled)


def refetched_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines, and once more those of every day's hour 5, as if it was fetched twice."""
    once, twice = F.array(F.lit(1)), F.array(F.lit(1), F.lit(2))
    # one pass over the events, which makes the text of a line once
    fetched = F.explode(F.when(F.col("event_hour") == 5, twice).otherwise(once)).alias("fetched")
    return raw_lines(spark, sf_dir).select("*", fetched).drop("fetched")


def refetched_far_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines, and those of every odd hour once more two days and 400 days later."""
    lines = raw_lines(spark, sf_dir)
    odd = lines.filter(F.col("event_hour") % 2 == 1)
    return lines.unionAll(odd.withColumn("event_date", F.date_add("event_date", 2))).unionAll(
        odd.withColumn("event_date", F.date_add("event_date", 400))
    )


def forget_last_commit(spark: SparkSession, checkpoint: str) -> None:
    """Make a stream run its last batch once more, as after a failure."""
    files, folder = hadoop_path(spark, f"{checkpoint}/commits")
    batches = [s.getPath().getName() for s in files.listStatus(folder)]
    last = max((int(n) for n in batches if n.isdigit()))
    files.delete(hadoop_path(spark, f"{checkpoint}/commits/{last}")[1], False)
