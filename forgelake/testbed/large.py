"""The driver's events many times over, with one developer holding a third of them."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from forgelake.session import shared_folder


def enlarged(spark: SparkSession, sf_dir: str, times: int) -> str:
    """A folder with an ``events`` table of ``times`` as many rows.

    Ids of a copy follow those of the one before, at a distance that keeps the event types, so
    that repositories and issues grow in number too. Other developers are new in every copy.
    """
    folder = shared_folder(spark, "large")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    top = events.agg(F.max("event_id")).first()[0]
    step = (top // 20 + 1) * 20
    copies = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    copies = copies.withColumn("event_id", F.col("event_id") + F.col("copy") * step)
    heavy = F.col("event_id") % 3 == 0
    user = F.when(heavy, F.lit(1)).otherwise(F.col("user_id") + F.col("copy") * 100_000)
    rows = copies.withColumn("user_id", user.cast("bigint")).drop("copy")
    rows.repartition(32).write.parquet(f"{folder}/events.parquet")
    return folder
