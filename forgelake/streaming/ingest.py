"""Incremental silver: every run takes the bronze files that arrived since the last one.

The streamed table is a store of snapshots. A batch writes its rows, their ids and what they add to
the marts into folders of its own and publishes all of it with its number as one version, so that
each batch counts exactly once: one that is replayed after it was published finds its number there,
and one that broke off before has left nothing that a reader sees.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from forgelake.operators.repeats import (
    FILTERS,
    ID_TYPES,
    IDS,
    elsewhere,
    put_ids,
    sightings,
    verdicts,
    without_repeats,
)
from forgelake.operators.silver import flatten
from forgelake.plans.gold import transform_to_gold
from forgelake.plans.marts import MART_TYPES, STORED
from forgelake.plans.silver import numbered
from forgelake.schemas import BRONZE_DDL, SILVER_TYPES
from forgelake.session import prepare, together
from forgelake.sources.lake import hadoop_path
from forgelake.sources.snapshot import Run, snapshot

# The file source forgets files older than this and would skip them. Landing is by day and hour,
# and a day may be caught up on years later, so nothing is old.
FILES_ARE_NEVER_OLD = "100000d"

SILVER = "silver"
#: A slice that lies in more pieces than this is merged to one.
MOST_PIECES = 8
#: Versions kept for readers: a batch makes one.
KEPT_VERSIONS = 24
#: The marts that batches add to.
ADDITIVE = ("mart_repo_daily_stats", "mart_developer_activity")


def bronze_stream(spark: SparkSession, bronze: str, files_per_batch: int = 1000) -> DataFrame:
    """Raw events as a stream of files. Files per batch bound the work after a long pause."""
    reader = spark.readStream.schema(f"{BRONZE_DDL}, event_date DATE, event_hour INT")
    reader = reader.option("mode", "PERMISSIVE").option("maxFilesPerTrigger", files_per_batch)
    reader = reader.option("maxFileAge", FILES_ARE_NEVER_OLD)
    return reader.option("columnNameOfCorruptRecord", "_corrupt_record").json(bronze)


def add_to_marts(run: Run, rows: DataFrame) -> None:
    """Add what new silver rows give to the days and months of the marts that they touch."""
    gold = transform_to_gold(rows)
    for name in ADDITIVE:
        how, columns = STORED[name], MART_TYPES[name]
        stage = run.folder(f"{name}_stage")
        how.share(gold).withColumn(how.piece, F.expr(how.piece_of)).write.parquet(stage)
        share = run.spark.read.parquet(stage)
        # a number per day or month
        pieces = [f"{how.piece}={r[0]}" for r in share.select(how.piece).distinct().collect()]
        types = {**columns, how.piece: "BIGINT"}
        if name in run.parts:
            share = run.read(name, types, pieces).union(share.select(*types))
        run.put(name, how.settle(share, how.piece), (how.piece,), pieces)


def merge_pieces(run: Run, most: int = MOST_PIECES) -> list[str]:
    """Merge the slices that lie in more than ``most`` pieces, with their ids; the slices merged."""
    lying = defaultdict(list)
    for piece in run.parts.get(SILVER, {}):
        lying[piece.split("/")[0]].append(piece)
    crowded = {day: pieces for day, pieces in lying.items() if len(pieces) > most}
    if crowded:
        pieces = [p for found in crowded.values() for p in found]
        suffix = f"/merged-{run.version}"
        rows = run.read(SILVER, SILVER_TYPES, pieces)
        known = [p for p in pieces if p in run.parts.get(IDS, {})]
        ids = run.read(IDS, ID_TYPES, known).distinct() if known else None
        run.put(SILVER, rows, ("event_date",), pieces, sort_by=("event_type",), suffix=suffix, into="merged")
        if ids is not None:
            run.drop(FILTERS, known)
            put_ids(run, ids, known, suffix, into="merged")
    return sorted(crowded)


def _append_batch(root: str, dedupe: bool, with_marts: bool):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # the query keeps this name as long as it keeps its checkpoint
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        run = Run(spark, root)
        if run.marks.get(query, -1) >= batch_id:
            return
        stage = f"{root}/_staging/{uuid.uuid4().hex}"
        try:
            # the JSON is parsed here and nowhere else
            numbered(batch).write.parquet(f"{stage}/rows")
            rows = spark.read.parquet(f"{stage}/rows")
            suffix = f"/{run.version}"

            def put_rows(rows: DataFrame) -> None:
                run.put(SILVER, rows.select(*SILVER_TYPES), ("event_date",), (), sort_by=("event_type",), suffix=suffix)

            if dedupe:
                sightings(rows).write.parquet(f"{stage}/ids")
                ids, stored = spark.read.parquet(f"{stage}/ids"), list(run.parts.get(IDS, {}))

                def put_decided() -> None:
                    known = elsewhere(run, ids.select(*ID_TYPES), stored, f"{stage}/known", own_day=True)
                    # what is stored goes before what arrives, whatever its day
                    known = known.select("event_id", F.lit("0001-01-01").cast("date").alias("other"))
                    verdicts(rows, ids, known).write.parquet(f"{stage}/decided")
                    put_rows(without_repeats(rows, spark.read.parquet(f"{stage}/decided")))

                # the index of the batch hangs on no decision, and these look only in what was stored before
                together(spark, put_decided, lambda: put_ids(run, ids, (), suffix))
            else:
                put_rows(rows)
            if with_marts:
                add_to_marts(run, run.read(SILVER, SILVER_TYPES, run.latest(SILVER)))
            merge_pieces(run)
            run.marks[query] = batch_id
            run.publish(KEPT_VERSIONS)
        finally:
            files, folder = hadoop_path(spark, stage)
            files.delete(folder, True)

    return write


def stream_to_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    checkpoint: str,
    dedupe: bool = False,
    files_per_batch: int = 1000,
    with_marts: bool = False,
) -> StreamingQuery:
    """Start a query that takes all files there are and then ends; run it again to catch up.

    Nothing is dropped for being late: flattening needs no state, and ``dedupe`` looks for an
    event's id in the batch itself and in all that earlier batches have stored, not in a window of
    event time. The copy that arrives first stays. Slices may arrive in any order. ``with_marts``
    adds each batch to the daily repository and the monthly developer mart.
    """
    events = bronze_stream(prepare(spark), bronze, files_per_batch)
    rows = flatten(events, F.col("event_date"), "event_hour")
    writer = rows.writeStream.foreachBatch(_append_batch(silver, dedupe, with_marts))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def compact(spark: SparkSession, silver: str, most: int = 1) -> list[str]:
    """Merge the slices of a streamed table that lie in more than ``most`` pieces; not beside a running stream."""
    run = Run(prepare(spark), silver)
    merged = merge_pieces(run, most)
    if merged:
        run.publish(KEPT_VERSIONS)
    return merged


def read_streamed_silver(
    spark: SparkSession, silver: str, first: date | None = None, last: date | None = None, also: Iterable[date] = ()
) -> DataFrame:
    view = snapshot(spark, silver)
    low, high = f"event_date={first or date.min}", f"event_date={last or date.max}"
    more = {f"event_date={d}" for d in also}
    pieces = [p for p in view.pieces(SILVER) if low <= (day := p.split("/")[0]) <= high or day in more]
    return view.read(SILVER, SILVER_TYPES, pieces)


def read_streamed_marts(spark: SparkSession, silver: str) -> dict[str, DataFrame]:
    view = snapshot(spark, silver)
    return {name: view.read(name, MART_TYPES[name]) for name in ADDITIVE}
