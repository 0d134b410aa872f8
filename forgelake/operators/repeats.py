"""Repeated event ids, at any distance in time, found among ids alone.

Every stored slice leaves the list of its ids and a Bloom filter of them. New ids are first put to
the filters of all other slices, and only where one answers to the ids of that slice. A filter is
a table of blocks: a block of 128 bits for about every four ids, in which each id sets eight. A probe
is a join by block number, and of the ids that a slice does not have about one in ten thousand
passes; those the exact comparison sorts out. Blocks are a power of two in number, chosen by the
ids in the slice, so that the share is the same for small and large slices.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.sources.lake import no_rows
from forgelake.sources.snapshot import Run, Snapshot

IDS, FILTERS = "ids", "filters"
IDS_IN_BLOCK = 4
#: Bits that an id sets in either half of its block.
BITS = 4

ID_TYPES = {"event_id": "STRING", "event_date": "DATE"}
FILTER_TYPES = {"level": "INT", "block": "BIGINT", "low": "BIGINT", "high": "BIGINT", "event_date": "DATE"}
ANSWER_DDL = "event_id STRING, event_date DATE, other DATE"


def sightings(rows: DataFrame) -> DataFrame:
    """(event_id, event_date, copies): a row per id and slice, from two narrow columns."""
    return rows.groupBy("event_id", "event_date").agg(F.count(F.lit(1)).alias("copies"))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))


def _block(level: Column) -> Column:
    """The number of an id's block among two to the power of ``level``."""
    return F.pmod(F.xxhash64("event_id"), _bit(level))


def _masks() -> tuple[Column, Column]:
    """The bits that an id sets in the two halves of its block."""
    places = F.xxhash64("event_id", F.lit("bits"))
    bits = [_bit(F.shiftrightunsigned(places, 6 * i).bitwiseAND(63)) for i in range(2 * BITS)]
    low, high = bits[:BITS], bits[BITS:]
    return reduce(Column.bitwiseOR, low), reduce(Column.bitwiseOR, high)


def filters_of(ids: DataFrame) -> DataFrame:
    """The blocks of a filter for each slice of (event_id, event_date)."""
    blocks = F.count(F.lit(1)) / IDS_IN_BLOCK
    sizes = ids.groupBy("event_date").agg(F.ceil(F.log2(F.greatest(blocks, F.lit(1.0)))).cast("int").alias("level"))
    low, high = _masks()
    # a row per slice of the run
    placed = ids.join(F.broadcast(sizes), "event_date").select(
        "event_date", "level", _block(F.col("level")).alias("block"), low.alias("low"), high.alias("high")
    )
    return placed.groupBy("event_date", "level", "block").agg(F.bit_or("low").alias("low"), F.bit_or("high").alias("high"))


def answering(ids: DataFrame, filters: DataFrame, own_day: bool) -> DataFrame:
    """(event_id, event_date, other): the slices whose filters do not deny an id."""
    # filters come in a handful of sizes
    levels = [F.lit(r.level) for r in filters.select("level").distinct().collect()]
    low, high = _masks()
    probes = ids.select("event_id", "event_date", low.alias("p_low"), high.alias("p_high"))
    probes = probes.withColumn("p_level", F.explode(F.array(*levels).cast("array<int>")))
    probes = probes.withColumn("p_block", _block(F.col("p_level")))
    found = probes.join(
        filters.withColumnRenamed("event_date", "other"),
        (F.col("p_level") == F.col("level")) & (F.col("p_block") == F.col("block")),
    )
    return found.filter(
        (F.lit(own_day) | (F.col("other") != F.col("event_date")))
        & (F.col("low").bitwiseAND(F.col("p_low")) == F.col("p_low"))
        & (F.col("high").bitwiseAND(F.col("p_high")) == F.col("p_high"))
    ).select("event_id", "event_date", "other")


def elsewhere(view: Snapshot, ids: DataFrame, pieces: Iterable[str], scratch: str, own_day: bool = False) -> DataFrame:
    """(event_id, event_date, other): ids that the slices in these pieces of the index have too.

    ``scratch`` is a fresh folder for what the filters let through. Only with ``own_day`` does a
    piece of the id's own date count.
    """
    pieces = [p for p in pieces if p in view.parts.get(FILTERS, {})]
    if not pieces:
        return no_rows(view.spark, ANSWER_DDL)
    answering(ids, view.read(FILTERS, FILTER_TYPES, pieces), own_day).write.parquet(scratch)
    let_through = view.spark.read.schema(ANSWER_DDL).parquet(scratch)
    # a day per slice that answers
    days = {f"event_date={r.other}" for r in let_through.select("other").distinct().collect()}
    stored = view.read(IDS, ID_TYPES, [p for p in pieces if p.split("/")[0] in days])
    stored = stored.select(F.col("event_id").alias("s_id"), F.col("event_date").alias("s_date"))
    same = (F.col("event_id") == F.col("s_id")) & (F.col("other") == F.col("s_date"))
    return let_through.join(stored, same, "left_semi")


def put_ids(run: Run, ids: DataFrame, replaces: Iterable[str], suffix: str = "", into: str = "") -> None:
    """Make these ids, a row per id and slice, the index of the slices that are replaced."""
    replaces, names = list(replaces), {"suffix": suffix, "into": into}
    run.put(IDS, ids.select(*ID_TYPES), ("event_date",), replaces, sort_by=("event_id",), **names)
    stored = run.read(IDS, ID_TYPES, run.latest(IDS, into))
    run.put(FILTERS, filters_of(stored), ("event_date",), replaces, sort_by=("level", "block"), **names)


def verdicts(rows: DataFrame, ids: DataFrame, known: DataFrame) -> DataFrame:
    """(event_id, winner) of the ids that need a decision: seen twice in ``rows``, or stored elsewhere.

    ``rows`` has event_id, event_date, event_hour, mark (a hash of the content) and number (unique).
    Of all copies that of the earliest slice wins, then of the earliest hour, then by content;
    ``winner`` is its number, NULL if it is stored elsewhere. ``known`` is (event_id, other).
    """
    twice = ids.groupBy("event_id").agg(F.sum("copies").alias("copies"), F.min("event_date").alias("own"))
    stored = known.groupBy("event_id").agg(F.min("other").alias("k_other")).withColumnRenamed("event_id", "k_id")
    looked = twice.join(stored, F.col("event_id") == F.col("k_id"), "left").filter("copies > 1 OR k_other IS NOT NULL")
    looked = looked.select(F.col("event_id").alias("l_id"), F.when(F.coalesce(F.col("k_other") >= F.col("own"), F.lit(True)), F.col("own")).alias("day"))
    narrow = rows.select("event_id", "event_date", "event_hour", "mark", "number")
    narrow = narrow.join(looked, F.col("event_id") == F.col("l_id"))
    # one number in the order of hour, content and place: a decimal stays in the hash aggregate
    order = F.expr(
        "CASE WHEN event_date = day THEN CAST(coalesce(event_hour, 99) AS DECIMAL(2,0)) * CAST('1e36' AS DECIMAL(38,0))"
        " + CAST(mark AS DECIMAL(16,0)) * CAST('1e20' AS DECIMAL(21,0)) + CAST(number AS DECIMAL(20,0)) END"
    ).cast("decimal(38,0)")
    first = narrow.select(F.col("event_id"), order.alias("place")).groupBy("event_id").agg(F.min("place").alias("place"))
    winner = F.expr("CAST(place % CAST('1e20' AS DECIMAL(21,0)) AS BIGINT)")
    return first.select("event_id", winner.alias("winner"))


def without_repeats(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows that stay: those nobody had to decide on, and the winners."""
    decided = decided.select(F.col("event_id").alias("d_id"), "winner")
    # Spark broadcasts the decisions if they are few; rows do not move then
    joined = rows.join(decided, F.col("event_id") == F.col("d_id"), "left")
    return joined.filter(F.col("d_id").isNull() | (F.col("winner") == F.col("number"))).select(*rows.columns)
