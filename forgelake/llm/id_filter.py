"""A filter of ids of one fixed size, to keep rows that nobody asks for from moving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.llm.common import stored

#: Bits of the filter, 2 MB of them; each id sets one.
FILTER_BITS = 1 << 24
#: Fixed value: bits of a bitmap of Spark's bitmap functions.
BITMAP_BITS = 1 << 15


def _place(column: str) -> Column:
    return F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(FILTER_BITS))


def id_filter(ids: DataFrame, column: str) -> DataFrame:
    """The bitmaps of these ids: at most FILTER_BITS / BITMAP_BITS rows of 4 KB, however many ids there are."""
    place = _place(column)
    rows = ids.select(
        F.call_function("div", place, F.lit(BITMAP_BITS)).alias("f_part"), F.pmod(place, F.lit(BITMAP_BITS)).alias("at")
    )
    return stored(rows.groupBy("f_part").agg(F.bitmap_construct_agg("at").alias("f_bits")), "id_filter")


def may_hold(rows: DataFrame, found: DataFrame, column: str) -> DataFrame:
    """The rows whose id may be in the filter: all that are, and of the others as many as bits are set."""
    place = _place(column)
    at = F.pmod(place, F.lit(BITMAP_BITS))
    byte = F.substring("f_bits", F.call_function("div", at, F.lit(8)).cast("int") + 1, F.lit(1))
    held = F.expr("shiftright(cast(conv(hex(f_byte), 16, 10) as int), f_bit) & 1 = 1")
    # 2 MB at most
    joined = rows.join(F.broadcast(found), F.call_function("div", place, F.lit(BITMAP_BITS)) == F.col("f_part"))
    joined = joined.select(*rows.columns, byte.alias("f_byte"), F.pmod(at, F.lit(8)).cast("int").alias("f_bit"))
    return joined.filter(held).select(*rows.columns)
