"""What the operators share: intermediate tables, documents by name, Arrow helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows without an id are numbered from here, by a hash of their text.
NO_ID_FROM = 1 << 62

_LOCAL: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor reaches, below ``spark.checkpoint.dir``.

    A session without that setting gets a temporary folder, which only a single machine can use.
    """
    root = spark.conf.get("spark.checkpoint.dir", "")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _LOCAL.setdefault("root", tempfile.mkdtemp(prefix="forgelake-llm-"))
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written as a table in the shared folder and read again.

    It cuts the lineage, so that a lost executor costs no more than the tasks that it ran, and
    gives the planner the true size, by which Spark decides whether a broadcast is safe.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that :func:`scratch` named."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def document_number(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The id, or a number from the text that is larger than ids are."""
    last = F.xxhash64(text).bitwiseAND(F.lit(NO_ID_FROM - 1)) + F.lit(NO_ID_FROM)
    return F.coalesce(F.col(doc_id).cast("long"), last)


def binary_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a binary or string column, without copying."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def slices(column: pa.Array, most_bytes: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows of about that many bytes; a longer row stands alone."""
    if not len(column):
        return
    offsets, _ = binary_parts(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + most_bytes, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last
        first = last
