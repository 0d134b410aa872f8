"""Tables in files: parquet, CSV and JSON lines."""

from __future__ import annotations

import logging
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

FORMATS = ("parquet", "csv", "json")
# Quotes inside a CSV field are doubled, as other tools write and expect them.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}


def _check_format(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}: use one of {', '.join(FORMATS)}")


def read_table(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    **options: Any,
) -> DataFrame:
    """Read a table. Text formats without ``schema`` cost one more pass to infer it."""
    _check_format(fmt)
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        if fmt == "parquet":
            return reader.parquet(*([path] if isinstance(path, str) else path))
        if fmt == "csv":
            infer = {} if schema is not None else {"inferSchema": "true"}
            return reader.options(**{**CSV_OPTIONS, **infer, **options}).csv(path)
        return reader.json(path)
    except Exception:
        log.exception("cannot read %s as %s", path, fmt)
        raise


def _flat_text(df: DataFrame) -> DataFrame:
    """CSV has no nesting: structs, arrays and maps become JSON text."""
    return df.select(
        *[
            F.to_json(f.name).alias(f.name)
            if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "json",
    partition_by: tuple[str, ...] = (),
    **options: Any,
) -> None:
    """Replace the table at ``path``. JSON keeps NULL fields, so every record has all columns."""
    try:
        _check_format(fmt)
        rows = _flat_text(df) if fmt == "csv" else df
        writer = rows.write.mode("overwrite").options(**options).partitionBy(*partition_by)
        if fmt == "parquet":
            writer.parquet(path)
        elif fmt == "csv":
            writer.options(**{**CSV_OPTIONS, **options}).csv(path)
        else:
            writer.options(**{"ignoreNullFields": "false", "encoding": "UTF-8", **options}).json(path)
    except Exception as error:
        raise ValueError(f"cannot write {path} as {fmt}: {error}") from error


def counted(df: DataFrame, label: str) -> tuple[DataFrame, Observation]:
    """Count the rows on their way through the next action: no second job.

    After the action, ``observation.get["rows"]`` holds the number.
    """
    observation = Observation(label)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
