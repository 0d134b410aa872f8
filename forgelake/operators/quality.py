"""Checks of what the model promises and Spark does not enforce."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.schemas import FACTS, TYPE_PATHS

# Foreign keys of the facts: column -> dimension.
FOREIGN_KEYS = {
    "date_id": "dim_date",
    "actor_id": "dim_actor",
    "repo_id": "dim_repo",
    "org_id": "dim_org",
}


def duplicate_events(silver: DataFrame) -> DataFrame:
    """Event ids that occur more than once."""
    return (
        silver.groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def orphan_keys(gold: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows whose key is set but missing in its dimension, per fact and key.

    The fact is counted per key first, so a frequent key crosses the network once.
    """
    checks = []
    for name, spec in FACTS.items():
        for key, dimension in FOREIGN_KEYS.items():
            if key not in spec["columns"]:
                continue
            keys = gold[name].filter(F.col(key).isNotNull()).groupBy(key).agg(
                F.count(F.lit(1)).alias("rows")
            )
            orphans = keys.join(gold[dimension].select(key), key, "left_anti")
            checks.append(
                orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows")).select(
                    F.lit(name).alias("fact"), F.lit(key).alias("key"), "orphan_rows"
                )
            )
    return reduce(DataFrame.unionAll, checks)


def sparse_profile(silver: DataFrame) -> DataFrame:
    """How many rows of each event type fill each type-specific column.

    A column filled off its own type breaks the sparse layout; one empty on its own type
    shows a field that the source has stopped sending.
    """
    columns = [name for fields in TYPE_PATHS.values() for name in fields]
    return silver.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), *[F.count(c).alias(c) for c in columns]
    )
