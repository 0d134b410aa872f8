"""Silver to the star schema."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from forgelake.operators import dimensions as dims
from forgelake.operators.facts import fact
from forgelake.schemas import FACTS, VIEW_NAMES
from forgelake.tables import Gold


def transform_to_gold(silver: DataFrame) -> Gold:
    """All seven gold tables as lazy frames."""
    return Gold(
        {
            "dim_date": lambda: dims.dim_date(dims.day_state(silver)),
            "dim_actor": lambda: dims.dim_actor(dims.actor_state(silver)),
            "dim_repo": lambda: dims.dim_repo(dims.repo_state(silver)),
            "dim_org": lambda: dims.dim_org(dims.org_state(silver)),
            **{name: partial(fact, silver, name) for name in FACTS},
        }
    )


def register_views(gold: Gold) -> SparkSession:
    """Make the gold tables available to ``spark.sql`` under their documented names."""
    for name, view in VIEW_NAMES.items():
        gold[name].createOrReplaceTempView(view)
    return gold["dim_date"].sparkSession
