"""The four shared dimensions, one row per natural key.

Actors, repositories and organisations change their names. Each dimension is therefore
built in two steps. The first keeps one row per (key, value) with when it was seen; a
hash aggregate that shrinks the events to about the number of keys before the shuffle,
however often one key occurs. The second picks the newest value per key out of those few
rows. The first step is also the state that the daily job stores per day: minimum and
maximum merge, so a dimension over the stored days equals one over all events, and the days up
to a month's start can be kept merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.functions.calendar import calendar_columns, utc_day
from forgelake.functions.events import actor_type, recency

STATE_TYPES = {
    "state_day": {"date_actual": "DATE"},
    "state_actor": {
        "actor_id": "BIGINT",
        "actor_login": "STRING",
        "first_seen_at": "TIMESTAMP",
        "last_seen": "DECIMAL(38,0)",
    },
    "state_repo": {
        "repo_id": "BIGINT",
        "repo_name": "STRING",
        "org_id": "BIGINT",
        "last_seen": "DECIMAL(38,0)",
    },
    "state_org": {"org_id": "BIGINT", "org_login": "STRING", "last_seen": "DECIMAL(38,0)"},
}


def actor_state(silver: DataFrame, *by: str) -> DataFrame:
    return silver.groupBy(*by, "actor_id", "actor_login").agg(
        F.min("created_at").alias("first_seen_at"), F.max(recency()).alias("last_seen")
    )


def repo_state(silver: DataFrame, *by: str) -> DataFrame:
    return silver.groupBy(*by, "repo_id", "repo_name", "org_id").agg(
        F.max(recency()).alias("last_seen")
    )


def org_state(silver: DataFrame, *by: str) -> DataFrame:
    rows = silver.filter(F.col("org_id").isNotNull())
    return rows.groupBy(*by, "org_id", "org_login").agg(F.max(recency()).alias("last_seen"))


def day_state(silver: DataFrame, *by: str) -> DataFrame:
    return silver.select(*by, utc_day(F.col("created_at")).alias("date_actual")).distinct()


def issue_moments(events: DataFrame, *by: str) -> DataFrame:
    """A row per issue event: when it opened or closed the issue, NULL where it did neither."""
    rows = events.filter((F.col("event_type") == "IssuesEvent") & F.col("issue_id").isNotNull())
    at = [
        F.when(F.col("issue_action") == action, F.col("created_at")).alias(name)
        for action, name in (("closed", "closed_at"), ("opened", "opened_at"))
    ]
    return rows.select(*by, "issue_id", *at)


def merged(name: str, state: DataFrame) -> DataFrame:
    """Rows of one state table brought together: minima and maxima merge."""
    known = {
        "first_seen_at": F.min("first_seen_at"), "last_seen": F.max("last_seen")
    }
    columns = STATE_TYPES[name]
    keys = [c for c in columns if c not in known]
    rows = state.select(*columns)
    if len(keys) == len(columns):
        return rows.distinct()
    return rows.groupBy(*keys).agg(*[known[c].alias(c) for c in columns if c in known]).select(*columns)


def latest(value: str) -> Column:
    """The newest value that is not NULL."""
    return F.max_by(value, F.when(F.col(value).isNotNull(), F.col("last_seen")))


def dim_date(state: DataFrame) -> DataFrame:
    """Distinct first, derive after: the calendar columns are computed once per day."""
    day = F.col("date_actual")
    return state.select(day).filter(day.isNotNull()).distinct().select(*calendar_columns(day))


def dim_actor(state: DataFrame) -> DataFrame:
    return (
        state.filter(F.col("actor_id").isNotNull())
        .groupBy("actor_id")
        .agg(
            latest("actor_login").alias("actor_login"),
            F.min("first_seen_at").alias("first_seen_at"),
        )
        .select(
            "actor_id",
            "actor_login",
            actor_type(F.col("actor_login")).alias("actor_type"),
            "first_seen_at",
        )
    )


def dim_repo(state: DataFrame) -> DataFrame:
    return (
        state.filter(F.col("repo_id").isNotNull())
        .groupBy("repo_id")
        # Name and owner come from one event: after a transfer to a person there is no owner.
        .agg(
            F.max_by(F.struct("repo_name", "org_id"), F.when(F.col("repo_name").isNotNull(), F.col("last_seen")))
            .alias("newest")
        )
        .select("repo_id", "newest.repo_name", "newest.org_id", F.lit(None).cast("string").alias("primary_language"))
    )


def with_languages(repos: DataFrame, languages: DataFrame) -> DataFrame:
    """Fill ``primary_language`` from a table (repo_id, primary_language), unique by repo."""
    return repos.drop("primary_language").join(
        languages.select("repo_id", "primary_language"), "repo_id", "left"
    )


def dim_org(state: DataFrame) -> DataFrame:
    return (
        state.filter(F.col("org_id").isNotNull())
        .groupBy("org_id")
        .agg(latest("org_login").alias("org_name"))
        # Events name an organisation only where the owner is one.
        .withColumn("org_type", F.lit("Organization"))
    )
