"""The driver's ``events`` table mapped to raw forge events by integer arithmetic.

Only event_id, ts and user_id are read. With e = event_id, slot = e % 20, g = e div 20 the
slot decides the event type, and the other fields follow from e, g and the user, so that the
same facts can be worked out from ``events`` in plain SQL. Repositories and organisations grow
in number with the events; early events carry former names of some developers, repositories and
organisations, and some repositories later move from an organisation to a person.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TYPE_OF_SLOT = (
    ["PushEvent"] * 5
    + ["PullRequestEvent"] * 2
    + ["IssuesEvent"] * 3
    + ["IssueCommentEvent"] * 3
    + ["WatchEvent"] * 2
    + ["ForkEvent", "CreateEvent", "CreateEvent", "DeleteEvent", "GollumEvent"]
)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the shape of the raw JSON records, the time already a timestamp."""
    types = ", ".join(f"'{t}'" for t in TYPE_OF_SLOT)
    base = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id AS e",
        "user_id AS u",
        "date_trunc('SECOND', CAST(ts AS TIMESTAMP)) AS created_at",
        "CAST(event_id % 20 AS INT) AS slot",
        "event_id DIV 20 AS g",
    )
    placed = base.selectExpr(
        "*",
        f"element_at(array({types}), slot + 1) AS type",
        """CASE WHEN slot < 5 THEN g * 5 + slot
                WHEN slot IN (8, 11, 18) THEN g DIV 2
                WHEN slot IN (9, 12) THEN g DIV 3
                WHEN slot IN (13, 14) THEN u
                WHEN slot = 15 THEN u * 3
                ELSE g END AS x""",
        """concat('dev-', u, CASE WHEN u % 7 = 0 AND g < 25 THEN '-old' ELSE '' END,
                  CASE WHEN u % 10 = 0 THEN '[bot]' ELSE '' END) AS login""",
    ).selectExpr("*", "1000 + x % 37 + 37 * (x DIV 200) AS repo_id").selectExpr(
        "*", "100 + repo_id % 5 + 5 * (repo_id DIV 200) AS owner"
    )
    action = """CASE WHEN slot IN (5, 7) THEN 'opened' WHEN slot IN (6, 8) THEN 'closed'
                     WHEN slot = 9 THEN 'reopened' WHEN slot IN (10, 11, 12) THEN 'created'
                     WHEN slot IN (13, 14) THEN 'started' END"""
    ref = """CASE WHEN slot = 0 THEN concat('refs/heads/feature-', g)
                  WHEN slot < 5 THEN 'refs/heads/main'
                  WHEN slot = 16 THEN concat('feature-', g)
                  WHEN slot = 17 AND g % 3 = 1 THEN concat('v', g)
                  WHEN slot = 17 AND g % 3 = 2 THEN concat('keep-', g)
                  WHEN slot = 18 THEN concat('feature-', x) END"""
    ref_type = """CASE WHEN slot IN (16, 18) THEN 'branch'
                       WHEN slot = 17 THEN element_at(array('repository', 'tag', 'branch'),
                                                      CAST(g % 3 AS INT) + 1) END"""
    merged = """CASE WHEN slot = 5 THEN false
                     WHEN slot = 6 AND g % 11 <> 0 THEN g % 3 <> 0 END"""
    return placed.selectExpr(
        "CAST(e AS STRING) AS id",
        "type",
        "created_at",
        "struct(u AS id, login AS login) AS actor",
        """struct(repo_id AS id,
                  concat('owner-', repo_id % 5, '/repo-', repo_id,
                         CASE WHEN repo_id % 9 = 0 AND g < 25 THEN '-old' ELSE '' END) AS name
           ) AS repo""",
        """CASE WHEN repo_id % 4 <> 0 AND NOT (repo_id % 11 = 0 AND g >= 25) THEN
             struct(owner AS id, concat('org-', owner - 100,
                    CASE WHEN owner % 2 = 0 AND g < 25 THEN '-old' ELSE '' END) AS login)
           END AS org""",
        f"""struct(
              {action} AS action,
              CASE WHEN slot IN (5, 6) THEN g + 1 END AS number,
              CASE WHEN slot < 5 THEN e END AS push_id,
              CASE WHEN slot < 5 THEN 1 + e % 7 END AS size,
              {ref} AS ref,
              {ref_type} AS ref_type,
              CASE WHEN slot IN (5, 6) THEN struct(70000 + g AS id, {merged} AS merged)
                   END AS pull_request,
              CASE WHEN slot BETWEEN 7 AND 9 THEN struct(50000 + x AS id, x + 1 AS number)
                   WHEN slot BETWEEN 10 AND 12
                     THEN struct(50000 + x AS id, CAST(NULL AS BIGINT) AS number)
                   END AS issue,
              CASE WHEN slot BETWEEN 10 AND 12 THEN struct(600000 + e AS id) END AS comment,
              CASE WHEN slot = 15 THEN struct(800000 + e AS id,
                                              concat(login, '/fork-', e) AS full_name)
                   END AS forkee
            ) AS payload""",
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as JSON lines with the slice they arrive in: value, event_date, event_hour."""
    events = raw_events(spark, sf_dir)
    time_text = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'"}
    return events.select(
        F.to_json(F.struct(*events.columns), time_text).alias("value"),
        F.to_date("created_at").alias("event_date"),
        F.hour("created_at").alias("event_hour"),
    )
