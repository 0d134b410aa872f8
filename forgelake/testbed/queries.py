"""Every operator and question as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.functions.calendar import date_id_of
from forgelake.operators import dimensions as dims
from forgelake.operators import quality
from forgelake.operators import silver as S
from forgelake.plans import analytics, jobs, marts
from forgelake.plans.gold import register_views, transform_to_gold
from forgelake.schemas import COMMON_PATHS, FACTS, SILVER_TYPES, TYPE_PATHS, ddl
from forgelake.session import prepare, shared_folder
from forgelake.sources import bronze as B
from forgelake.sources.gold import read_gold
from forgelake.sources.lake import days_between, read_silver, read_silver_dated
from forgelake.sources.tables import read_table, write_table
from forgelake.streaming.ingest import read_streamed_marts, read_streamed_silver, stream_to_silver
from forgelake.tables import Gold
from forgelake.testbed import lake
from forgelake.testbed.adapter import raw_events

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(2024, 1, 31)
ONE_DAY = date(2024, 1, 5)
RANGE = date(2024, 1, 8), date(2024, 1, 14)
LOGIN = "dev-7"

# Query name -> event type.
SILVER_VIEWS = {
    "silver_push": "PushEvent",
    "silver_pull_request": "PullRequestEvent",
    "silver_issues": "IssuesEvent",
    "silver_issue_comment": "IssueCommentEvent",
    "silver_watch": "WatchEvent",
    "silver_fork": "ForkEvent",
    "silver_create": "CreateEvent",
    "silver_delete": "DeleteEvent",
}

SQL_REPORT = """
SELECT r.repo_name, d.weekday_name, count(*) AS pushes, sum(f.push_commit_count) AS commits
FROM Fact_DevActivity f
JOIN Dim_Repo r ON f.repo_id = r.repo_id
JOIN Dim_Date d ON f.date_id = d.date_id
WHERE f.event_type = :event_type AND d.is_weekend
GROUP BY r.repo_name, d.weekday_name
"""


def silver_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.flatten(raw_events(spark, sf_dir))


def gold_of(spark: SparkSession, sf_dir: str) -> Gold:
    return transform_to_gold(silver_of(spark, sf_dir))


def _envelope(events: DataFrame) -> DataFrame:
    common = [F.col(path).alias(name) for name, path in COMMON_PATHS.items()]
    return events.select(*common, "event_date", "event_hour")


def bronze_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = lake.landing_lake(spark, sf_dir)
    return _envelope(B.read_dumps(spark, f"{base}/landing", *lake.span(spark, sf_dir)))


def bronze_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = lake.bronze_lake(spark, sf_dir)
    return _envelope(B.read_bronze(spark, f"{base}/bronze", ONE_DAY, ONE_DAY))


def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = lake.landing_lake(spark, sf_dir)
    landed = jobs.run_bronze(spark, base, *lake.span(spark, sf_dir))
    events = B.read_bronze(spark, f"{base}/bronze")
    return events.groupBy("event_date", "event_hour").agg(
        F.count(F.lit(1)).alias("events"), F.lit(landed).cast("bigint").alias("landed")
    )


def bronze_relanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dumps, and all days once more after most dumps have left the landing folder."""
    base, days = lake.landing_lake(spark, sf_dir), lake.span(spark, sf_dir)
    jobs.run_bronze(spark, base, *days)
    lake.clean_landing(spark, base, keep_hours=(3, 4))
    jobs.run_bronze(spark, base, *days)
    return _envelope(B.read_bronze(spark, f"{base}/bronze"))


def bronze_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_folder(spark, "lake")
    lake.write_bronze(lake.spoiled_lines(spark, sf_dir), f"{base}/bronze")
    bad = B.quarantine(B.read_bronze(spark, f"{base}/bronze"))
    return bad.groupBy("reason", "kept").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count("event_id").alias("with_event_id"),
        F.count("line").alias("with_text"),
    )


def silver_of_spoiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_folder(spark, "lake")
    lake.write_bronze(lake.spoiled_lines(spark, sf_dir), f"{base}/bronze")
    silver = S.flatten(B.read_bronze(spark, f"{base}/bronze"), F.col("event_date"))
    return silver.select("event_id", "event_type", "actor_id", "repo_id", "fork_new_repo_id")


def silver_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = lake.bronze_lake(spark, sf_dir)
    jobs.run_silver(spark, base, *lake.span(spark, sf_dir))
    return read_silver(spark, f"{base}/silver", ONE_DAY, ONE_DAY)


def silver_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = lake.bronze_lake(spark, sf_dir)
    jobs.run_silver(spark, base, *RANGE)
    return read_silver(spark, f"{base}/silver")


def silver_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = lake.bronze_lake(spark, sf_dir)
    jobs.run_silver(spark, base, *lake.span(spark, sf_dir))
    jobs.run_silver(spark, base, *RANGE)
    return S.counts_by_type(read_silver(spark, f"{base}/silver"))


def silver_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_events(spark, sf_dir)
    return S.union_types([S.flatten_type(raw, t) for t in TYPE_PATHS])


def silver_deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_folder(spark, "lake")
    lake.write_bronze(lake.refetched_lines(spark, sf_dir), f"{base}/bronze")
    jobs.run_silver(spark, base, *lake.span(spark, sf_dir))
    return read_silver(spark, f"{base}/silver")


def silver_deduped_any_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats two and 400 days after the first copy, which the runs meet last."""
    base, (first, last) = shared_folder(spark, "lake"), lake.span(spark, sf_dir)
    lake.write_bronze(lake.refetched_far_lines(spark, sf_dir), f"{base}/bronze")
    far = timedelta(days=400)
    jobs.run_silver(spark, base, first + far, last + far)
    jobs.run_silver(spark, base, RANGE[0], last + timedelta(days=2))
    jobs.run_silver(spark, base, first, RANGE[1])
    return read_silver(spark, f"{base}/silver")


def quarantine_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad lines that the daily job sets aside while it fills silver."""
    base = shared_folder(spark, "lake")
    lake.write_bronze(lake.spoiled_lines(spark, sf_dir), f"{base}/bronze")
    jobs.run_day(spark, base, *lake.span(spark, sf_dir))
    bad = spark.read.parquet(f"{base}/quarantine")
    return bad.groupBy("event_date", "reason", "kept").agg(F.count(F.lit(1)).alias("lines"), F.count("line").alias("with_text"))


def silver_from_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = lake.dated_lake(spark, sf_dir)
    jobs.run_silver(spark, base, *lake.span(spark, sf_dir), dated=True)
    return read_silver(spark, f"{base}/silver")


def gold_from_type_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repository health from silver that is kept as a table per type and day."""
    root, days = lake.type_tables(spark, sf_dir), lake.span(spark, sf_dir)
    return analytics.repo_health(transform_to_gold(read_silver_dated(spark, root, *days)))


def _round_trip(fmt: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        silver = silver_of(spark, sf_dir)
        path = f"{shared_folder(spark, 'table')}/silver"
        write_table(silver, path, fmt)
        return read_table(spark, path, fmt, schema=ddl(SILVER_TYPES))

    return query


def gold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in gold_of(spark, sf_dir).items()
    ]
    total = counts[0]
    for more in counts[1:]:
        total = total.unionAll(more)
    return total


def _in_two_runs(spark: SparkSession, sf_dir: str) -> Gold:
    """Gold stored by one run over the later days and one over the earlier, with a week in both."""
    base = lake.bronze_lake(spark, sf_dir)
    jobs.run_silver(spark, base, *lake.span(spark, sf_dir))
    first, last = lake.span(spark, sf_dir)
    jobs.run_gold(spark, base, RANGE[0], last)
    return jobs.run_gold(spark, base, first, RANGE[1])


def facts_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _in_two_runs(spark, sf_dir)
    parts = [
        gold[name].groupBy("date_id").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("fact"), "date_id", "rows"
        )
        for name in FACTS
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def dim_repo_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = gold_of(spark, sf_dir)
    known = F.col("repo_id") % 3
    languages = gold["dim_repo"].select(
        "repo_id", F.when(known == 0, "Python").when(known == 1, "Scala").alias("primary_language")
    )
    return dims.with_languages(
        gold["dim_repo"], languages.filter(F.col("primary_language").isNotNull())
    )


def dq_duplicate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_folder(spark, "lake")
    lake.write_bronze(lake.refetched_lines(spark, sf_dir), f"{base}/bronze")
    events = B.read_bronze(spark, f"{base}/bronze")
    return quality.duplicate_events(S.flatten(events, F.col("event_date")))


def dq_orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimensions built from week two alone, so that other weeks leave orphans to find."""
    silver = silver_of(spark, sf_dir)
    week = silver.filter(F.col("event_date").between(*[F.lit(d) for d in RANGE]))
    gold = transform_to_gold(silver)
    return quality.orphan_keys(transform_to_gold(week).with_tables(**{f: gold[f] for f in FACTS}))


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = lake.bronze_lake(spark, sf_dir)
    run = stream_to_silver(spark, f"{base}/bronze", f"{base}/streamed", f"{base}/progress")
    run.awaitTermination()
    return read_streamed_silver(spark, f"{base}/streamed")


def stream_silver_deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_folder(spark, "lake")
    lake.write_bronze(lake.refetched_lines(spark, sf_dir), f"{base}/bronze")
    run = stream_to_silver(
        spark, f"{base}/bronze", f"{base}/streamed", f"{base}/progress", dedupe=True
    )
    run.awaitTermination()
    return read_streamed_silver(spark, f"{base}/streamed")


def stream_silver_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks that arrive newest first, the last one with files that look a month old."""
    base, (first, last) = lake.awaited_lake(spark, sf_dir), lake.span(spark, sf_dir)
    days = days_between(first, last)
    for end in reversed(range(0, len(days), 7)):
        lake.arrive(spark, base, days[end : end + 7])
        if end == 0:
            lake.age_files(spark, f"{base}/bronze", first, days=30)
        jobs.run_stream(spark, base)
    return read_streamed_silver(spark, f"{base}/streamed")


def stream_silver_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small batches, of which one runs twice, and slices merged on the way and at the end."""
    base = lake.bronze_lake(spark, sf_dir)

    def run() -> None:
        stream_to_silver(
            spark, f"{base}/bronze", f"{base}/streamed", f"{base}/streamed-progress", files_per_batch=40
        ).awaitTermination()

    run()
    lake.forget_last_commit(spark, f"{base}/streamed-progress")
    run()
    jobs.run_compact(spark, base)
    return read_streamed_silver(spark, f"{base}/streamed")


def stream_repo_daily_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily mart as batches add to it, with weeks that arrive newest first and repeats."""
    base, (first, last) = lake.awaited_lake(spark, sf_dir), lake.span(spark, sf_dir)
    days = days_between(first, last)
    for end in reversed(range(0, len(days), 10)):
        lake.arrive(spark, base, days[end : end + 10])
        jobs.run_stream(spark, base, with_marts=True)
    lake.forget_last_commit(spark, f"{base}/streamed-progress")
    jobs.run_stream(spark, base, with_marts=True)
    return read_streamed_marts(spark, f"{base}/streamed")["mart_repo_daily_stats"]


def _refetched_gold(spark: SparkSession, sf_dir: str) -> tuple[str, Gold]:
    """Stored gold of a lake in which an hour of every day was fetched twice, run day by day."""
    base, (first, last) = shared_folder(spark, "lake"), lake.span(spark, sf_dir)
    lake.write_bronze(lake.refetched_lines(spark, sf_dir), f"{base}/bronze")
    jobs.run_silver(spark, base, first, RANGE[0])
    jobs.run_silver(spark, base, RANGE[0], last)
    return base, jobs.run_gold(spark, base, first, last)


def developer_profile_refetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.developer_profile(_refetched_gold(spark, sf_dir)[1])


def developer_totals_from_mart_refetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, gold = _refetched_gold(spark, sf_dir)
    return marts.developer_totals_from(jobs.run_marts(spark, base)["mart_developer_activity"], gold)


def _stored_mart(name: str) -> Query:
    """A mart after runs over the later days, the earlier ones, and a week once more."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        base, (first, last) = lake.bronze_lake(spark, sf_dir), lake.span(spark, sf_dir)
        jobs.run_silver(spark, base, first, last)
        for days in ((RANGE[0], last), (first, RANGE[1]), RANGE):
            jobs.run_gold(spark, base, *days)
            stored = jobs.run_marts(spark, base, *days)
        return stored[name]

    return query


def _marts_in_two_runs(spark: SparkSession, sf_dir: str) -> tuple[Gold, dict[str, DataFrame]]:
    base, (first, last) = lake.bronze_lake(spark, sf_dir), lake.span(spark, sf_dir)
    jobs.run_silver(spark, base, first, last)
    gold = jobs.run_gold(spark, base, first, last)
    jobs.run_marts(spark, base, RANGE[0], last)
    return gold, jobs.run_marts(spark, base, first, RANGE[1])


def org_reach_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts by sketches, united over all days and over a week, beside the exact ones.

    ``close`` tells whether the estimate is within three standard deviations of the exact count.
    """
    gold, stored = _marts_in_two_runs(spark, sf_dir)

    def beside(window: str, days: tuple[date, date] | tuple) -> DataFrame:
        about = marts.org_reach_from(stored["mart_org_reach"], gold, *days)
        rows = gold["fact_community"]
        if days:
            rows = rows.filter(F.col("date_id").between(*[date_id_of(d) for d in days]))
        exact = analytics.org_reach(gold.with_tables(fact_community=rows), ordered=False)
        exact = exact.select(F.col("org_name").alias("name"), F.col("unique_actors").alias("exact"))
        off = F.abs(F.col("unique_actors") - F.col("exact"))
        return about.join(exact, F.col("org_name") == F.col("name"), "full").select(
            F.lit(window).alias("days"), "org_name", F.col("exact").alias("unique_actors"), "total_events",
            (off <= F.greatest(F.lit(0.5), 3 * marts.SKETCH_ERROR * F.col("exact"))).alias("close"),
        )

    return beside("all", ()).unionAll(beside("week", RANGE))


def developer_lookup_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = lake.bronze_lake(spark, sf_dir)
    jobs.run_silver(spark, base, *lake.span(spark, sf_dir))
    return analytics.developer_lookup(jobs.run_gold(spark, base, *lake.span(spark, sf_dir)), LOGIN)


def sql_weekend_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = register_views(gold_of(spark, sf_dir))
    return session.sql(SQL_REPORT, args={"event_type": "PushEvent"})


def stored_repo_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = lake.bronze_lake(spark, sf_dir)
    jobs.run_silver(spark, base, *lake.span(spark, sf_dir))
    return analytics.repo_health(jobs.run_gold(spark, base, *lake.span(spark, sf_dir)))


def gold_after_broken_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repository health from stored gold after a run over a week broke off behind the facts."""
    base = lake.bronze_lake(spark, sf_dir)
    jobs.run_silver(spark, base, *lake.span(spark, sf_dir))
    jobs.run_gold(spark, base, *lake.span(spark, sf_dir))
    # the facts of this run lack the pushes, and the organisations cannot be worked out
    week = read_silver(spark, f"{base}/silver", *RANGE).filter(F.col("event_type") != "PushEvent")
    broken = week.withColumn("org_login", F.raise_error(F.lit("broken off")).cast("string"))
    try:
        jobs.write_gold(broken, f"{base}/gold", *RANGE)
    except Exception as error:  # the error comes wrapped by the engine
        if "broken off" not in str(error):
            raise
    return analytics.repo_health(read_gold(spark, f"{base}/gold"))


def stored_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = lake.bronze_lake(spark, sf_dir)
    jobs.run_silver(spark, base, *lake.span(spark, sf_dir))
    gold = jobs.run_gold(spark, base, *lake.span(spark, sf_dir))
    stored = jobs.run_marts(spark, base)
    return marts.monthly_commits_from(stored["mart_repo_daily_stats"], gold)


def _on_gold(plan: Callable[[Gold], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(gold_of(spark, sf_dir))


def _on_silver(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(silver_of(spark, sf_dir))


def _on_raw(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(raw_events(spark, sf_dir))


def _table(name: str) -> Query:
    return lambda spark, sf_dir: gold_of(spark, sf_dir)[name]


ANALYTICS: dict[str, Query] = {
    "monthly_commits": _on_gold(analytics.monthly_commits),
    "pr_merge_rate": _on_gold(analytics.pr_merge_rate),
    "top_pushers_30d": _on_gold(lambda g: analytics.top_pushers(g, as_of=AS_OF)),
    "top_pushers_mid_month": _on_gold(
        lambda g: analytics.top_pushers(g, as_of=date(2024, 1, 10), days=7)
    ),
    "live_branches": _on_gold(analytics.live_branches),
    "weekly_stars": _on_gold(analytics.weekly_stars),
    "fork_log": _on_gold(analytics.fork_log),
    "engagement_score": _on_gold(analytics.engagement_score),
    "org_reach": _on_gold(analytics.org_reach),
    "avg_days_to_close": _on_gold(analytics.avg_days_to_close),
    "issue_backlog": _on_gold(analytics.issue_backlog),
    "hot_issues": _on_gold(analytics.hot_issues),
    "reopened_issues": _on_gold(analytics.reopened_issues),
    "repo_health": _on_gold(analytics.repo_health),
    "developer_profile": _on_gold(lambda g: analytics.developer_profile(g, LOGIN)),
    "developer_profile_all": _on_gold(analytics.developer_profile),
}

MARTS: dict[str, Query] = {
    "mart_issue_resolution": _on_gold(marts.issue_resolution),
    "mart_repo_daily_stats": _on_gold(marts.repo_daily_stats),
    "mart_developer_activity": _on_gold(marts.developer_activity),
}

OTHERS: dict[str, Query] = {
    "bronze_read": bronze_read,
    "bronze_day": bronze_day,
    "ingest_counts": ingest_counts,
    "bronze_relanded": bronze_relanded,
    "bronze_quarantine": bronze_quarantine,
    "silver_of_spoiled": silver_of_spoiled,
    "silver_day": silver_day,
    "silver_range": silver_range,
    "silver_rerun": silver_rerun,
    "silver_sparse": _on_raw(S.flatten),
    "silver_union": silver_union,
    "silver_from_dated": silver_from_dated,
    "gold_from_type_tables": gold_from_type_tables,
    "silver_deduped": silver_deduped,
    "silver_deduped_any_day": silver_deduped_any_day,
    "quarantine_of_days": quarantine_of_days,
    "silver_counts_by_type": _on_silver(S.counts_by_type),
    "event_types_present": _on_raw(S.event_types_present),
    **{
        name: _on_raw(lambda raw, t=event_type: S.flatten_type(raw, t))
        for name, event_type in SILVER_VIEWS.items()
    },
    "read_table_parquet": _round_trip("parquet"),
    "read_table_csv": _round_trip("csv"),
    "read_table_json": _round_trip("json"),
    "dim_date": _table("dim_date"),
    "dim_actor": _table("dim_actor"),
    "dim_repo": _table("dim_repo"),
    "dim_org": _table("dim_org"),
    "dim_repo_enriched": dim_repo_enriched,
    "dim_actor_incremental": lambda spark, sf_dir: _in_two_runs(spark, sf_dir)["dim_actor"],
    "dim_repo_incremental": lambda spark, sf_dir: _in_two_runs(spark, sf_dir)["dim_repo"],
    "dim_date_incremental": lambda spark, sf_dir: _in_two_runs(spark, sf_dir)["dim_date"],
    "dim_org_incremental": lambda spark, sf_dir: _in_two_runs(spark, sf_dir)["dim_org"],
    **{name: _table(name) for name in FACTS},
    "facts_stored": facts_stored,
    "gold_counts": gold_counts,
    "live_branches_in_time": _on_gold(lambda g: analytics.live_branches(g, respect_time=True)),
    "reopen_rate": _on_gold(analytics.reopen_rate),
    "monthly_commits_from_mart": _on_gold(
        lambda g: marts.monthly_commits_from(marts.repo_daily_stats(g), g)
    ),
    "weekly_stars_from_mart": _on_gold(
        lambda g: marts.weekly_stars_from(marts.repo_daily_stats(g), g)
    ),
    "developer_totals_from_mart": _on_gold(
        lambda g: marts.developer_totals_from(marts.developer_activity(g), g)
    ),
    "stored_repo_health": stored_repo_health,
    "gold_after_broken_run": gold_after_broken_run,
    "org_reach_approx": org_reach_approx,
    "developer_lookup_stored": developer_lookup_stored,
    "stored_marts": stored_marts,
    "stored_issue_resolution": _stored_mart("mart_issue_resolution"),
    "stored_developer_activity": _stored_mart("mart_developer_activity"),
    "developer_profile_refetched": developer_profile_refetched,
    "developer_totals_from_mart_refetched": developer_totals_from_mart_refetched,
    "sql_weekend_report": sql_weekend_report,
    "stream_silver": stream_silver,
    "stream_silver_deduped": stream_silver_deduped,
    "stream_silver_late": stream_silver_late,
    "stream_silver_compacted": stream_silver_compacted,
    "stream_repo_daily_stats": stream_repo_daily_stats,
    "dq_duplicate_events": dq_duplicate_events,
    "dq_orphan_keys": dq_orphan_keys,
    "dq_sparse_profile": _on_silver(quality.sparse_profile),
}


def _prepared(query: Query) -> Query:
    return lambda spark, sf_dir: query(prepare(spark), sf_dir)


QUERIES: dict[str, Query] = {
    name: _prepared(query) for name, query in {**ANALYTICS, **MARTS, **OTHERS}.items()
}
