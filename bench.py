"""Time the headline queries and print one JSON line.

Each query runs from the events table through silver and gold to its answer, and again on gold
tables stored beforehand by the batch jobs. One round over all queries warms the session up; the
figure of a query is the median of the rounds after it.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from forgelake.plans import analytics, jobs, marts
from forgelake.plans.silver import write_silver
from forgelake.session import local_session, shared_folder
from forgelake.sources.lake import day_slices
from forgelake.testbed import lake
from forgelake.testbed.queries import ANALYTICS, AS_OF, LOGIN, MARTS, QUERIES, silver_of

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROUNDS = int(os.environ.get("BENCH_ROUNDS", "3"))

STORED = {
    "monthly_commits": analytics.monthly_commits,
    "pr_merge_rate": analytics.pr_merge_rate,
    "top_pushers_30d": lambda g: analytics.top_pushers(g, as_of=AS_OF),
    "live_branches": analytics.live_branches,
    "weekly_stars": analytics.weekly_stars,
    "fork_log": analytics.fork_log,
    "engagement_score": analytics.engagement_score,
    "org_reach": analytics.org_reach,
    "avg_days_to_close": analytics.avg_days_to_close,
    "issue_backlog": analytics.issue_backlog,
    "hot_issues": analytics.hot_issues,
    "reopened_issues": analytics.reopened_issues,
    "repo_health": analytics.repo_health,
    "developer_profile": lambda g: analytics.developer_profile(g, LOGIN),
    "developer_profile_all": analytics.developer_profile,
    "mart_issue_resolution": marts.issue_resolution,
    "mart_repo_daily_stats": marts.repo_daily_stats,
    "mart_developer_activity": marts.developer_activity,
}


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_seconds(actions) -> dict[str, float]:
    rounds = [{name: timed(action) for name, action in actions.items()} for _ in range(ROUNDS + 1)]
    return {
        name: round(statistics.median(r[name] for r in rounds[1:]), 3) for name in actions
    }


def main() -> None:
    spark = local_session(CPUS)
    direct = median_seconds(
        {n: lambda n=n: consume(QUERIES[n](spark, SF_DIR)) for n in [*ANALYTICS, *MARTS]}
    )
    base = shared_folder(spark, "bench")
    silver, days = silver_of(spark, SF_DIR), lake.span(spark, SF_DIR)
    store = {
        "store_silver": round(
            timed(lambda: write_silver(silver, f"{base}/silver", day_slices(*days))), 3
        ),
        "store_gold": round(timed(lambda: jobs.run_gold(spark, base, *days)), 3),
    }
    gold = jobs.read_gold(spark, f"{base}/gold")
    stored = median_seconds({n: lambda p=p: consume(p(gold)) for n, p in STORED.items()})
    print(
        json.dumps(
            {
                "metric": "total time of the analytical questions and marts, from events to answer",
                "value": round(sum(direct.values()), 3),
                "unit": "sec",
                "queries": direct,
                "on_stored_gold": stored,
                "jobs": store,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
