import pytest
from compare import difference, duck
from conftest import SMALL

import __spark_entry__ as driver
from forgelake.plans import analytics
from forgelake.testbed.oracles import ORACLES as SQL
from forgelake.testbed.queries import QUERIES, gold_of



@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries())
    assert set(SQL) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SMALL), con, SQL[name]) == ""


@pytest.fixture
def no_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["monthly_commits", "fork_log", "org_reach", "issue_backlog", "hot_issues",
                                  "reopened_issues", "reopen_rate", "mart_issue_resolution", "avg_days_to_close"])
def test_query_equals_sql_without_broadcasts(spark, con, name, no_broadcasts):
    assert difference(QUERIES[name](spark, SMALL), con, SQL[name]) == ""


def test_entry_gives_rows(spark):
    assert driver.entry(spark).count() > 0


# Answers with an order: the measure that falls, and the columns that settle ties.
ORDERED = {
    "monthly_commits": ("total_commits", ["repo_name", "year", "month"]),
    "pr_merge_rate": ("merge_rate_pct", ["repo_name"]),
    "top_pushers_30d": ("total_commits", ["actor_login"]),
    "weekly_stars": ("new_stars", ["repo_name", "year", "week_of_year"]),
    "engagement_score": ("engagement_score", ["repo_name"]),
    "org_reach": ("unique_actors", ["org_name"]),
    "avg_days_to_close": ("avg_days_to_close", ["repo_name"]),
    "issue_backlog": ("open_issues", ["repo_name"]),
    "hot_issues": ("comment_count", ["issue_id", "repo_name"]),
    "reopened_issues": ("reopened_issues", ["repo_name"]),
    "repo_health": ("total_commits", ["repo_name"]),
}


@pytest.mark.parametrize("name", ORDERED)
def test_answers_come_in_their_order(spark, name):
    measure, ties = ORDERED[name]
    rows = QUERIES[name](spark, "/root/testdata/sf0.01").collect()
    # at this size, the most commented issues all have as many comments
    assert len({r[measure] for r in rows}) > 1 or name == "hot_issues"
    assert rows == sorted(rows, key=lambda r: (-r[measure], *[r[c] for c in ties]))


def test_fork_log_is_sorted_on_request(spark):
    forks = analytics.fork_log(gold_of(spark, SMALL), ordered=True).collect()
    assert forks == sorted(forks, key=lambda r: (-r["forked_at"].toordinal(), r["source_repo"], r["new_fork_repo"]))
