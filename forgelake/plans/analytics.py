"""The analytical questions over the gold tables.

Common shape: filter the fact, aggregate it by id, and only then join the names. What is
joined has one row per repository or actor, so a key that owns a third of the events has
collapsed to one row before anything is shuffled by it. Answers are grouped by *name*, as
asked; two ids that share a name are merged by a second, small aggregation. Sums, counts
and ratios (carried as numerator and denominator) survive that; distinct counts do not,
so these join the names to distinct pairs instead.

``ordered`` sorts the answer for presentation, ties broken by key.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.functions.calendar import date_id_of, day_number
from forgelake.functions.events import count_where, percent
from forgelake.operators.joins import repeat_rows, with_calendar
from forgelake.plans import marts
from forgelake.tables import Gold


def _is(event_type: str) -> Column:
    return F.col("event_type") == event_type


def _ranked(df: DataFrame, ordered: bool, metric: str, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(metric), *ties) if ordered else df


def _repo_names(gold: Gold) -> DataFrame:
    return gold["dim_repo"].select("repo_id", "repo_name")


def monthly_commits(gold: Gold, ordered: bool = True) -> DataFrame:
    """Commits per repository and month."""
    pushes = gold["fact_dev_activity"].filter(_is("PushEvent"))
    by_id = (
        with_calendar(pushes, gold["dim_date"], "year", "month")
        .groupBy("repo_id", "year", "month")
        .agg(F.sum("push_commit_count").alias("commits"))
    )
    result = (
        by_id.join(_repo_names(gold), "repo_id")
        .groupBy("repo_name", "year", "month")
        .agg(F.sum("commits").alias("total_commits"))
    )
    return _ranked(result, ordered, "total_commits", "repo_name", "year", "month")


def pr_merge_rate(gold: Gold, ordered: bool = True) -> DataFrame:
    """Share of closed pull requests that were merged; an unknown outcome is not merged."""
    closed = gold["fact_dev_activity"].filter(
        _is("PullRequestEvent") & (F.col("pr_action") == "closed")
    )
    by_id = closed.groupBy("repo_id").agg(
        F.count(F.lit(1)).alias("closed"), count_where(F.col("pr_is_merged")).alias("merged")
    )
    result = (
        by_id.join(_repo_names(gold), "repo_id")
        .groupBy("repo_name")
        .agg(F.sum("closed").alias("total_closed"), F.sum("merged").alias("merged"))
        .withColumn("merge_rate_pct", percent(F.col("merged"), F.col("total_closed")))
    )
    return _ranked(result, ordered, "merge_rate_pct", "repo_name")


def top_pushers(gold: Gold, as_of: date | None = None, days: int = 30, n: int = 10) -> DataFrame:
    """The ``n`` developers with most pushed commits on ``as_of`` and the ``days`` before it.

    ``as_of`` is today in UTC if not given; what is dated later does not count.
    ``date_id`` orders like the date it stands for, so the window is a filter on the
    fact's partition column and no calendar join is needed.
    """
    last = as_of or datetime.now(timezone.utc).date()
    window = F.col("date_id").between(date_id_of(last - timedelta(days=days)), date_id_of(last))
    pushes = gold["fact_dev_activity"].filter(_is("PushEvent") & window)
    by_id = pushes.groupBy("actor_id").agg(
        F.count(F.lit(1)).alias("pushes"), F.sum("push_commit_count").alias("commits")
    )
    return (
        by_id.join(gold["dim_actor"].select("actor_id", "actor_login"), "actor_id")
        .groupBy("actor_login")
        .agg(F.sum("pushes").alias("push_events"), F.sum("commits").alias("total_commits"))
        .orderBy(F.desc("total_commits"), "actor_login")
        .limit(n)
    )


def live_branches(gold: Gold, respect_time: bool = False) -> DataFrame:
    """Branches that were created and not deleted.

    By default any deletion of that name in the repository counts, whenever it happened
    and whatever kind of ref it was, and a branch created twice appears twice. With
    ``respect_time`` a branch lives if its last creation follows its last deletion.
    """
    dev = gold["fact_dev_activity"]
    created = dev.filter(_is("CreateEvent") & (F.col("create_ref_type") == "branch"))
    deleted = dev.filter(_is("DeleteEvent"))
    if not respect_time:
        # Counted per branch on one side and distinct on the other, a branch that owns a third
        # of all creations is one row in the join; both sides are partitioned for it already.
        gone = deleted.select("repo_id", F.col("delete_ref_name").alias("branch_name")).distinct()
        branches = created.groupBy("repo_id", F.col("create_ref_name").alias("branch_name")).agg(
            F.count(F.lit(1)).alias("creations")
        )
        return repeat_rows(branches.join(gone, ["repo_id", "branch_name"], "left_anti"), "creations")
    moves = created.select(
        "repo_id",
        F.col("create_ref_name").alias("branch_name"),
        F.col("created_at").alias("made"),
        F.lit(None).cast("timestamp").alias("gone"),
    ).unionAll(
        deleted.filter(F.col("delete_ref_type") == "branch").select(
            "repo_id", "delete_ref_name", F.lit(None).cast("timestamp"), "created_at"
        )
    )
    return (
        moves.groupBy("repo_id", "branch_name")
        .agg(F.max("made").alias("made"), F.max("gone").alias("gone"))
        .filter(F.col("made").isNotNull() & (F.col("gone").isNull() | (F.col("made") > F.col("gone"))))
        .select("repo_id", "branch_name")
    )


def weekly_stars(gold: Gold, ordered: bool = True) -> DataFrame:
    """New stars per repository and week, under the calendar year as documented."""
    stars = gold["fact_community"].filter(_is("WatchEvent"))
    by_id = (
        with_calendar(stars, gold["dim_date"], "year", "week_of_year")
        .groupBy("repo_id", "year", "week_of_year")
        .agg(F.count(F.lit(1)).alias("stars"))
    )
    result = (
        by_id.join(_repo_names(gold), "repo_id")
        .groupBy("repo_name", "year", "week_of_year")
        .agg(F.sum("stars").alias("new_stars"))
    )
    return _ranked(result, ordered, "new_stars", "repo_name", "year", "week_of_year")


def fork_log(gold: Gold, ordered: bool = False) -> DataFrame:
    """Who forked what, into what, and on which day: one row per fork, sorted only if asked for."""
    forks = gold["fact_community"].filter(_is("ForkEvent")).select(
        "date_id", "repo_id", "actor_id", "fork_new_repo_name"
    )
    dated = with_calendar(forks, gold["dim_date"], "date_actual")
    actors = gold["dim_actor"].select("actor_id", "actor_login")
    result = dated.join(_repo_names(gold), "repo_id").join(actors, "actor_id").select(
        F.col("repo_name").alias("source_repo"),
        F.col("actor_login").alias("forked_by"),
        F.col("fork_new_repo_name").alias("new_fork_repo"),
        F.col("date_actual").alias("forked_at"),
    )
    return _ranked(result, ordered, "forked_at", "source_repo", "new_fork_repo")


def engagement_score(
    gold: Gold, star: int = 3, fork: int = 5, comment: int = 1, ordered: bool = True
) -> DataFrame:
    """Weighted count of stars, forks and comments per repository."""
    weight = (
        F.when(_is("WatchEvent"), star)
        .when(_is("ForkEvent"), fork)
        .when(_is("IssueCommentEvent"), comment)
        .otherwise(0)
    )
    by_id = gold["fact_community"].groupBy("repo_id").agg(F.sum(weight).alias("score"))
    result = (
        by_id.join(_repo_names(gold), "repo_id")
        .groupBy("repo_name")
        .agg(F.sum("score").alias("engagement_score"))
    )
    return _ranked(result, ordered, "engagement_score", "repo_name")


def org_reach(gold: Gold, ordered: bool = True, approximate: bool = False) -> DataFrame:
    """Distinct actors and events (stars and forks) per organisation.

    With ``approximate`` actors are counted by sketches (see ``marts.org_reach``), one per
    organisation and task in place of a row per organisation and actor.
    """
    if approximate:
        return _ranked(marts.org_reach_from(marts.org_reach(gold), gold), ordered, "unique_actors", "org_name")
    rows = gold["fact_community"].filter(
        F.col("event_type").isin("WatchEvent", "ForkEvent") & F.col("org_id").isNotNull()
    )
    pairs = rows.groupBy("org_id", "actor_id").agg(F.count(F.lit(1)).alias("events"))
    orgs = gold["dim_org"].select("org_id", "org_name")
    result = (
        pairs.join(orgs, "org_id")
        .groupBy("org_name", "actor_id")
        .agg(F.sum("events").alias("events"))
        .groupBy("org_name")
        .agg(F.count("actor_id").alias("unique_actors"), F.sum("events").alias("total_events"))
    )
    return _ranked(result, ordered, "unique_actors", "org_name")


def _issue_action(gold: Gold, action: str) -> DataFrame:
    return gold["fact_issue_lifecycle"].filter(_is("IssuesEvent") & (F.col("issue_action") == action))


def avg_days_to_close(gold: Gold, ordered: bool = True) -> DataFrame:
    """Mean calendar days from open to close, over every (opened, closed) pair of an issue.

    The pairs are never formed. With o openings and c closings of an issue there are o*c
    pairs, and their differences sum to o*sum(closing day) - c*sum(opening day).
    """
    day = day_number(F.col("created_at"))
    opened = _issue_action(gold, "opened").groupBy("issue_id", "repo_id").agg(
        F.count(F.lit(1)).alias("openings"), F.sum(day).alias("opening_days")
    )
    closed = _issue_action(gold, "closed").groupBy("issue_id").agg(
        F.count(F.lit(1)).alias("closings"), F.sum(day).alias("closing_days")
    )

    def times(a: str, b: str) -> Column:
        return F.col(a).cast("decimal(19,0)") * F.col(b).cast("decimal(19,0)")

    by_id = (
        opened.join(closed, "issue_id")
        .groupBy("repo_id")
        .agg(
            F.sum(times("openings", "closings")).alias("pairs"),
            F.sum(times("openings", "closing_days") - times("closings", "opening_days")).alias("days"),
        )
    )
    result = (
        by_id.join(_repo_names(gold), "repo_id")
        .groupBy("repo_name")
        .agg(
            (F.sum("days").cast("double") / F.sum("pairs").cast("double")).alias("avg_days_to_close")
        )
    )
    return _ranked(result, ordered, "avg_days_to_close", "repo_name")


def _distinct_issues_by_name(gold: Gold, issues: DataFrame, count: str) -> DataFrame:
    """Distinct issues per repository name, from distinct (issue, repository) pairs."""
    return (
        issues.join(_repo_names(gold), "repo_id")
        .select("repo_name", "issue_id")
        .distinct()
        .groupBy("repo_name")
        .agg(F.count("issue_id").alias(count))
    )


def issue_backlog(gold: Gold, ordered: bool = True) -> DataFrame:
    """Opened issues that were never closed, per repository."""
    opened = _issue_action(gold, "opened").select("issue_id", "repo_id")
    closed = _issue_action(gold, "closed").select("issue_id").distinct()
    # Distinct on both sides first: the anti join then sees an issue once per repository.
    pending = opened.distinct().join(closed, "issue_id", "left_anti")
    result = _distinct_issues_by_name(gold, pending, "open_issues")
    return _ranked(result, ordered, "open_issues", "repo_name")


def hot_issues(gold: Gold, n: int = 20) -> DataFrame:
    """The ``n`` most commented issues."""
    comments = gold["fact_issue_lifecycle"].filter(_is("IssueCommentEvent"))
    pairs = comments.groupBy(F.col("comment_target_issue_id").alias("issue_id"), "repo_id").agg(
        F.count(F.lit(1)).alias("comments")
    )
    return (
        pairs.join(_repo_names(gold), "repo_id")
        .groupBy("issue_id", "repo_name")
        .agg(F.sum("comments").alias("comment_count"))
        .orderBy(F.desc("comment_count"), "issue_id", "repo_name")
        .limit(n)
    )


def reopened_issues(gold: Gold, ordered: bool = True) -> DataFrame:
    """Distinct issues reopened per repository."""
    reopened = _issue_action(gold, "reopened").select("issue_id", "repo_id")
    result = _distinct_issues_by_name(gold, reopened.distinct(), "reopened_issues")
    return _ranked(result, ordered, "reopened_issues", "repo_name")


def reopen_rate(gold: Gold, ordered: bool = True) -> DataFrame:
    """Reopened issues as a share of the closed ones, per repository."""
    issues = gold["fact_issue_lifecycle"].filter(
        _is("IssuesEvent") & F.col("issue_action").isin("closed", "reopened")
    )
    pairs = issues.groupBy("issue_id", "repo_id").agg(
        F.max(F.col("issue_action") == "closed").alias("closed"),
        F.max(F.col("issue_action") == "reopened").alias("reopened"),
    )
    result = (
        pairs.join(_repo_names(gold), "repo_id")
        .groupBy("repo_name", "issue_id")
        .agg(F.max("closed").alias("closed"), F.max("reopened").alias("reopened"))
        .filter(F.col("issue_id").isNotNull())
        .groupBy("repo_name")
        .agg(
            count_where(F.col("closed")).alias("closed_issues"),
            count_where(F.col("reopened")).alias("reopened_issues"),
        )
        .withColumn(
            "reopen_rate_pct",
            F.when(
                F.col("closed_issues") > 0, percent(F.col("reopened_issues"), F.col("closed_issues"))
            ),
        )
    )
    return _ranked(result, ordered, "reopened_issues", "repo_name")


def repo_health(gold: Gold, ordered: bool = True) -> DataFrame:
    """Commits, stars and forks of repositories that have pushes and community events.

    Both aggregates and the dimension are partitioned by repo_id already when they meet.
    """
    commits = (
        gold["fact_dev_activity"]
        .filter(_is("PushEvent"))
        .groupBy("repo_id")
        .agg(F.sum("push_commit_count").alias("total_commits"))
    )
    interest = gold["fact_community"].groupBy("repo_id").agg(
        count_where(_is("WatchEvent")).alias("total_stars"),
        count_where(_is("ForkEvent")).alias("total_forks"),
    )
    result = (
        _repo_names(gold)
        .join(commits, "repo_id")
        .join(interest, "repo_id")
        .select("repo_name", "total_commits", "total_stars", "total_forks")
    )
    return _ranked(result, ordered, "total_commits", "repo_name")


def developer_profile(gold: Gold, login: str | None = None) -> DataFrame:
    """Commits, pull request events and comments of one login, or of all.

    Each fact is aggregated before the join. Joining both facts to the actor first would
    multiply their rows with each other and inflate the commit sum.

    An event is one row of a fact, so events are counted, not distinct ids. For one login the
    facts first meet its ids alone; these are few, so Spark broadcasts them and shuffles nothing
    of other developers.
    """
    actors = gold["dim_actor"].select("actor_id", "actor_login")
    dev, lifecycle = gold["fact_dev_activity"], gold["fact_issue_lifecycle"]
    if login is not None:
        actors = actors.filter(F.col("actor_login") == login)
        ids = actors.select("actor_id")
        dev = dev.join(ids, "actor_id", "left_semi")
        lifecycle = lifecycle.join(ids, "actor_id", "left_semi")
    return _profile(actors, dev, lifecycle)


def developer_lookup(gold: Gold, login: str, most_ids: int = 1000) -> DataFrame:
    """The profile of one login by a look into stored facts instead of a scan of them.

    The ids of the login are looked up first, in Dim_Actor, and are then constants of the plan:
    within a day and type facts lie sorted by actor, with Bloom filters of them, so that files and row
    groups without these ids are skipped. A login with more ids than ``most_ids`` is joined instead.
    """
    actors = gold["dim_actor"].select("actor_id", "actor_login").filter(F.col("actor_login") == login)
    found = [r.actor_id for r in actors.select("actor_id").limit(most_ids + 1).collect()]
    if len(found) > most_ids:
        return developer_profile(gold, login)
    mine = F.col("actor_id").isin(*found) if found else F.lit(False)
    return _profile(actors, gold["fact_dev_activity"].filter(mine), gold["fact_issue_lifecycle"].filter(mine))


def _profile(actors: DataFrame, dev: DataFrame, lifecycle: DataFrame) -> DataFrame:
    """Totals per login from the rows of both facts, each aggregated before it is joined."""
    code = (
        dev.filter(F.col("event_type").isin("PushEvent", "PullRequestEvent"))
        .groupBy("actor_id")
        .agg(
            F.sum("push_commit_count").alias("commits"),
            count_where(_is("PullRequestEvent")).alias("prs"),
        )
    )
    talk = (
        lifecycle.filter(_is("IssueCommentEvent"))
        .groupBy("actor_id")
        .agg(F.count(F.lit(1)).alias("comments"))
    )
    return (
        actors.join(code, "actor_id", "left")
        .join(talk, "actor_id", "left")
        .groupBy("actor_login")
        .agg(
            F.sum("commits").alias("total_commits"),
            F.coalesce(F.sum("prs"), F.lit(0)).alias("total_prs"),
            F.coalesce(F.sum("comments"), F.lit(0)).alias("total_comments"),
        )
    )
