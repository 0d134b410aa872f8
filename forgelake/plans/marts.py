"""Pre-computed aggregates for questions that would otherwise rescan the facts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.functions.calendar import date_id_of, day_number
from forgelake.operators.dimensions import issue_moments
from forgelake.operators.joins import with_calendar
from forgelake.sources.snapshot import Run
from forgelake.tables import Gold

MART_TYPES = {
    "mart_issue_resolution": {
        "issue_id": "BIGINT",
        "opened_at": "TIMESTAMP",
        "closed_at": "TIMESTAMP",
        "days_to_close": "BIGINT",
    },
    "mart_repo_daily_stats": {
        "repo_id": "BIGINT",
        "date_id": "INT",
        "total_commits": "BIGINT",
        "total_stars": "BIGINT",
        "total_forks": "BIGINT",
    },
    "mart_developer_activity": {
        "actor_id": "BIGINT",
        "year": "INT",
        "month": "INT",
        "total_commits": "BIGINT",
        "total_prs": "BIGINT",
        "total_comments": "BIGINT",
    },
    "mart_org_reach": {
        "org_id": "BIGINT",
        "date_id": "INT",
        "actors": "BINARY",
        "total_events": "BIGINT",
    },
}

#: Logarithm of the cells of a sketch: 4,096 cells of a byte, and with them an error of about
#: 1.04 / 64 = 1.6 % (one standard deviation; three cover 99.7 % of answers). Small sets are exact.
SKETCH_SIZE = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_SIZE / 2)


def issue_resolution(gold: Gold) -> DataFrame:
    """First opening of each issue and the first closing at or after it.

    One row per issue with any issue event: ``opened_at`` is NULL where the opening lies
    before the data, ``closed_at`` where the issue was not closed since.
    """
    return resolved(issue_moments(gold["fact_issue_lifecycle"]))


def resolved(moments: DataFrame) -> DataFrame:
    """The same from (issue_id, opened_at, closed_at), one or several rows per issue.

    One hash aggregate answers all issues whose first closing follows the opening. Only for
    the others are the closings looked at one by one; no list of them is ever gathered.
    """
    firsts = moments.groupBy("issue_id").agg(
        F.min("opened_at").alias("opened_at"), F.min("closed_at").alias("closed_at")
    )
    backwards = F.coalesce(F.col("closed_at") < F.col("opened_at"), F.lit(False))
    in_order = firsts.filter(~backwards).select(
        "issue_id",
        "opened_at",
        F.when(F.col("opened_at").isNotNull(), F.col("closed_at")).alias("closed_at"),
    )
    odd = firsts.filter(backwards).select("issue_id", "opened_at")
    closings = moments.filter(F.col("closed_at").isNotNull()).select("issue_id", "closed_at")
    later = (
        closings.join(odd, "issue_id")
        .groupBy("issue_id", "opened_at")
        .agg(F.min(F.when(F.col("closed_at") >= F.col("opened_at"), F.col("closed_at"))).alias("closed_at"))
    )
    return in_order.unionAll(later).select(
        "issue_id",
        "opened_at",
        "closed_at",
        (day_number(F.col("closed_at")) - day_number(F.col("opened_at"))).alias("days_to_close"),
    )


def repo_daily_stats(gold: Gold, *by: str) -> DataFrame:
    """Commits, stars and forks per repository and day; commits are NULL without a push.

    Rows of both facts are stacked and summed in one shuffle. ``by`` adds a grouping, such as
    the slice under which the daily job stores its share.
    """
    none = F.lit(None).cast("int")
    pushes = gold["fact_dev_activity"].filter(F.col("event_type") == "PushEvent")
    interest = gold["fact_community"].filter(F.col("event_type").isin("WatchEvent", "ForkEvent"))
    rows = pushes.select(
        *by,
        "repo_id",
        "date_id",
        F.col("push_commit_count").alias("commits"),
        F.lit(0).alias("star"),
        F.lit(0).alias("fork"),
    ).unionAll(
        interest.select(
            *by,
            "repo_id",
            "date_id",
            none,
            (F.col("event_type") == "WatchEvent").cast("int"),
            (F.col("event_type") == "ForkEvent").cast("int"),
        )
    )
    return rows.groupBy(*by, "repo_id", "date_id").agg(
        F.sum("commits").alias("total_commits"),
        F.sum("star").alias("total_stars"),
        F.sum("fork").alias("total_forks"),
    )


def developer_activity(gold: Gold, *by: str) -> DataFrame:
    """Commits, pull request events and comments per actor and month."""
    none = F.lit(None).cast("int")
    code = gold["fact_dev_activity"].filter(
        F.col("event_type").isin("PushEvent", "PullRequestEvent")
    )
    talk = gold["fact_issue_lifecycle"].filter(F.col("event_type") == "IssueCommentEvent")
    rows = code.select(
        *by,
        "actor_id",
        "date_id",
        F.col("push_commit_count").alias("commits"),
        (F.col("event_type") == "PullRequestEvent").cast("int").alias("pr"),
        F.lit(0).alias("comment"),
    ).unionAll(talk.select(*by, "actor_id", "date_id", none, F.lit(0), F.lit(1)))
    return (
        with_calendar(rows, gold["dim_date"], "year", "month")
        .groupBy(*by, "actor_id", "year", "month")
        .agg(
            F.sum("commits").alias("total_commits"),
            F.sum("pr").alias("total_prs"),
            F.sum("comment").alias("total_comments"),
        )
    )


def org_reach(gold: Gold, *by: str) -> DataFrame:
    """A sketch of the actors behind stars and forks, per organisation and day.

    Sketches of any days and organisations unite to one of the distinct actors of them all.
    """
    rows = gold["fact_community"].filter(
        F.col("event_type").isin("WatchEvent", "ForkEvent") & F.col("org_id").isNotNull()
    )
    return rows.groupBy(*by, "org_id", "date_id").agg(
        F.hll_sketch_agg("actor_id", SKETCH_SIZE).alias("actors"), F.count(F.lit(1)).alias("total_events")
    )


def united(shares: DataFrame, piece: str) -> DataFrame:
    return shares.groupBy("org_id", "date_id").agg(
        F.hll_union_agg("actors").alias("actors"), F.sum("total_events").alias("total_events")
    )


@dataclass(frozen=True)
class Stored:
    """How a mart is kept: in pieces of its key, each made from the shares of the slices that touch it.

    ``share`` gives a slice's rows, ``piece`` the column that a row is stored under and ``piece_of`` its value in SQL, ``settle`` the rows
    of the mart from all shares of some pieces.
    """

    share: Callable[[Gold, str], DataFrame]
    share_types: dict[str, str]
    piece: str
    piece_of: str
    settle: Callable[[DataFrame, str], DataFrame]


def added_up(keys: list[str], measures: list[str]) -> Callable[[DataFrame, str], DataFrame]:
    def settle(shares: DataFrame, piece: str) -> DataFrame:
        by = list(dict.fromkeys([piece, *keys]))
        return shares.groupBy(*by).agg(*[F.sum(c).alias(c) for c in measures])

    return settle


def issue_share(gold: Gold, *by: str) -> DataFrame:
    """What the events of a slice say of each issue: a row per closing, with the first opening."""
    rows = issue_moments(gold["fact_issue_lifecycle"], *by)
    return rows.groupBy(*by, "issue_id", "closed_at").agg(F.min("opened_at").alias("opened_at"))


def settled_issues(shares: DataFrame, piece: str) -> DataFrame:
    return resolved(shares).withColumn(piece, F.expr(ISSUE_BUCKET))


# Issues by number: new ones, which most events are about, lie together, and the number of buckets
# grows with the issues that there are.
ISSUES_IN_BUCKET = 1 << 20
ISSUE_BUCKET = f"shiftright(issue_id, {ISSUES_IN_BUCKET.bit_length() - 1})"

STORED = {
    "mart_issue_resolution": Stored(
        issue_share, {"issue_id": "BIGINT", "closed_at": "TIMESTAMP", "opened_at": "TIMESTAMP"},
        "bucket", ISSUE_BUCKET, settled_issues,
    ),
    "mart_repo_daily_stats": Stored(
        repo_daily_stats, MART_TYPES["mart_repo_daily_stats"], "date_id", "date_id",
        added_up(["repo_id", "date_id"], ["total_commits", "total_stars", "total_forks"]),
    ),
    "mart_developer_activity": Stored(
        developer_activity, MART_TYPES["mart_developer_activity"], "month_id", "year * 100 + month",
        added_up(["actor_id", "year", "month"], ["total_commits", "total_prs", "total_comments"]),
    ),
    "mart_org_reach": Stored(org_reach, MART_TYPES["mart_org_reach"], "date_id", "date_id", united),
}


def renew(run: Run, name: str, gold: Gold, slices: list[str] | None) -> None:
    """Put the mart's pieces that these slices of ``gold`` touch, or touched before, into the run.

    Each piece keeps the shares of its slices, so that a slice that comes again takes back what it
    gave, in whatever order slices come. Pieces that the slices do not touch are neither read nor
    written; the pieces in question come to the driver as a list, a number per day, month or bucket.
    """
    how, spark = STORED[name], run.spark
    shares, touched = f"{name}_shares", f"{name}_touched"
    stage = run.folder(f"{name}_stage")
    share = how.share(gold, "event_date").withColumn(how.piece, F.expr(how.piece_of))
    share.write.parquet(stage)
    share = spark.read.parquet(stage)
    marks = share.select("event_date", how.piece).distinct()
    all_types = {**how.share_types, "event_date": "DATE", how.piece: "BIGINT"}
    mark_types = {"event_date": "DATE", how.piece: "BIGINT"}
    if slices is None:
        run.put(touched, marks, by=("event_date",))
        run.put(shares, share, by=(how.piece,))
        pieces = None
    else:
        known = marks.select(F.col(how.piece).cast("bigint"))
        if touched in run.parts:
            known = known.union(run.read(touched, mark_types, slices).select(how.piece))
        pieces = [f"{how.piece}={r[0]}" for r in known.distinct().collect()]
        rows = share.select(*all_types)
        if shares in run.parts:
            days = [F.lit(s.removeprefix("event_date=")).cast("date") for s in slices]
            others = run.read(shares, all_types, pieces).filter(~F.col("event_date").isin(*days))
            rows = others.union(rows)
        run.put(touched, marks, by=("event_date",), replaces=slices)
        run.put(shares, rows, by=(how.piece,), replaces=pieces)
    settled = how.settle(run.read(shares, all_types, pieces), how.piece)
    run.put(name, settled, by=(how.piece,), replaces=pieces)


def monthly_commits_from(daily: DataFrame, gold: Gold) -> DataFrame:
    """Commits per repository and month out of the daily mart (pushes of unknown size aside)."""
    by_id = (
        with_calendar(daily.filter(F.col("total_commits").isNotNull()), gold["dim_date"], "year", "month")
        .groupBy("repo_id", "year", "month")
        .agg(F.sum("total_commits").alias("commits"))
    )
    return (
        by_id.join(gold["dim_repo"].select("repo_id", "repo_name"), "repo_id")
        .groupBy("repo_name", "year", "month")
        .agg(F.sum("commits").alias("total_commits"))
    )


def weekly_stars_from(daily: DataFrame, gold: Gold) -> DataFrame:
    """New stars per repository and week out of the daily mart."""
    by_id = (
        with_calendar(daily.filter(F.col("total_stars") > 0), gold["dim_date"], "year", "week_of_year")
        .groupBy("repo_id", "year", "week_of_year")
        .agg(F.sum("total_stars").alias("stars"))
    )
    return (
        by_id.join(gold["dim_repo"].select("repo_id", "repo_name"), "repo_id")
        .groupBy("repo_name", "year", "week_of_year")
        .agg(F.sum("stars").alias("new_stars"))
    )


def developer_totals_from(monthly: DataFrame, gold: Gold) -> DataFrame:
    """All-time totals per login out of the monthly mart, for actors without activity too."""
    by_id = monthly.groupBy("actor_id").agg(
        F.sum("total_commits").alias("commits"),
        F.sum("total_prs").alias("prs"),
        F.sum("total_comments").alias("comments"),
    )
    return (
        gold["dim_actor"]
        .select("actor_id", "actor_login")
        .join(by_id, "actor_id", "left")
        .groupBy("actor_login")
        .agg(
            F.sum("commits").alias("total_commits"),
            F.coalesce(F.sum("prs"), F.lit(0)).alias("total_prs"),
            F.coalesce(F.sum("comments"), F.lit(0)).alias("total_comments"),
        )
    )


def org_reach_from(daily: DataFrame, gold: Gold, first: date | None = None, last: date | None = None) -> DataFrame:
    """Distinct actors, about, and events per organisation over any days, out of the daily sketches."""
    if first is not None:
        daily = daily.filter(F.col("date_id") >= date_id_of(first))
    if last is not None:
        daily = daily.filter(F.col("date_id") <= date_id_of(last))
    by_id = daily.groupBy("org_id").agg(F.hll_union_agg("actors").alias("actors"), F.sum("total_events").alias("events"))
    return (
        by_id.join(gold["dim_org"].select("org_id", "org_name"), "org_id")
        .groupBy("org_name")
        .agg(
            F.hll_sketch_estimate(F.hll_union_agg("actors")).alias("unique_actors"),
            F.sum("events").alias("total_events"),
        )
    )
