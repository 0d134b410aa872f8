from datetime import date, datetime

import pytest

from forgelake.operators.joins import repeat_rows
from forgelake.plans import analytics as A
from forgelake.plans import marts as M
from forgelake.plans.gold import transform_to_gold


@pytest.fixture(autouse=True, params=["UTC", "America/Los_Angeles"])
def zone(request, spark):
    """No answer may depend on the session's time zone."""
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def issue(action, day, issue=1, **more):
    return {"event_type": "IssuesEvent", "issue_action": action, "issue_id": issue,
            "created_at": f"2024-01-{day:02d} 12:00:00", **more}


def push(commits, **more):
    return {"event_type": "PushEvent", "push_commit_count": commits, **more}


def tuples(df):
    return [tuple(r) for r in df.collect()]


def test_close_time_is_over_all_pairs(rows):
    silver = rows(issue("opened", 1), issue("opened", 3), issue("closed", 4), issue("closed", 11),
                  issue("opened", 5, issue=2), issue("closed", 2, issue=3))
    pairs = [4 - 1, 11 - 1, 4 - 3, 11 - 3]
    assert tuples(A.avg_days_to_close(transform_to_gold(silver))) == [("o/r", sum(pairs) / 4)]


def test_close_time_counts_calendar_days(rows):
    silver = rows({**issue("opened", 1), "created_at": "2024-01-01 23:00:00"},
                  {**issue("closed", 2), "created_at": "2024-01-02 01:00:00"})
    assert tuples(A.avg_days_to_close(transform_to_gold(silver))) == [("o/r", 1.0)]


def test_profile_is_not_inflated_by_the_other_fact(rows):
    silver = rows(
        push(2), push(3),
        {"event_type": "PullRequestEvent", "pr_action": "opened"},
        *[{"event_type": "IssueCommentEvent", "comment_id": n} for n in range(4)],
        {"event_type": "WatchEvent", "actor_id": 2, "actor_login": "idle"},
    )
    gold = transform_to_gold(silver)
    assert tuples(A.developer_profile(gold, "ann")) == [("ann", 5, 1, 4)]
    assert sorted(tuples(A.developer_profile(gold))) == [("ann", 5, 1, 4), ("idle", None, 0, 0)]
    assert tuples(A.developer_profile(gold, "nobody")) == []


def test_live_branches_as_documented_and_in_time(rows):
    def create(name, day, kind="branch"):
        return {"event_type": "CreateEvent", "create_ref_type": kind, "create_ref_name": name,
                "created_at": f"2024-01-{day:02d} 00:00:00"}

    def delete(name, day, kind="branch"):
        return {"event_type": "DeleteEvent", "delete_ref_type": kind, "delete_ref_name": name,
                "created_at": f"2024-01-{day:02d} 00:00:00"}

    silver = rows(
        create("kept", 1), create("kept", 2), create("dead", 1), delete("dead", 2),
        create("again", 1), delete("again", 2), create("again", 3),
        create("tagged", 1), delete("tagged", 2, "tag"), create("v1", 1, "tag"), create(None, 1),
        {**delete("kept", 3), "repo_id": 11},
    )
    gold = transform_to_gold(silver)
    plain = sorted(tuples(A.live_branches(gold)), key=str)
    assert plain == [(10, "kept"), (10, "kept"), (10, None)]
    timed = sorted(tuples(A.live_branches(gold, respect_time=True)), key=str)
    assert timed == [(10, "again"), (10, "kept"), (10, "tagged"), (10, None)]


def test_ids_that_share_a_name_are_merged(rows):
    silver = rows(
        push(1), push(2, repo_id=11), {**issue("reopened", 1)}, issue("reopened", 2, repo_id=11),
        issue("reopened", 2, issue=9, repo_id=11),
        {"event_type": "PullRequestEvent", "pr_action": "closed", "pr_is_merged": True},
        {"event_type": "PullRequestEvent", "pr_action": "closed", "pr_is_merged": None, "repo_id": 11},
        {"event_type": "PullRequestEvent", "pr_action": "closed", "pr_is_merged": False, "repo_id": 11},
    )
    gold = transform_to_gold(silver)
    assert tuples(A.monthly_commits(gold)) == [("o/r", 2024, 1, 3)]
    # Issue 1 was reopened under both ids and still counts once.
    assert tuples(A.reopened_issues(gold)) == [("o/r", 2)]
    assert tuples(A.pr_merge_rate(gold)) == [("o/r", 3, 1, 33.3)]


def test_backlog_and_reopen_rate(rows):
    silver = rows(
        issue("opened", 1), issue("closed", 2), issue("reopened", 3),
        issue("opened", 1, issue=2), issue("opened", 2, issue=2),
        issue("opened", 1, issue=3, repo_id=11, repo_name="o/s"), issue("closed", 2, issue=4),
    )
    gold = transform_to_gold(silver)
    assert sorted(tuples(A.issue_backlog(gold))) == [("o/r", 1), ("o/s", 1)]
    assert tuples(A.reopen_rate(gold)) == [("o/r", 2, 1, 50.0)]


def test_window_of_top_pushers(rows):
    silver = rows(
        push(5, created_at="2024-01-01 00:00:00"), push(7, created_at="2023-12-31 23:59:59"),
        push(5, actor_id=2, actor_login="abe"), push(1, actor_id=3, actor_login="cid"),
    )
    gold = transform_to_gold(silver)
    assert tuples(A.top_pushers(gold, as_of=date(2024, 1, 31), n=2)) == [("abe", 1, 5), ("ann", 1, 5)]
    assert tuples(A.top_pushers(gold, as_of=date(2024, 1, 31), days=31, n=1)) == [("ann", 2, 12)]


def test_engagement_weights(rows):
    silver = rows({"event_type": "WatchEvent"}, {"event_type": "ForkEvent"}, {"event_type": "IssueCommentEvent"})
    gold = transform_to_gold(silver)
    assert tuples(A.engagement_score(gold)) == [("o/r", 9)]
    assert tuples(A.engagement_score(gold, star=1, fork=10, comment=0)) == [("o/r", 11)]


def test_repo_health_needs_both_sides(rows):
    silver = rows(
        push(4), {"event_type": "IssueCommentEvent"},
        push(1, repo_id=11, repo_name="o/quiet"), {"event_type": "WatchEvent", "repo_id": 12, "repo_name": "o/fan"},
    )
    assert tuples(A.repo_health(transform_to_gold(silver))) == [("o/r", 4, 0, 0)]


def test_resolution_takes_first_close_after_open(rows):
    silver = rows(
        issue("opened", 5), issue("closed", 2), issue("closed", 9), issue("closed", 20),
        issue("opened", 1, issue=2), issue("closed", 1, issue=2), issue("closed", 3, issue=3),
        issue("opened", 4, issue=4), issue("opened", 8, issue=5), issue("closed", 7, issue=5),
        issue("reopened", 7, issue=6),
    )
    found = {r["issue_id"]: (r["opened_at"], r["closed_at"], r["days_to_close"])
             for r in M.issue_resolution(transform_to_gold(silver)).collect()}
    noon = lambda day: datetime(2024, 1, day, 12)
    assert found == {
        1: (noon(5), noon(9), 4), 2: (noon(1), noon(1), 0), 3: (None, None, None),
        4: (noon(4), None, None), 5: (noon(8), None, None), 6: (None, None, None),
    }


def test_rows_are_repeated_in_pieces(spark):
    df = spark.createDataFrame([("a", 1), ("b", 7), (None, 3)], "k STRING, n BIGINT")
    got = sorted(str(r["k"]) for r in repeat_rows(df, "n", most=3).collect())
    assert got == ["None"] * 3 + ["a"] + ["b"] * 7
