import json

import pytest
from pyspark.sql import functions as F

from forgelake.functions import events
from forgelake.operators import silver as S
from forgelake.schemas import COMMON_PATHS, SILVER_TYPES, TYPE_PATHS
from forgelake.sources.bronze import quarantine, read_events

# Payload as sent -> what the type's columns must hold.
PAYLOADS = {
    "PushEvent": ({"push_id": 61, "size": 0, "ref": "refs/tags/süd", "head": "c0ffee"},
                  {"push_id": 61, "push_commit_count": 0, "push_ref": "refs/tags/süd"}),
    "PullRequestEvent": (
        {"action": "closed", "number": 3_000_000_000, "pull_request": {"id": 17, "merged": True, "title": "x"}},
        {"pr_action": "closed", "pr_number": 3_000_000_000, "pr_id": 17, "pr_is_merged": True}),
    "IssuesEvent": ({"action": "reopened", "issue": {"id": 2**62, "number": 4, "labels": [{}]}},
                    {"issue_action": "reopened", "issue_id": 2**62, "issue_number": 4}),
    "IssueCommentEvent": (
        {"action": "deleted", "issue": {"id": 31, "number": 8}, "comment": {"id": 32, "body": "{}"}},
        {"comment_action": "deleted", "comment_target_issue_id": 31, "comment_id": 32}),
    "WatchEvent": ({"action": ""}, {"watch_action": ""}),
    "ForkEvent": ({"forkee": {"id": -1, "full_name": "neu/größe"}},
                  {"fork_new_repo_id": -1, "fork_new_repo_name": "neu/größe"}),
    "CreateEvent": ({"ref_type": "repository", "ref": None},
                    {"create_ref_type": "repository", "create_ref_name": None}),
    "DeleteEvent": ({"ref_type": "branch", "ref": "a/b c"},
                    {"delete_ref_type": "branch", "delete_ref_name": "a/b c"}),
}


def event(n, kind, payload, **changes):
    base = {"id": str(n), "type": kind, "created_at": "2024-02-29T23:59:58Z",
            "actor": {"id": 7, "login": "someone", "url": "x"}, "repo": {"id": 10, "name": "lake/forge"},
            "org": {"id": 70, "login": "lake"}, "payload": payload, "public": True}
    return {k: v for k, v in {**base, **changes}.items() if v is not ...}


@pytest.fixture
def bronze(spark, tmp_path):
    def load(*lines):
        text = "\n".join(x if isinstance(x, str) else json.dumps(x, ensure_ascii=False) for x in lines)
        (tmp_path / "events.json").write_text(text + "\n", encoding="utf-8")
        return read_events(spark, str(tmp_path))

    return load


@pytest.mark.parametrize("kind", TYPE_PATHS)
def test_each_type_flattens_to_its_columns(bronze, kind):
    payload, expected = PAYLOADS[kind]
    raw = bronze(event(7, kind, payload))
    one = S.flatten_type(raw, kind)
    assert one.columns == [*COMMON_PATHS, *TYPE_PATHS[kind]]
    row = one.collect()[0].asDict()
    assert {k: row[k] for k in expected} == expected
    assert (row["event_id"], row["actor_id"], row["repo_name"], row["org_id"]) == ("7", 7, "lake/forge", 70)
    assert str(row["created_at"]) == "2024-02-29 23:59:58"


def test_sparse_row_is_null_off_its_type(bronze):
    raw = bronze(*[event(n, kind, p[0]) for n, (kind, p) in enumerate(PAYLOADS.items())])
    sparse = S.flatten(raw)
    assert sparse.columns == list(SILVER_TYPES)
    assert {c: t.upper() for c, t in sparse.dtypes} == SILVER_TYPES
    for row in sparse.collect():
        for kind, fields in TYPE_PATHS.items():
            for name in fields:
                expected = PAYLOADS[kind][1][name] if kind == row["event_type"] else None
                assert row[name] == expected


def test_type_views_union_back_to_the_sparse_table(bronze):
    raw = bronze(*[event(n, kind, p[0]) for n, (kind, p) in enumerate(PAYLOADS.items())])
    sparse = S.flatten(raw).drop("event_date")
    union = S.union_types([S.flatten_type(raw, kind) for kind in TYPE_PATHS])
    assert union.columns == sparse.columns
    assert union.exceptAll(sparse).isEmpty() and sparse.exceptAll(union).isEmpty()
    for kind in TYPE_PATHS:
        view, direct = S.of_type(S.flatten(raw), kind), S.flatten_type(raw, kind)
        assert view.collect() == direct.collect()


def test_missing_and_null_members_read_alike(bronze):
    raw = bronze(
        event(1, "PushEvent", {"push_id": 5}, org=...),
        event(2, "PushEvent", {"push_id": 5, "size": None, "ref": None}, org=None),
        event(3, "PullRequestEvent", {"action": "closed", "number": 1}),
        event(4, "CreateEvent", {"ref_type": "repository", "ref": None}),
        event(5, "WatchEvent", ...),
    )
    rows = {r["event_id"]: r for r in S.flatten(raw).collect()}
    assert len(rows) == 5
    for n in "12":
        assert (rows[n]["push_id"], rows[n]["push_commit_count"], rows[n]["org_id"]) == (5, None, None)
    assert rows["3"]["pr_is_merged"] is None
    assert rows["4"]["create_ref_name"] is None
    assert rows["5"]["watch_action"] is None


def test_other_types_and_unplaceable_rows_are_dropped(bronze):
    raw = bronze(
        event(1, "GollumEvent", {}),
        event(2, "WatchEvent", {"action": "started"}, id=None),
        event(3, "WatchEvent", {"action": "started"}, created_at="yesterday"),
        event(4, "WatchEvent", {"action": "started"}, type=None),
        event(6, "WatchEvent", {"action": "started"}, created_at="+12345-01-01T00:00:00Z"),
        event(7, "WatchEvent", {"action": "started"}, created_at="-0044-03-15T00:00:00Z"),
        event(8, "WatchEvent", {"action": "started"}, created_at="12:30:00"),
        event(9, "WatchEvent", {"action": "started"}, created_at="2024"),
        event(5, "WatchEvent", {"action": "started"}),
    )
    assert [r["event_id"] for r in S.flatten(raw).collect()] == ["5"]
    assert {r["event_type"] for r in S.event_types_present(raw).collect()} == {"GollumEvent", "WatchEvent", None}


def test_quarantine_lists_every_bad_line(bronze):
    raw = bronze(
        event(1, "WatchEvent", {"action": "started"}),
        '{"id": "2", "type": "Watch',
        event(3, "WatchEvent", {"action": "started"}, actor={"id": "x", "login": "someone"}),
        event(4, "WatchEvent", {"action": "started"}, created_at="yesterday"),
        event(5, "WatchEvent", {"action": "started"}, id=None),
        event(6, "PushEvent", {"push_id": 1, "size": "many"}),
        event(7, "WatchEvent", {"action": "started"}, created_at="12:30:00"),
    )
    bad = quarantine(raw)
    found = sorted((r["reason"], r["kept"], r["line"] is not None) for r in bad.collect())
    assert found == [
        ("missing id or type", False, False),
        ("unreadable field", True, True),
        ("unreadable field", True, True),
        ("unreadable line", False, True),
        ("unreadable time", False, False),
        ("unreadable time", False, False),
    ]
    # The same lines are found when only a count is asked for, which needs no column.
    assert bad.count() == 6
    silver = {r["event_id"]: r for r in S.flatten(raw).collect()}
    assert sorted(silver) == ["1", "3", "6"]
    assert silver["3"]["actor_id"] is None and silver["3"]["actor_login"] == "someone"
    assert silver["6"]["push_commit_count"] is None and silver["6"]["push_id"] == 1


def test_repeated_events_can_be_dropped(rows):
    silver = rows({"event_id": "1"}, {"event_id": "1"}, {"event_id": "2"})
    assert sorted(r["event_id"] for r in S.drop_repeats(silver).collect()) == ["1", "2"]


def test_plain_times_read_as_the_pattern_reads_them_and_others_still_do(spark):
    texts = ["2024-02-29T05:06:07Z", "2023-02-29T05:06:07Z", "2024-01-01T24:00:00Z", "0000-01-01T00:00:00Z", "0001-01-01T00:00:00Z",
             "9999-12-31T23:59:59Z", "2024-01-01T05:06:07.123Z", "2024-01-01T05:06:07.123456+02:00", "2024-01-01t05:06:07z",
             "2024-01-01T05:06:07Z\n", " 2024-01-01T05:06:07Z", "+12024-01-01T05:06:07Z", "0001-01-01T00:00:00+05:00", "soon", "", "2024", None]
    rows = spark.createDataFrame([(t,) for t in texts], "created_at string")
    pattern = F.try_to_timestamp("created_at", F.lit(events.ISO_INSTANT))
    bounded = F.when(F.unix_micros(pattern).between(events.FIRST_INSTANT, events.LAST_INSTANT), pattern)
    found = rows.select(events.event_time().eqNullSafe(bounded) & events.instant_of("created_at").eqNullSafe(pattern))
    assert all(r[0] for r in found.collect())


def test_a_plain_time_is_read_without_the_pattern(spark):
    plain = F.rlike("created_at", F.lit(events.PLAIN_INSTANT))
    assert spark.createDataFrame([("2024-01-01T05:06:07Z",)], "created_at string").select(plain).first()[0]
