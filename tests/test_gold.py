import random
import threading
from datetime import date

import pytest
from pyspark.sql import functions as F

from forgelake.functions.calendar import calendar_columns, date_id
from forgelake.operators import dimensions as D
from forgelake.plans import jobs
from forgelake.plans.gold import register_views, transform_to_gold
from forgelake.schemas import DIMENSIONS, FACTS
from forgelake.session import together
from forgelake.sources.snapshot import Run


def test_calendar_edges(spark):
    days = ["2024-12-29", "2024-12-30", "2025-01-01", "2021-01-03", "2024-02-29", "2024-03-31", "2024-04-01"]
    df = spark.createDataFrame([(d,) for d in days], "d STRING").select(F.to_date("d").alias("d"))
    got = {str(r["date_actual"]): r for r in df.select(*calendar_columns(F.col("d"))).collect()}
    week = {d: (r["year"], r["week_of_year"], r["iso_year"]) for d, r in got.items()}
    # The week that holds New Year: its number belongs to the ISO year, not the calendar year.
    assert week["2024-12-29"] == (2024, 52, 2024)
    assert week["2024-12-30"] == (2024, 1, 2025)
    assert week["2025-01-01"] == (2025, 1, 2025)
    assert week["2021-01-03"] == (2021, 53, 2020)
    assert [got[d]["quarter"] for d in ("2024-02-29", "2024-03-31", "2024-04-01")] == [1, 1, 2]
    assert got["2024-02-29"]["date_id"] == 20240229
    assert (got["2024-12-29"]["weekday_name"], got["2024-12-29"]["is_weekend"]) == ("Sunday", True)
    assert (got["2024-04-01"]["weekday_name"], got["2024-04-01"]["is_weekend"]) == ("Monday", False)


def test_date_id_follows_utc(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-31 23:59:59' AS t")
    assert df.select(date_id(F.col("t")).alias("d")).first()["d"] == 20240131


def test_dimension_takes_latest_known_name(rows):
    silver = rows(
        {"event_id": "1", "repo_name": "o/old", "org_id": 5, "org_login": "o"},
        {"event_id": "2", "repo_name": "o/new", "created_at": "2024-01-02 00:00:00"},
        {"event_id": "3", "repo_name": None, "created_at": "2024-01-03 00:00:00"},
    )
    gold = transform_to_gold(silver)
    # An event without an owner means that there is none any more.
    assert [tuple(r) for r in gold["dim_repo"].collect()] == [(10, "o/new", None, None)]
    assert [tuple(r) for r in gold["dim_org"].collect()] == [(5, "o", "Organization")]


def test_ties_in_time_go_to_the_greater_numeric_id(rows):
    silver = rows({"event_id": "9", "actor_login": "nine"}, {"event_id": "10", "actor_login": "ten[bot]"})
    row = transform_to_gold(silver)["dim_actor"].first()
    assert (row["actor_login"], row["actor_type"]) == ("ten[bot]", "Bot")


def test_first_seen_is_the_earliest_event(rows):
    silver = rows({"created_at": "2024-01-05 00:00:00"}, {"created_at": "2024-01-02 03:04:05"})
    assert str(transform_to_gold(silver)["dim_actor"].first()["first_seen_at"]) == "2024-01-02 03:04:05"


@pytest.mark.parametrize("seed", range(3))
def test_dimensions_from_daily_states_equal_those_from_all_events(rows, seed):
    rng = random.Random(seed)
    silver = rows(*[
        {"event_id": str(rng.randrange(10**6)), "actor_id": rng.randrange(6),
         "actor_login": rng.choice(["a", "b", "c[bot]", None]), "repo_id": rng.randrange(5),
         "repo_name": rng.choice(["x", "y", None]), "org_id": rng.choice([1, 2, None]),
         "org_login": rng.choice(["p", "q", None]),
         "created_at": f"2024-01-{rng.randrange(1, 6):02d} 00:00:0{rng.randrange(3)}"}
        for _ in range(120)
    ])
    for state, dim in ((D.actor_state, D.dim_actor), (D.repo_state, D.dim_repo), (D.org_state, D.dim_org)):
        whole, daily = dim(state(silver)), dim(state(silver, "event_date"))
        assert sorted(whole.collect(), key=str) == sorted(daily.collect(), key=str)


def test_facts_have_the_documented_columns(rows):
    gold = transform_to_gold(rows({"event_type": "PushEvent"}))
    for name, spec in FACTS.items():
        assert {c: t.upper() for c, t in gold[name].dtypes} == spec["columns"]
    for name, columns in DIMENSIONS.items():
        assert {c: t.upper() for c, t in gold[name].dtypes} == columns


def test_comments_are_in_two_facts_and_nothing_else_is(rows):
    kinds = [t for spec in FACTS.values() for t in spec["types"]]
    gold = transform_to_gold(rows(*[{"event_type": t} for t in sorted(set(kinds))]))
    ids = {n: {(r["event_id"], r["event_type"]) for r in gold[n].collect()} for n in FACTS}
    assert {t for _, t in ids["fact_community"] & ids["fact_issue_lifecycle"]} == {"IssueCommentEvent"}
    assert not ids["fact_dev_activity"] & (ids["fact_community"] | ids["fact_issue_lifecycle"])
    assert sum(len(x) for x in ids.values()) == 9


def test_numbers_too_large_for_the_fact_become_null(rows):
    silver = rows({"event_type": "PushEvent", "push_commit_count": 2**40})
    assert transform_to_gold(silver)["fact_dev_activity"].first()["push_commit_count"] is None


def test_languages_are_an_optional_join(spark, rows):
    repos = transform_to_gold(rows({"repo_id": 1}, {"repo_id": 2}))["dim_repo"]
    known = spark.createDataFrame([(1, "Scala")], "repo_id BIGINT, primary_language STRING")
    enriched = D.with_languages(repos, known)
    assert enriched.columns == repos.columns
    assert {r["repo_id"]: r["primary_language"] for r in enriched.collect()} == {1: "Scala", 2: None}


def test_views_answer_sql_with_parameters(rows):
    gold = transform_to_gold(rows(
        {"event_type": "PushEvent", "push_commit_count": 2},
        {"event_type": "PushEvent", "push_commit_count": 3, "actor_id": 2, "actor_login": "bob"},
    ))
    spark = register_views(gold)
    text = """SELECT a.actor_login, SUM(f.push_commit_count) AS commits
              FROM Fact_DevActivity f JOIN Dim_Actor a ON f.actor_id = a.actor_id
              JOIN Dim_Date d ON f.date_id = d.date_id
              WHERE a.actor_login = :who AND d.date_actual >= :since GROUP BY a.actor_login"""
    found = spark.sql(text, args={"who": "bob", "since": date(2023, 12, 1)}).collect()
    assert [tuple(r) for r in found] == [("bob", 3)]


def test_tables_of_a_run_are_written_side_by_side(rows, tmp_path, monkeypatch):
    meeting, put = threading.Barrier(len(FACTS) + len(jobs.STATES)), Run.put

    def meet(self, table, *args, **options):
        if table in FACTS or table in jobs.STATES:
            meeting.wait(60)
        return put(self, table, *args, **options)

    monkeypatch.setattr(Run, "put", meet)
    day = date(2024, 1, 1)
    gold = jobs.write_gold(rows({"event_type": "PushEvent"}, {"event_type": "WatchEvent"}), str(tmp_path), day, day)
    assert gold["fact_dev_activity"].count() == gold["fact_community"].count() == gold["dim_repo"].count() == 1


def test_all_steps_are_waited_for_and_an_error_is_raised(spark):
    done = []
    with pytest.raises(ZeroDivisionError):
        together(spark, lambda: 1 / 0, lambda: done.append(spark.range(3).count()))
    assert done == [3]
