"""Repeats of event ids: in the index, over any distance of days, in any order of runs."""

import itertools
import shutil
from datetime import date

import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from test_jobs import PUSH, content, ev
from test_sources import dump

from forgelake.operators import repeats
from forgelake.operators.silver import flatten
from forgelake.plans import jobs, silver
from forgelake.sources.bronze import read_bronze
from forgelake.sources.gold import read_gold
from forgelake.sources.lake import read_silver
from forgelake.sources.snapshot import Run, snapshot
from forgelake.streaming import ingest
from forgelake.testbed.adapter import raw_events
from forgelake.testbed.lake import forget_last_commit, write_bronze

D1, D3, FAR = date(2024, 1, 1), date(2024, 1, 3), date(2025, 2, 4)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ids_of(spark, numbers, day):
    return spark.createDataFrame([(str(n), day) for n in numbers], "event_id string, event_date date")


def test_filters_deny_nothing_that_is_there_and_little_else(spark, tmp_path):
    run = Run(spark, str(tmp_path))
    small, large = ids_of(spark, range(7), D1), ids_of(spark, range(100, 20_100), D3)
    repeats.put_ids(run, small.union(large), ["event_date=*"])
    filters = run.read(repeats.FILTERS, repeats.FILTER_TYPES)
    assert {r.level for r in filters.select("level").distinct().collect()} == {1, 13}
    there = ids_of(spark, range(100, 20_100), FAR)
    assert repeats.answering(there, filters, False).filter(F.col("other") == F.lit(D3)).count() == 20_000
    new = ids_of(spark, range(10**6, 10**6 + 50_000), FAR)
    assert repeats.answering(new, filters, False).filter(F.col("other") == F.lit(D3)).count() < 50
    found = repeats.elsewhere(run, new.union(ids_of(spark, [3, 150], FAR)), run.parts["ids"], str(tmp_path / "x"))
    assert sorted((r.event_id, str(r.other)) for r in found.collect()) == [("150", "2024-01-03"), ("3", "2024-01-01")]
    # only slices that answer are compared, and a slice is not another one to itself
    assert repeats.elsewhere(run, small, run.parts["ids"], str(tmp_path / "y")).count() <= 1
    assert repeats.elsewhere(run, small, run.parts["ids"], str(tmp_path / "z"), own_day=True).count() == 7


@pytest.fixture
def far_apart(spark, tmp_path):
    """An id in three slices, far apart; others in two hours of a slice, or alone."""
    dump(tmp_path / "landing", D1, 5, ev(1, "PushEvent", D1, PUSH | {"size": 10}), ev(2, "PushEvent", D1))
    dump(tmp_path / "landing", D1, 7, ev(2, "PushEvent", D1, PUSH | {"size": 9}), ev(3, "WatchEvent", D1, {"action": "started"}))
    dump(tmp_path / "landing", D3, 1, ev(1, "PushEvent", D1, PUSH | {"size": 11}), ev(4, "PushEvent", D3))
    dump(tmp_path / "landing", FAR, 2, ev(1, "PushEvent", D1), ev(3, "WatchEvent", D1, {"action": "started"}), ev(5, "PushEvent", FAR))
    jobs.run_bronze(spark, str(tmp_path), D1, FAR)
    return tmp_path


def stored(spark, base):
    rows = read_silver(spark, f"{base}/silver").collect()
    return sorted((r.event_id, str(r.event_date), r.push_commit_count) for r in rows)


WANTED = [("1", "2024-01-01", 10), ("2", "2024-01-01", 2), ("3", "2024-01-01", None), ("4", "2024-01-03", 2), ("5", "2025-02-04", 2)]


@pytest.mark.parametrize("order", list(itertools.permutations([D1, D3, FAR])))
def test_the_earliest_copy_stays_whatever_the_order_of_runs(spark, far_apart, order):
    changed = [silver.renew_silver(spark, str(far_apart), day).changed for day in order]
    assert stored(spark, far_apart) == WANTED
    assert [set(c) for c in changed] == [{d for d in order[:n] if d > day} for n, day in enumerate(order)]
    # again: nothing to be done to other days
    assert silver.renew_silver(spark, str(far_apart), D3).changed == []
    assert stored(spark, far_apart) == WANTED


def test_gold_follows_where_other_days_change(spark, far_apart):
    for day in (FAR, D3, D1):
        jobs.run_day(spark, str(far_apart), day)
    facts = read_gold(spark, f"{far_apart}/gold")["fact_dev_activity"].collect()
    assert sorted((r.event_id, r.date_id, r.push_commit_count) for r in facts) == [
        ("1", 20240101, 10), ("2", 20240101, 2), ("4", 20240103, 2), ("5", 20250204, 2)]


def test_an_id_that_goes_is_given_back_to_the_next_slice(spark, far_apart):
    for day in (D1, D3, FAR):
        jobs.run_silver(spark, str(far_apart), day)
    dump(far_apart / "landing", D1, 5, ev(2, "PushEvent", D1))
    jobs.run_bronze(spark, str(far_apart), D1)
    assert silver.renew_silver(spark, str(far_apart), D1).changed == [D3, FAR]
    assert stored(spark, far_apart) == [("1", "2024-01-03", 11), *WANTED[1:]]


def test_a_slice_without_bronze_still_gives_way(spark, far_apart):
    jobs.run_silver(spark, str(far_apart), FAR)
    shutil.rmtree(far_apart / "bronze" / f"event_date={FAR}")
    assert silver.renew_silver(spark, str(far_apart), D1).changed == [FAR]
    jobs.run_silver(spark, str(far_apart), D3)
    assert stored(spark, far_apart) == WANTED


def test_a_run_that_breaks_before_its_index_is_made_good(spark, far_apart, monkeypatch):
    jobs.run_silver(spark, str(far_apart), FAR)
    with monkeypatch.context() as m:
        m.setattr(Run, "publish", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.run_silver(spark, str(far_apart), D1)
    jobs.run_silver(spark, str(far_apart), D1)
    jobs.run_silver(spark, str(far_apart), D3)
    assert stored(spark, far_apart) == WANTED
    assert not any((far_apart / "staging").iterdir())


def test_the_json_is_parsed_once_and_only_ids_are_shuffled(spark, far_apart, monkeypatch):
    reads, kept = [], {}
    monkeypatch.setattr(silver, "read_bronze", lambda *a, **k: reads.append(a) or read_bronze(*a, **k))
    for name in ("verdicts", "sightings", "without_repeats"):
        made = getattr(silver, name)
        monkeypatch.setattr(silver, name, lambda *a, made=made, name=name: kept.setdefault(name, made(*a)))
    jobs.run_day(spark, str(far_apart), D1)
    assert len(reads) == 1
    events = read_bronze(spark, f"{far_apart}/bronze", D1, D1)
    text = plan(silver.numbered(silver.staged(events, True)))
    assert text.count("Scan json") == 1 and "Exchange" not in text
    for name in ("sightings", "verdicts"):
        assert "SortAggregate" not in plan(kept[name]) and "Scan json" not in plan(kept[name])
    # what moves for the sightings is the id and its day
    assert "ReadSchema: struct<core:boolean,event_id:string,event_date:date>" in plan(kept["sightings"])
    assert "Exchange hashpartitioning" not in plan(kept["without_repeats"])


def test_silver_and_quarantine_from_one_pass(spark, tmp_path):
    dump(tmp_path / "landing", D1, 5, ev(1, "PushEvent", D1), "{broken", ev(2, "PushEvent", D1, created_at="soon"),
         ev(3, "WatchEvent", D1, {"action": "started"}, actor={"id": "x", "login": "a"}))
    jobs.run_bronze(spark, str(tmp_path), D1)
    jobs.run_day(spark, str(tmp_path), D1)
    bad = spark.read.parquet(f"{tmp_path}/quarantine")
    together, kept = content(bad), {r.event_id: r.kept for r in bad.collect()}
    assert kept == {None: False, "2": False, "3": True}
    assert sorted(r.event_id for r in read_silver(spark, f"{tmp_path}/silver").collect()) == ["1", "3"]
    jobs.run_quarantine(spark, str(tmp_path), D1)
    assert content(spark.read.parquet(f"{tmp_path}/quarantine")) == together


def streamed(spark, base, **options):
    ingest.stream_to_silver(spark, f"{base}/bronze", f"{base}/streamed", f"{base}/progress", **options).awaitTermination()
    return ingest.read_streamed_silver(spark, f"{base}/streamed")


def test_the_stream_keeps_the_copy_that_arrives_first(spark, tmp_path):
    dump(tmp_path / "landing", FAR, 2, ev(1, "PushEvent", D1, PUSH | {"size": 5}), ev(5, "PushEvent", FAR))
    dump(tmp_path / "landing", D1, 5, ev(1, "PushEvent", D1), ev(2, "PushEvent", D1))
    for day in (FAR, D1):
        jobs.run_bronze(spark, str(tmp_path), day)
        rows = streamed(spark, tmp_path, dedupe=True)
    assert sorted((r.event_id, r.push_commit_count) for r in rows.collect()) == [("1", 5), ("2", 2), ("5", 2)]


def test_fifty_batches_one_run_twice_leave_few_files(spark, tmp_path):
    event = F.struct(F.col("id").cast("string").alias("id"), F.lit("PushEvent").alias("type"), F.lit("2024-01-01T05:00:00Z").alias("created_at"))
    lines = spark.range(50).select(F.to_json(event).alias("value"), F.lit(D1).alias("event_date"), F.col("id").cast("int").alias("event_hour"))
    write_bronze(lines, f"{tmp_path}/bronze")
    assert streamed(spark, tmp_path, files_per_batch=1).count() == 50
    view = snapshot(spark, f"{tmp_path}/streamed")
    assert list(view.marks.values()) == [49]
    assert len(view.parts["silver"]) <= ingest.MOST_PIECES
    forget_last_commit(spark, f"{tmp_path}/progress")
    assert streamed(spark, tmp_path, files_per_batch=1).count() == 50
    assert jobs.run_compact(spark, str(tmp_path)) == [f"event_date={D1}"]
    rows = ingest.read_streamed_silver(spark, f"{tmp_path}/streamed")
    assert sorted(int(r.event_id) for r in rows.collect()) == list(range(50)) and len(rows.inputFiles()) == 1


def test_merged_slices_still_know_their_ids(spark, tmp_path):
    for n in range(3):
        dump(tmp_path / "landing", D1, n, ev(n, "PushEvent", D1), ev(0, "PushEvent", D1))
    jobs.run_bronze(spark, str(tmp_path), D1)
    streamed(spark, tmp_path, dedupe=True, files_per_batch=1)
    assert ingest.compact(spark, f"{tmp_path}/streamed") == [f"event_date={D1}"]
    dump(tmp_path / "landing", D3, 1, ev(2, "PushEvent", D3), ev(9, "PushEvent", D3))
    jobs.run_bronze(spark, str(tmp_path), D3)
    rows = streamed(spark, tmp_path, dedupe=True)
    assert sorted(r.event_id for r in rows.collect()) == ["0", "1", "2", "9"]


def test_numbers_of_copies_order_by_hour_then_content(spark):
    events = flatten(raw_events(spark, SMALL)).limit(40)
    rows = silver.numbered(events.withColumn("event_hour", F.lit(3)).union(events.withColumn("event_hour", F.lit(None).cast("int"))))
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    decided = repeats.verdicts(rows, repeats.sightings(rows), spark.createDataFrame([], "event_id string, other date"))
    left = repeats.without_repeats(rows, decided)
    assert left.count() == 40 and left.filter("event_hour IS NULL").isEmpty()
