"""Lakes whose days arrive later than they were written."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from forgelake.functions.events import event_time
from forgelake.sources.bronze import read_bronze
from forgelake.sources.lake import folders_in
from forgelake.testbed import lake
from forgelake.testbed.queries import QUERIES

DAYS = (1, 2, 9, 16)


@pytest.fixture
def sf_dir(spark, tmp_path):
    """Events at hours 5 and 6 of a few days, one without a time."""
    times = [datetime(2024, 1, day, hour) for day in DAYS for hour in (5, 6)] + [None]
    rows = [(n, t, 1 + n % 3) for n, t in enumerate(times)]
    spark.createDataFrame(rows, "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT").write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_lines_are_made_in_one_pass_over_the_events(spark, sf_dir):
    lines = lake.refetched_lines(spark, sf_dir)
    assert lines._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
    hours = {r["event_hour"]: r["n"] for r in lines.groupBy("event_hour").agg(F.count("*").alias("n")).collect()}
    assert hours == {5: 2 * len(DAYS), 6: len(DAYS), None: 1}


def test_days_arrive_when_they_are_called(spark, sf_dir):
    base, (first, last) = lake.awaited_lake(spark, sf_dir), lake.span(spark, sf_dir)
    lake.arrive(spark, base, [])
    assert folders_in(spark, f"{base}/bronze") == {}
    lake.arrive(spark, base, [last, last.replace(day=12)])
    assert list(folders_in(spark, f"{base}/bronze")) == ["event_date=2024-01-16"]
    lake.arrive(spark, base, [first])
    assert read_bronze(spark, f"{base}/bronze").count() == 6


@pytest.mark.parametrize("name", ["stream_silver_late", "stream_repo_daily_stats"])
def test_late_weeks_are_written_once(spark, sf_dir, monkeypatch, name):
    written, write = [], lake.write_bronze
    monkeypatch.setattr(lake, "write_bronze", lambda lines, path: (written.append(path), write(lines, path)))
    rows = QUERIES[name](spark, sf_dir).collect()
    assert len(written) == 1
    if name == "stream_silver_late":
        assert sorted(r["event_id"] for r in rows if r["event_date"].day in DAYS) == sorted(r["event_id"] for r in rows)
        assert len({r["event_id"] for r in rows}) == len(rows) > 0


def test_a_time_that_is_a_timestamp_already_stays(spark):
    texts = ["2024-01-01T05:06:07Z", "2024-01-01T05:06:07.250Z", "2024-01-01 05:06:07", "0000-01-01T00:00:00Z", None]
    given = spark.createDataFrame([(t,) for t in texts], "created_at STRING")
    read = given.select(event_time().alias("t")).collect()
    assert [r["t"] and r["t"].microsecond for r in read] == [0, 250_000, None, None, None]
    stamps = given.select(F.col("created_at").try_cast("timestamp").alias("created_at")).filter("created_at > '0001-01-01'")
    assert stamps.select(event_time().alias("t")).collect() == [(r["created_at"],) for r in stamps.collect()]
    assert len(stamps.collect()) == 3
