import json
import os
import shutil
from datetime import date

import pytest
from pyspark.sql import functions as F
from test_silver import event
from test_sources import dump

from forgelake.__main__ import main
from forgelake.operators.silver import flatten, of_type
from forgelake.plans import analytics, jobs, marts
from forgelake.plans.gold import transform_to_gold
from forgelake.schemas import FACTS
from forgelake.session import room_for, settings, shared_folder
from forgelake.sources.bronze import read_bronze, read_bronze_dated
from forgelake.sources.gold import read_gold
from forgelake.sources.lake import read_silver, read_silver_dated
from forgelake.sources.snapshot import KEPT_VERSIONS, Run, snapshot
from forgelake.streaming.ingest import read_streamed_silver, stream_to_silver

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
PUSH = {"push_id": 1, "size": 2, "ref": "refs/heads/main"}


def ev(n, kind, day, payload=None, **more):
    more.setdefault("created_at", f"{day}T05:00:00Z")
    return event(n, kind, PUSH if payload is None else payload, **more)


@pytest.fixture
def base(tmp_path):
    dump(tmp_path / "landing", D1, 5, ev(1, "PushEvent", D1), ev(2, "WatchEvent", D1, {"action": "started"}))
    dump(tmp_path / "landing", D2, 5, ev(3, "PushEvent", D2), ev(4, "GollumEvent", D2),
         ev(5, "ForkEvent", D2, {"forkee": {"id": 9, "full_name": "a/b"}}))
    return tmp_path


def content(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def all_gold(spark, base):
    return {name: content(df) for name, df in read_gold(spark, f"{base}/gold").items()}


def test_days_one_by_one_equal_one_range(spark, base):
    jobs.run_bronze(spark, str(base), D1, D2)
    for day in (D2, D1, D1):
        jobs.run_day(spark, str(base), day)
    stepwise = all_gold(spark, base)
    assert [len(stepwise[n]) for n in ("dim_date", "fact_dev_activity", "fact_community")] == [2, 2, 2]
    jobs.run_day(spark, str(base), D1, D2)
    assert all_gold(spark, base) == stepwise
    silver = read_silver(spark, f"{base}/silver")
    assert {n: content(df) for n, df in transform_to_gold(silver).items()} == stepwise
    assert content(silver.drop("event_date")) == content(
        flatten(read_bronze(spark, f"{base}/bronze")).drop("event_date")
    )


def test_rerun_forgets_what_the_slice_no_longer_has(spark, base):
    jobs.run_bronze(spark, str(base), D1, D2)
    jobs.run_day(spark, str(base), D1, D2)
    # The day comes again with its only fork gone, then with no known event at all.
    dump(base / "landing", D2, 5, ev(3, "PushEvent", D2))
    jobs.run_bronze(spark, str(base), D2)
    jobs.run_day(spark, str(base), D2)
    gold = read_gold(spark, f"{base}/gold")
    assert [r["event_id"] for r in gold["fact_community"].collect()] == ["2"]
    dump(base / "landing", D2, 5, ev(4, "GollumEvent", D2))
    jobs.run_bronze(spark, str(base), D2)
    jobs.run_day(spark, str(base), D2)
    gold = read_gold(spark, f"{base}/gold")
    assert [r["event_id"] for r in gold["fact_dev_activity"].collect()] == ["1"]
    assert [r["date_id"] for r in gold["dim_date"].collect()] == [20240101]
    assert read_silver(spark, f"{base}/silver", D2, D2).isEmpty()


def test_a_stray_event_replaces_nothing_of_its_own_day(spark, base):
    # The dump of day 2 holds an event stamped on day 1.
    dump(base / "landing", D2, 0, ev(6, "PushEvent", D1))
    jobs.run_bronze(spark, str(base), D1, D2)
    jobs.run_day(spark, str(base), D1)
    for _ in range(2):
        jobs.run_day(spark, str(base), D2)
    facts = read_gold(spark, f"{base}/gold")["fact_dev_activity"]
    assert sorted((r["event_id"], r["date_id"]) for r in facts.collect()) == [
        ("1", 20240101), ("3", 20240102), ("6", 20240101)]
    # Once the stray is gone from its slice, the partition it had there goes too.
    dump(base / "landing", D2, 0)
    jobs.run_bronze(spark, str(base), D2)
    jobs.run_day(spark, str(base), D2)
    facts = read_gold(spark, f"{base}/gold")["fact_dev_activity"]
    assert sorted(r["event_id"] for r in facts.collect()) == ["1", "3"]


def test_gold_without_any_organisation(spark, tmp_path):
    dump(tmp_path / "landing", D1, 5, ev(1, "PushEvent", D1, org=...))
    main(["bronze", "--base", str(tmp_path), "--year", "2024", "--month", "1", "--day", "1"])
    jobs.run_day(spark, str(tmp_path), D1)
    assert read_gold(spark, f"{tmp_path}/gold")["dim_org"].isEmpty()


def test_quarantine_dedupe_and_marts(spark, tmp_path):
    dump(tmp_path / "landing", D1, 5, ev(1, "PushEvent", D1), ev(1, "PushEvent", D1), "{broken")
    jobs.run_bronze(spark, str(tmp_path), D1)
    for _ in range(2):
        jobs.run_quarantine(spark, str(tmp_path), D1)
        bad = spark.read.parquet(f"{tmp_path}/quarantine").collect()
        assert [(r["line"], r["kept"], str(r["event_date"])) for r in bad] == [("{broken", False, "2024-01-01")]
    assert jobs.run_silver(spark, str(tmp_path), D1, dedupe=False) == 2
    assert read_silver(spark, f"{tmp_path}/silver").count() == 2
    assert jobs.run_silver(spark, str(tmp_path), D1) == 1
    assert read_silver(spark, f"{tmp_path}/silver").count() == 1
    jobs.run_gold(spark, str(tmp_path), D1)
    stats = jobs.run_marts(spark, str(tmp_path))["mart_repo_daily_stats"].collect()
    assert [tuple(r) for r in stats] == [(10, 20240101, 2, 0, 0)]


def test_command_line_runs_a_range(spark, base):
    for job in ("bronze", "silver", "gold", "marts"):
        main([job, "--base", str(base), "--from", "2024-01-01", "--to", "2024-01-02"])
    gold = read_gold(spark, f"{base}/gold")
    assert analytics.monthly_commits(gold).first()["total_commits"] == 4
    with pytest.raises(SystemExit):
        main(["silver", "--base", str(base), "--year", "2024"])


def test_old_silver_without_a_column_reads_as_null(spark, base):
    jobs.run_bronze(spark, str(base), D1, D2)
    jobs.run_silver(spark, str(base), D1)
    day = spark.read.parquet(f"{base}/silver/event_date=2024-01-01").drop("watch_action")
    day.write.parquet(f"{base}/silver/event_date=2024-01-03")
    jobs.run_silver(spark, str(base), D2)
    got = read_silver(spark, f"{base}/silver").filter("event_type = 'WatchEvent'").collect()
    assert {str(r["event_date"]): r["watch_action"] for r in got} == {"2024-01-01": "started", "2024-01-03": None}


def test_stored_facts_prune_by_day_and_push_the_type(spark, base):
    jobs.run_bronze(spark, str(base), D1, D2)
    jobs.run_day(spark, str(base), D1, D2)
    gold = read_gold(spark, f"{base}/gold")
    top = analytics.top_pushers(gold, as_of=date(2024, 2, 1))
    scans = top._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date_id" in scans
    assert "EqualTo(event_type,PushEvent)" in scans
    silver = read_silver(spark, f"{base}/silver", D1, D1)
    assert "PartitionFilters: [isnotnull(event_date" in silver._jdf.queryExecution().toString()


def test_stream_equals_batch_and_catches_up(spark, base):
    def run(**options):
        query = stream_to_silver(spark, f"{base}/bronze", f"{base}/streamed", f"{base}/progress", **options)
        query.awaitTermination()
        return read_streamed_silver(spark, f"{base}/streamed")

    jobs.run_bronze(spark, str(base), D1)
    assert run(files_per_batch=1).count() == 2
    jobs.run_bronze(spark, str(base), D2)
    jobs.run_silver(spark, str(base), D1, D2)
    batch = read_silver(spark, f"{base}/silver")
    assert content(run()) == content(batch)
    # Nothing new: nothing stored twice.
    assert content(run()) == content(batch)


def test_stream_drops_an_hour_fetched_twice(spark, base):
    dump(base / "landing", D1, 6, ev(1, "PushEvent", D1), ev(7, "PushEvent", D1))
    jobs.run_bronze(spark, str(base), D1)
    query = stream_to_silver(
        spark, f"{base}/bronze", f"{base}/streamed", f"{base}/progress", dedupe=True, files_per_batch=1
    )
    query.awaitTermination()
    got = read_streamed_silver(spark, f"{base}/streamed")
    assert sorted(r["event_id"] for r in got.collect()) == ["1", "2", "7"]


def test_silver_files_hold_sorted_types(spark, base):
    jobs.run_bronze(spark, str(base), D1, D2)
    jobs.run_silver(spark, str(base), D1, D2)
    silver = read_silver(spark, f"{base}/silver").select("event_type", F.input_file_name().alias("file"))
    files = {}
    for r in silver.collect():
        files.setdefault(r["file"], []).append(r["event_type"])
    assert all(types == sorted(types) for types in files.values())
    assert set(FACTS) <= set(jobs.write_gold(read_silver(spark, f"{base}/silver"), f"{base}/gold", D1, D2))


def test_marts_by_day_equal_marts_at_once(spark, base):
    # A stray makes two slices share a key.
    dump(base / "landing", D2, 0, ev(6, "PushEvent", D1))
    jobs.run_bronze(spark, str(base), D1, D2)
    jobs.run_day(spark, str(base), D1, D2)
    for day in (D2, D1, D2):
        stored = jobs.run_marts(spark, str(base), day)
    def sizes(marts):  # of sketches, what they estimate
        reach = marts["mart_org_reach"].withColumn("actors", F.hll_sketch_estimate("actors"))
        return {n: content(df) for n, df in {**marts, "mart_org_reach": reach}.items()}

    stepwise = sizes(stored)
    assert sizes(jobs.run_marts(spark, str(base))) == stepwise
    gold = read_gold(spark, f"{base}/gold")
    fresh = {n: getattr(marts, n.removeprefix("mart_"))(gold) for n in marts.STORED}
    assert sizes(fresh) == stepwise
    assert stepwise["mart_repo_daily_stats"][0].startswith("Row(date_id=20240101, repo_id=10, total_commits=4")


def test_gold_from_streamed_silver(spark, base):
    jobs.run_bronze(spark, str(base), D1, D2)
    stream_to_silver(spark, f"{base}/bronze", f"{base}/streamed", f"{base}/progress").awaitTermination()
    jobs.run_gold(spark, str(base), D1, D2, streamed=True)
    streamed = all_gold(spark, base)
    jobs.run_day(spark, str(base), D1, D2)
    assert all_gold(spark, base) == streamed


def test_job_settings_are_given_back(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    with room_for(spark, 64 * 2**20 * 2_000_000):
        assert spark.conf.get(key) == "2000000"
    assert spark.conf.get(key, None) is None
    with room_for(spark, 10**6):
        assert spark.conf.get(key, None) is None
    spark.conf.set(key, "3000000")
    with room_for(spark, 10**14):
        assert spark.conf.get(key) == "3000000"
    assert spark.conf.get(key) == "3000000"
    spark.conf.unset(key)


def test_intermediate_tables_go_to_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark, "x").startswith(shared + "/x-")


def test_dated_layouts_are_read(spark, tmp_path):
    folder = tmp_path / "bronze" / "2024" / "01" / "01"
    folder.mkdir(parents=True)
    events = [ev(1, "PushEvent", D1), ev(2, "WatchEvent", D1, {"action": "started"})]
    (folder / "05.json").write_text("".join(json.dumps(e) + "\n" for e in events))
    main(["silver", "--base", str(tmp_path), "--year", "2024", "--month", "1", "--day", "1", "--dated"])
    silver = read_silver(spark, f"{tmp_path}/silver", D1, D1)
    # The same rows as a table per type, without the columns that such tables lack.
    for kind in ("PushEvent", "WatchEvent"):
        rows = of_type(silver, kind).withColumn("created_at", F.lit("2024-01-01T05:00:00Z"))
        rows.drop("org_login").write.parquet(f"{tmp_path}/tables/{kind}/2024/01/01")
    again = read_silver_dated(spark, f"{tmp_path}/tables", D1, D2)
    assert content(again) == content(silver.withColumn("org_login", F.lit(None).cast("string")))
    with pytest.raises(ValueError, match="nothing in"):
        read_silver_dated(spark, f"{tmp_path}/tables", D2, D3)


def test_an_hour_missing_from_landing_keeps_its_bronze(spark, base):
    dump(base / "landing", D1, 6, ev(7, "PushEvent", D1))
    assert jobs.run_bronze(spark, str(base), D1) == 3
    (base / "landing" / f"{D1}-5.json.gz").unlink()
    assert jobs.run_bronze(spark, str(base), D1) == 1
    assert sorted(r["id"] for r in read_bronze(spark, f"{base}/bronze").collect()) == ["1", "2", "7"]


def test_a_day_missing_from_bronze_stops_the_run(spark, base):
    jobs.run_bronze(spark, str(base), D1, D2)
    jobs.run_day(spark, str(base), D1, D2)
    before = all_gold(spark, base)
    shutil.rmtree(base / "bronze" / f"event_date={D1}")
    for days in ((D1, D1), (D1, D2)):
        with pytest.raises(ValueError, match=f"event_date={D1}"):
            jobs.run_day(spark, str(base), *days)
    assert read_silver(spark, f"{base}/silver", D1, D1).count() == 2
    assert all_gold(spark, base) == before
    # Days that silver has not are no days for gold, but no error either.
    jobs.run_gold(spark, str(base), D3)
    assert all_gold(spark, base) == before


def test_a_folder_left_empty_by_a_broken_run_harms_nothing(spark, base):
    jobs.run_bronze(spark, str(base), D1, D2)
    (base / "silver" / f"event_date={D1}").mkdir(parents=True)
    jobs.run_silver(spark, str(base), D1, D2)
    assert sorted(r["event_id"] for r in read_silver(spark, f"{base}/silver").collect()) == ["1", "2", "3", "5"]


def test_stream_takes_late_stray_and_old_files(spark, base):
    dump(base / "landing", D1, 6, ev(8, "PushEvent", D1) | {"created_at": "9998-01-01T00:00:00Z"})
    dump(base / "landing", D3, 5, ev(9, "PushEvent", D3), ev(3, "PushEvent", D3))

    def stream(day):
        jobs.run_bronze(spark, str(base), day)
        if day == D1:
            for f in (base / "bronze").rglob("part-*"):
                if f"event_date={D1}" in str(f):
                    os.utime(f, (1, 1))
        jobs.run_stream(spark, str(base))

    for day in (D3, D1, D2):
        stream(day)
    got = read_streamed_silver(spark, f"{base}/streamed")
    assert sorted(r["event_id"] for r in got.collect()) == ["1", "2", "3", "5", "8", "9"]


def test_a_repeat_across_midnight_goes_whatever_the_range(spark, base):
    dump(base / "landing", D2, 0, ev(1, "PushEvent", D1), ev(6, "PushEvent", D2))
    dump(base / "landing", D3, 0, ev(1, "PushEvent", D1))
    jobs.run_bronze(spark, str(base), D1, D3)
    jobs.run_silver(spark, str(base), D1, D3)
    at_once = content(read_silver(spark, f"{base}/silver"))
    assert len(at_once) == 5
    for day in (D3, D1, D2, D2):
        jobs.run_silver(spark, str(base), day)
    assert content(read_silver(spark, f"{base}/silver")) == at_once


def broken_gold(spark, base, first, last):
    """A gold run that breaks off when the facts have been written and the organisations are counted."""
    silver = read_silver(spark, f"{base}/silver", first, last).filter("event_type <> 'PushEvent'")
    with pytest.raises(Exception, match="out of space"):
        jobs.write_gold(silver.withColumn("org_login", F.raise_error(F.lit("out of space")).cast("string")),
                        f"{base}/gold", first, last)


def test_a_broken_run_changes_nothing(spark, base):
    jobs.run_bronze(spark, str(base), D1, D2)
    jobs.run_day(spark, str(base), D1, D2)
    jobs.run_marts(spark, str(base))
    before, marts_before = all_gold(spark, base), {n: content(m) for n, m in jobs.read_marts(spark, str(base)).items()}
    version = snapshot(spark, f"{base}/gold").version
    broken_gold(spark, base, D1, D2)
    assert len(list((base / "gold" / "fact_community").glob("run=*"))) == 2
    assert all_gold(spark, base) == before and snapshot(spark, f"{base}/gold").version == version
    # the next run takes no notice of what was left, and clears it away
    jobs.run_gold(spark, str(base), D1)
    assert all_gold(spark, base) == before
    named = snapshot(spark, f"{base}/gold").folders()
    left = {"/".join(p.relative_to(base / "gold").parts) for p in (base / "gold" / "fact_community").glob("run=*/event_date=*")}
    old = {f for f in left if f not in named}
    assert all((base / "gold" / f).exists() for f in named) and len(old) == 1  # the slice that a reader may still hold
    assert {n: content(m) for n, m in jobs.read_marts(spark, str(base)).items()} == marts_before


def test_a_reader_keeps_the_version_that_it_opened(spark, base):
    jobs.run_bronze(spark, str(base), D1, D2)
    jobs.run_day(spark, str(base), D1, D2)
    opened, before = read_gold(spark, f"{base}/gold"), all_gold(spark, base)
    # both days come again, with other content: two more versions, and the marts
    dump(base / "landing", D1, 5, ev(20, "PushEvent", D1, repo={"id": 77, "name": "new/name"}))
    dump(base / "landing", D2, 5)
    jobs.run_bronze(spark, str(base), D1, D2)
    jobs.run_day(spark, str(base), D1, D2)
    jobs.run_marts(spark, str(base))
    assert {name: content(df) for name, df in opened.items()} == before
    assert [r["repo_id"] for r in read_gold(spark, f"{base}/gold")["dim_repo"].collect()] == [77]
    for _ in range(KEPT_VERSIONS):
        jobs.run_gold(spark, str(base), D1)
    assert len(list((base / "gold" / "dim_repo").glob("run=*"))) == KEPT_VERSIONS
    assert len(list((base / "gold" / "_manifest").glob("*.json"))) == KEPT_VERSIONS


def test_two_runs_at_once_do_not_lose_one(spark, base):
    jobs.run_bronze(spark, str(base), D1, D2)
    jobs.run_day(spark, str(base), D1, D2)
    before = all_gold(spark, base)
    late = Run(spark, f"{base}/gold")
    jobs.run_gold(spark, str(base), D1)
    late.drop("fact_dev_activity", [f"event_date={D1}"])
    with pytest.raises(RuntimeError, match="another run"):
        late.publish()
    assert all_gold(spark, base) == before


def test_marts_renew_only_what_a_day_touches(spark, tmp_path):
    days = [date(2024, 1, 30), date(2024, 2, 1), date(2024, 2, 2)]
    far = 5 << 20
    for n, day in enumerate(days):
        issue = [{"action": "opened", "issue": {"id": far * (n % 2) + 1}}, {"action": "closed", "issue": {"id": far * (n % 2) + 1}}]
        dump(tmp_path / "landing", day, 5, ev(n, "PushEvent", day), ev(n + 50, "IssuesEvent", day, issue[n // 2]))
    jobs.run_bronze(spark, str(tmp_path), days[0], days[-1])
    for day in (date(2024, 1, 30), date(2024, 2, 1), date(2024, 2, 2)):
        jobs.run_day(spark, str(tmp_path), day)
        jobs.run_marts(spark, str(tmp_path), day)
    now, root = snapshot(spark, f"{tmp_path}/gold"), tmp_path / "gold"
    run_of = {n: {p: f.split("/")[1][:10] for p, f in now.parts[n].items()} for n in marts.STORED}
    # days 1 and 3 speak of the issue in the first bucket, day 2 of the one far off
    assert run_of["mart_issue_resolution"] == {"bucket=0": "run=000006", "bucket=5": "run=000004"}
    assert run_of["mart_org_reach"] == {}
    assert run_of["mart_repo_daily_stats"] == {"date_id=20240130": "run=000002", "date_id=20240201": "run=000004", "date_id=20240202": "run=000006"}
    assert run_of["mart_developer_activity"] == {"month_id=202401": "run=000002", "month_id=202402": "run=000006"}
    # what a day does not touch need not even be there
    for piece in ("bucket=5", "month_id=202401"):
        for table in now.parts:
            if piece in now.parts[table] and table.endswith("_shares"):
                shutil.rmtree(root / now.parts[table][piece])
    dump(tmp_path / "landing", days[2], 5, ev(2, "PushEvent", days[2]))
    jobs.run_bronze(spark, str(tmp_path), days[2])
    jobs.run_day(spark, str(tmp_path), days[2])
    jobs.run_marts(spark, str(tmp_path), days[2])
    again = snapshot(spark, f"{tmp_path}/gold")
    issues = again.read("mart_issue_resolution", marts.MART_TYPES["mart_issue_resolution"], ["bucket=0"]).collect()
    assert [(r.issue_id, str(r.opened_at), r.closed_at) for r in issues] == [(1, "2024-01-30 05:00:00", None)]
    # reading is a scan
    plan = jobs.read_marts(spark, str(tmp_path))["mart_developer_activity"]._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan


def test_base_folders_may_look_like_days(spark, tmp_path):
    folder = tmp_path / "2023" / "05" / "06" / "bronze" / "2024" / "01" / "01"
    folder.mkdir(parents=True)
    (folder / "05.json").write_text(json.dumps(ev(1, "PushEvent", D1)) + "\n")
    events = read_bronze_dated(spark, f"{tmp_path}/2023/05/06/bronze", D1, D1).collect()
    assert [(str(r["event_date"]), r["event_hour"]) for r in events] == [("2024-01-01", 5)]


@pytest.mark.parametrize("line", [
    "gold --hour 5", "marts --dated", "quarantine --keep-repeats", "stream --year 2024", "day --streamed",
    "silver --from 2024-01-01 --day 3", "marts --to 2024-01-01",
])
def test_options_that_a_job_does_not_know_are_errors(line):
    job, *rest = line.split()
    days = [] if job in ("marts", "stream") or "--from" in rest else ["--year", "2024", "--month", "1", "--day", "1"]
    with pytest.raises(SystemExit):
        main([job, "--base", "x", *days, *rest])


def test_command_line_streams(spark, base):
    jobs.run_bronze(spark, str(base), D1)
    main(["stream", "--base", str(base)])
    assert read_streamed_silver(spark, f"{base}/streamed").count() == 2
    main(["day", "--base", str(base), "--year", "2024", "--month", "1", "--day", "1", "--keep-repeats"])


def test_days_do_not_follow_the_session_zone(spark, base):
    dump(base / "landing", D2, 6,
         ev(11, "IssuesEvent", D1, {"action": "opened", "issue": {"id": 1}}, created_at="2024-01-01T07:30:00Z"),
         ev(12, "IssuesEvent", D2, {"action": "closed", "issue": {"id": 1}}, created_at="2024-01-02T00:30:00Z"))
    jobs.run_bronze(spark, str(base), D1, D2)
    jobs.run_day(spark, str(base), D1, D2)
    want = {n: content(df) for n, df in transform_to_gold(read_silver(spark, f"{base}/silver")).items()}
    with settings(spark, {"spark.sql.session.timeZone": "America/Los_Angeles"}):
        gold = read_gold(spark, f"{base}/gold")
        assert analytics.avg_days_to_close(gold).first()["avg_days_to_close"] == 1.0
        fresh = transform_to_gold(flatten(read_bronze(spark, f"{base}/bronze")))
        for name in ("dim_date", "fact_issue_lifecycle"):
            days = [c for c in ("date_id", "date_actual", "event_id") if c in fresh[name].columns]
            assert content(fresh[name].select(*days)) == content(gold[name].select(*days))
    assert len(want["dim_date"]) == 2


def test_months_that_have_ended_are_kept_merged(spark, tmp_path):
    days = [date(2024, 1, 30), date(2024, 1, 31), date(2024, 2, 1), date(2024, 2, 29), date(2024, 3, 1)]
    for n, day in enumerate(days):
        issue = {"action": ["opened", "closed"][n % 2], "issue": {"id": n // 3}}
        dump(tmp_path / "landing", day, 5, ev(n, "PushEvent", day, actor={"id": n % 2, "login": f"a{n}"}),
             ev(n + 50, "IssuesEvent", day, issue))
        jobs.run_bronze(spark, str(tmp_path), day)
        jobs.run_day(spark, str(tmp_path), day)
        gold = read_gold(spark, f"{tmp_path}/gold")
        fresh = transform_to_gold(flatten(read_bronze(spark, f"{tmp_path}/bronze")))
        assert {k: content(v) for k, v in gold.items()} == {k: content(v) for k, v in fresh.items()}
    view = snapshot(spark, f"{tmp_path}/gold")
    assert set(view.parts["state_actor_upto"]) == {"upto=2024-02-01", "upto=2024-03-01"}
    # The daily run reads the merged table and the month's own days, nothing before.
    for name in ("state_actor", "state_repo"):
        read = {tuple(f.split("/gold/")[1].split("/")[:3:2]) for f in jobs.read_state(view, name).inputFiles()}
        assert read == {(f"{name}_upto", "upto=2024-03-01"), (name, "event_date=2024-03-01")}
    # A day of a merged month comes again without its event.
    jobs.run_marts(spark, str(tmp_path))
    dump(tmp_path / "landing", days[1], 5, ev(9, "GollumEvent", days[1]))
    jobs.run_bronze(spark, str(tmp_path), days[1])
    jobs.run_day(spark, str(tmp_path), days[1])
    jobs.run_marts(spark, str(tmp_path), days[1])
    gold = read_gold(spark, f"{tmp_path}/gold")
    fresh = transform_to_gold(flatten(read_bronze(spark, f"{tmp_path}/bronze")))
    assert {k: content(v) for k, v in gold.items()} == {k: content(v) for k, v in fresh.items()}
    jobs.run_day(spark, str(tmp_path), days[-1])
    assert all_gold(spark, tmp_path) == {k: content(v) for k, v in fresh.items()}
    stored = jobs.run_marts(spark, str(tmp_path), days[-1])["mart_issue_resolution"]
    assert content(stored) == content(marts.issue_resolution(fresh))


def test_one_developer_is_found_by_reading_few_rows(spark, tmp_path):
    events = [ev(n, "PushEvent", D1, actor={"id": n % 500 * 2, "login": f"dev-{n % 500 * 2}"}) for n in range(20_000)]
    dump(tmp_path / "landing", D1, 5, *events)
    jobs.run_bronze(spark, str(tmp_path), D1)
    jobs.run_silver(spark, str(tmp_path), D1)
    small = {"parquet.block.size": "65536", "parquet.page.size": "4096", "parquet.page.row.count.limit": "500"}
    jobs.FACT_OPTIONS.update(small)
    try:
        gold = jobs.run_gold(spark, str(tmp_path), D1)
    finally:
        for key in small:
            jobs.FACT_OPTIONS.pop(key)
    found = analytics.developer_lookup(gold, "dev-154")
    assert [tuple(r) for r in found.collect()] == [("dev-154", 80, 0, 0)]
    assert analytics.developer_lookup(gold, "nobody").collect() == []
    def read(actor):
        rows = gold["fact_dev_activity"].filter(f"actor_id = {actor} AND event_type = 'PushEvent'").select("push_commit_count")
        rows.collect()
        scan = rows._jdf.queryExecution().executedPlan()
        while not scan.nodeName().startswith("Scan parquet"):
            scan = scan.executedPlan() if scan.nodeName() == "AdaptiveSparkPlan" else scan.children().head()
        return scan.metrics().apply("numOutputRows").value()

    # of 20,000 rows the scan gives only those of the row groups and pages that may have the actor
    assert 40 <= read(154) < 2_000
    # an actor between others, whom the ranges of the files do not deny, is denied by the Bloom filters
    assert read(155) == 0


def test_dated_folders_are_listed_by_month(spark, tmp_path, monkeypatch):
    from forgelake.sources import lake

    for day in (date(2024, 1, 30), date(2024, 1, 31), date(2024, 2, 1)):
        (tmp_path / f"{day:%Y/%m/%d}").mkdir(parents=True)
    asked, path = [], lake.hadoop_path
    monkeypatch.setattr(lake, "hadoop_path", lambda s, p: asked.append(p) or path(s, p))
    found = lake.dated_folders(spark, str(tmp_path), date(2024, 1, 1), date(2024, 2, 29))
    assert [f[-10:] for f in found] == ["2024/01/30", "2024/01/31", "2024/02/01"] and len(asked) == 2
    with pytest.raises(ValueError, match="2024-01-29"):
        lake.dated_folders(spark, str(tmp_path), date(2024, 1, 29), date(2024, 1, 31), all_days=True)
