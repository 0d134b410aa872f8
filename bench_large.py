"""Time jobs and questions on many copies of the events, with and without broadcasts.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_TIMES=40 BENCH_CPUS=8 python bench_large.py
"""

from __future__ import annotations

import json
import os

from bench import CPUS, SF_DIR, STORED, consume, timed
from forgelake.plans import jobs
from forgelake.plans.silver import write_silver
from forgelake.session import local_session, settings, shared_folder
from forgelake.sources.lake import day_slices
from forgelake.testbed import lake
from forgelake.testbed.large import enlarged
from forgelake.testbed.queries import silver_of

TIMES = int(os.environ.get("BENCH_TIMES", "40"))


def main() -> None:
    spark = local_session(CPUS, 32)
    folder, base = enlarged(spark, SF_DIR, TIMES), shared_folder(spark, "bench")
    days = lake.span(spark, folder)
    out = {
        "events": spark.read.parquet(f"{folder}/events.parquet").count(),
        "silver": timed(lambda: write_silver(silver_of(spark, folder), f"{base}/silver", day_slices(*days))),
        "gold": timed(lambda: jobs.run_gold(spark, base, *days)),
        "gold_last_day": timed(lambda: jobs.run_gold(spark, base, days[1])),
        "marts": timed(lambda: jobs.run_marts(spark, base)),
    }
    gold = jobs.read_gold(spark, f"{base}/gold")
    for name, limit in (("questions", None), ("questions_without_broadcasts", "-1")):
        with settings(spark, {} if limit is None else {"spark.sql.autoBroadcastJoinThreshold": limit}):
            for p in STORED.values():
                consume(p(gold))
            out[name] = {n: round(timed(lambda p=p: consume(p(gold))), 2) for n, p in STORED.items()}
            out[f"{name}_sum"] = sum(out[name].values())
    print(json.dumps({k: round(v, 2) if isinstance(v, float) else v for k, v in out.items()}))


if __name__ == "__main__":
    main()
