"""Command line of the jobs, for spark-submit or a scheduler.

    python -m forgelake silver --base <folder> --year 2024 --month 1 --day 31
    python -m forgelake gold --base <folder> --from 2024-01-01 --to 2024-01-31
    python -m forgelake stream --base <folder>
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from forgelake.plans import jobs
from forgelake.plans.silver import renew_silver

# Which options a job knows besides its days; any other is an error, not ignored.
OPTIONS = {
    "bronze": {"hour"},
    "silver": {"keep_repeats", "dated"},
    "quarantine": set(),
    "gold": {"streamed"},
    "marts": set(),
    "day": {"keep_repeats", "dated"},
    "stream": {"keep_repeats", "with_marts"},
    "compact": set(),
}
NO_DAYS = {"stream", "compact"}
DAYS_OPTIONAL = {"marts"}


def parsed(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="forgelake", description=__doc__)
    parser.add_argument("job", choices=list(OPTIONS))
    parser.add_argument("--base", required=True, help="folder of landing, bronze, silver, gold")
    parser.add_argument("--year", type=int)
    parser.add_argument("--month", type=int)
    parser.add_argument("--day", type=int)
    parser.add_argument("--from", dest="first", type=date.fromisoformat)
    parser.add_argument("--to", dest="last", type=date.fromisoformat)
    parser.add_argument("--hour", type=int, help="bronze: one hour of the day")
    parser.add_argument("--keep-repeats", action="store_true", help="silver, day, stream: do not drop repeated events")
    parser.add_argument("--dated", action="store_true", help="silver, day: bronze in YYYY/MM/DD/HH.json")
    parser.add_argument("--with-marts", action="store_true", help="stream: add to the additive marts too")
    parser.add_argument("--streamed", action="store_true", help="gold: from streamed silver")
    args = parser.parse_args(argv)
    given = {name for name in ("hour", "keep_repeats", "dated", "streamed", "with_marts") if getattr(args, name) not in (None, False)}
    if given - OPTIONS[args.job]:
        parser.error(f"{args.job} takes no " + ", ".join(f"--{n.replace('_', '-')}" for n in sorted(given - OPTIONS[args.job])))
    parts = (args.year, args.month, args.day)
    if args.first and any(p is not None for p in parts):
        parser.error("give --year --month --day, or --from and --to")
    if not args.first and None not in parts:
        args.first = date(*parts)
    if args.job in NO_DAYS:
        if args.first or args.last or any(p is not None for p in parts):
            parser.error(f"{args.job} takes no days")
    elif not args.first and (args.job not in DAYS_OPTIONAL or args.last or any(p is not None for p in parts)):
        parser.error("give --year --month --day, or --from and --to")
    return args


def main(argv: list[str] | None = None) -> None:
    args = parsed(argv)
    spark = SparkSession.builder.appName(f"forgelake-{args.job}").getOrCreate()
    days = (spark, args.base, args.first, args.last)
    if args.job == "bronze":
        print(f"{jobs.run_bronze(*days, args.hour)} lines landed")
    elif args.job == "silver":
        renewed = renew_silver(*days, not args.keep_repeats, args.dated)
        print(f"{renewed.rows} events stored", *[f"changed too: {d}" for d in renewed.changed], sep="\n")
    elif args.job == "quarantine":
        jobs.run_quarantine(*days)
    elif args.job == "gold":
        jobs.run_gold(*days, args.streamed)
    elif args.job == "marts":
        jobs.run_marts(*days)
    elif args.job == "day":
        jobs.run_day(*days, not args.keep_repeats, args.dated)
    elif args.job == "compact":
        print(*jobs.run_compact(spark, args.base), "merged")
    else:
        jobs.run_stream(spark, args.base, not args.keep_repeats, args.with_marts)


if __name__ == "__main__":
    main()
