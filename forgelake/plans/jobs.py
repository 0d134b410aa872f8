"""The batch jobs: land, silver, gold, each over one day or a range of days.

A job replaces the slices it is asked for and nothing else, so it can be repeated at will. A
range runs as one Spark job per table over all its days, not as a loop over days.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.operators import dimensions as dims
from forgelake.operators.facts import fact
from forgelake.plans.marts import MART_TYPES, STORED, renew
from forgelake.plans.silver import renew_silver, write_quarantine
from forgelake.schemas import FACTS
from forgelake.session import prepare, room_for, together
from forgelake.sources.bronze import land_dumps, quarantine, read_bronze
from forgelake.sources.gold import gold_in, read_gold
from forgelake.sources.lake import bytes_of, day_slices, read_silver
from forgelake.sources.snapshot import Run, Snapshot, snapshot
from forgelake.streaming.ingest import compact, read_streamed_silver, stream_to_silver
from forgelake.tables import Gold

STATES = {
    "state_day": dims.day_state,
    "state_actor": dims.actor_state,
    "state_repo": dims.repo_state,
    "state_org": dims.org_state,
}


# Within a day facts lie by type and actor, and each row group has a Bloom filter of its actors, as
# large as they need: a look for one developer reads few row groups.
FACT_ORDER = ("event_type", "actor_id")
FACT_OPTIONS = {
    "parquet.bloom.filter.enabled#actor_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


def run_bronze(
    spark: SparkSession,
    base: str,
    first: date,
    last: date | None = None,
    hour: int | None = None,
) -> int:
    """Landed dumps in ``base/landing`` to bronze: one hour, a day, or a range; the lines landed."""
    return land_dumps(prepare(spark), f"{base}/landing", f"{base}/bronze", first, last, hour)


def run_silver(
    spark: SparkSession,
    base: str,
    first: date,
    last: date | None = None,
    dedupe: bool = True,
    dated: bool = False,
) -> int:
    """Bronze to silver; the rows stored (see ``plans.silver``)."""
    return renew_silver(spark, base, first, last, dedupe, dated).rows


def run_quarantine(spark: SparkSession, base: str, first: date, last: date | None = None) -> None:
    """List the bad lines of the days in ``base/quarantine``."""
    last = last or first
    events = read_bronze(prepare(spark), f"{base}/bronze", first, last)
    with room_for(spark, bytes_of(events)):
        write_quarantine(quarantine(events, "event_date"), base, day_slices(first, last))


def _merged_marks(view: Snapshot, name: str) -> list[str]:
    """The days up to which there are merged tables, in order."""
    return sorted(p.removeprefix("upto=") for p in view.parts.get(f"{name}_upto", {}))


def _state_days(view: Snapshot, name: str, begin: str | None, end: str | None = None) -> DataFrame:
    """The days of a state table from ``begin`` to before ``end``."""
    wanted = [
        piece for piece in view.pieces(name)
        if (begin is None or piece >= f"event_date={begin}") and (end is None or piece < f"event_date={end}")
    ]
    return view.read(name, dims.STATE_TYPES[name], wanted)


def read_state(view: Snapshot, name: str) -> DataFrame:
    """All days of a state table: the newest merged table and the days since."""
    marks = _merged_marks(view, name)
    if not marks:
        return _state_days(view, name, None)
    merged = view.read(f"{name}_upto", dims.STATE_TYPES[name], [f"upto={marks[-1]}"])
    return merged.unionAll(_state_days(view, name, marks[-1]))


def keep_merged(run: Run, name: str, first: date) -> None:
    """Bring the merged tables of a state table up to date after days from ``first`` on were replaced.

    A merged table ``upto=2024-02-01`` holds all days before that one. Those that contain replaced
    days go, and a new one is made once a month has ended; the two newest are kept, so that a day of
    the month before costs no more than a month. A daily run thus reads one table with a row per name
    known so far, like the dimension that it writes, and the days since; not every day there ever was.
    """
    merged = f"{name}_upto"
    run.drop(merged, [f"upto={m}" for m in _merged_marks(run, name) if m > str(first)])
    days = sorted(p.removeprefix("event_date=") for p in run.pieces(name))
    if not days:
        return
    month, marks = date.fromisoformat(days[-1]).replace(day=1), _merged_marks(run, name)
    since = marks[-1] if marks else None
    if str(month) > max(days[0], since or "") and month <= first:
        rows = _state_days(run, name, since, str(month))
        if since is not None:
            rows = rows.unionAll(run.read(merged, dims.STATE_TYPES[name], [f"upto={since}"]))
        rows = dims.merged(name, rows).withColumn("upto", F.lit(str(month)))
        run.put(merged, rows, by=("upto",), replaces=[f"upto={m}" for m in marks[:-1]])


def write_gold(silver: DataFrame, path: str, first: date, last: date, also: Sequence[date] = ()) -> Gold:
    """Replace the slices ``first`` to ``last``, and some others, of ``silver`` in gold and renew the
    dimensions, as one version.

    Dimensions span all days. Each day leaves a small table of the names it saw, and the
    dimensions are built from these (see ``keep_merged``), so a run costs its own days of silver,
    days may come in any order, and a repeated day takes back what its earlier version had added.
    Readers see facts and dimensions change together, when all of them have been written.
    """
    spark, run = silver.sparkSession, Run(silver.sparkSession, path)
    slices = list(dict.fromkeys([*day_slices(first, last), *[f"event_date={d}" for d in also]]))
    first = min([first, *also])

    def put_fact(name: str) -> None:
        # Silver files are of a good size and a fact is a filter of them: no shuffle.
        run.put(
            name, fact(silver, name, "event_date"), ("event_date", "date_id"), slices, sort_by=FACT_ORDER, balance=False, **FACT_OPTIONS
        )

    def put_state(name: str) -> None:
        run.put(name, STATES[name](silver, "event_date"), ("event_date",), slices)
        keep_merged(run, name, first)

    together(spark, *[partial(put_fact, name) for name in FACTS], *[partial(put_state, name) for name in STATES])
    state = {name: read_state(run, name) for name in STATES}
    with room_for(spark, bytes_of(*state.values())):
        together(
            spark,
            lambda: run.put("dim_date", dims.dim_date(state["state_day"])),
            lambda: run.put("dim_actor", dims.dim_actor(state["state_actor"])),
            lambda: run.put("dim_repo", dims.dim_repo(state["state_repo"])),
            lambda: run.put("dim_org", dims.dim_org(state["state_org"])),
        )
    return gold_in(run.publish())


def run_gold(
    spark: SparkSession,
    base: str,
    first: date,
    last: date | None = None,
    streamed: bool = False,
    also: Sequence[date] = (),
) -> Gold:
    """Stored silver days to stored gold, from the batch table or the streamed one."""
    last = last or first
    path = f"{base}/streamed" if streamed else f"{base}/silver"
    read = read_streamed_silver if streamed else read_silver
    silver = read(prepare(spark), path, first, last, also)
    with room_for(spark, bytes_of(silver)):
        return write_gold(silver, f"{base}/gold", first, last, also)


def run_marts(
    spark: SparkSession, base: str, first: date | None = None, last: date | None = None
) -> dict[str, DataFrame]:
    """Renew the marts from stored gold, for some days or for all, as one version.

    Only the pieces that the days touch are read and written again (see ``marts.renew``).
    """
    last = last or first
    run = Run(prepare(spark), f"{base}/gold")
    days = gold_in(run, first, last, with_slice=True)
    slices = None if first is None else day_slices(first, last)
    with room_for(spark, bytes_of(*[days[name] for name in FACTS])):
        together(run.spark, *[partial(renew, run, name, days, slices) for name in STORED])
    run.publish()
    return read_marts(spark, base)


def read_marts(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The stored marts; nothing is computed on reading."""
    view = snapshot(spark, f"{base}/gold")
    return {name: view.read(name, columns) for name, columns in MART_TYPES.items()}


def run_day(
    spark: SparkSession,
    base: str,
    first: date,
    last: date | None = None,
    dedupe: bool = True,
    dated: bool = False,
) -> Gold:
    """Silver and quarantine from one pass over the JSON, then gold; an error in silver stops the run
    before gold is touched. Gold follows where silver of later days changed with these."""
    renewed = renew_silver(spark, base, first, last, dedupe, dated, bad_lines=True)
    return run_gold(spark, base, first, last, also=renewed.changed)


def run_stream(spark: SparkSession, base: str, dedupe: bool = True, with_marts: bool = False) -> None:
    """What has arrived in ``base/bronze`` since the last run, to ``base/streamed``."""
    query = stream_to_silver(
        spark, f"{base}/bronze", f"{base}/streamed", f"{base}/streamed-progress", dedupe=dedupe, with_marts=with_marts
    )
    query.awaitTermination()


def run_compact(spark: SparkSession, base: str) -> list[str]:
    """Merge what the stream has stored in several pieces; the slices merged."""
    return compact(spark, f"{base}/streamed")
