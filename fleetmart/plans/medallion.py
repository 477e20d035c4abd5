"""Daily batch: land -> refine -> gate -> serve -> gate -> report.

Stages meet only in tables, so each can be rerun alone and a lost executor costs no more
than the stage it was in.  A run that stops anywhere leaves the old or the new tables and notes of
what is left (:mod:`fleetmart.plans.pending`), which the next run does, incremental or not.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart import contract as C
from fleetmart.operators import cleaning, dimensions, enrich, quality
from fleetmart.plans import pending
from fleetmart.plans.layout import Layout
from fleetmart.sinks import versions
from fleetmart.sinks.scratch import scratch_path
from fleetmart.sinks.writers import (
    append_landing,
    overwrite_table,
    recover,
    remove,
    replace_in_table,
    replace_landing_day,
    write_clustered,
)
from fleetmart.sources import feeds, links
from fleetmart.sources.delimited import read_delimited
from fleetmart.sources.tables import if_present, load_table, scan_landing


class StageError(RuntimeError):
    """A stage whose output the run needs was skipped."""


@dataclass(frozen=True)
class StageResult:
    """``status`` is ``written``, ``skipped`` (no input) or ``unchecked`` (written
    unfiltered because essential columns are missing)."""

    stage: str
    status: str
    path: str
    detail: str = ""


@dataclass
class Run:
    stages: list[StageResult] = field(default_factory=list)
    checks: list[dict] = field(default_factory=list)
    report: DataFrame | None = None


def land_positions(
    bodies: DataFrame, layout: Layout, run_ts: datetime, *, fields: Sequence[str] | None = None
) -> StageResult:
    """Unwrap feed bodies and append their records to the run's day.

    The bodies are read and parsed once, into a staged table that tells the field names and
    whether there is a body without records, which stops the run before anything lands.
    """
    spark, path = bodies.sparkSession, layout.path("landed_positions")
    staged = scratch_path(spark, "feed")
    feeds.split_feed(bodies).write.parquet(staged)
    try:
        records = feeds.require_records(spark.read.parquet(staged), "feed")
        if layout.by_event_day:
            pending.note(spark.createDataFrame([(f"{run_ts:%Y-%m-%d}",)], "day string"), layout, "landed")
        append_landing(feeds.tabulate(records, fields), path, run_ts)
    finally:
        remove(spark, staged)
    return StageResult("land_positions", "written", path)


def choose_register(pages: DataFrame, newest_year: int, *, contains: str = ".csv") -> str:
    """The newest register link of the catalogue: the pages must agree on one.

    The link is read as it stands, so it must be on a file system that Spark reads.
    """
    candidates = feeds.require_rows(links.harvest_links(pages, contains=contains), "catalogue")
    newest = links.latest_resource(candidates, newest_year=newest_year).select("href").distinct()
    chosen = [row["href"] for row in newest.orderBy("href").limit(2).collect()]
    if len(chosen) > 1:
        raise ValueError(f"the catalogue names several newest registers, among them {chosen}")
    return chosen[0]


def land_register(
    spark: SparkSession, source: str | list[str], layout: Layout, run_ts: datetime
) -> StageResult:
    """Read the register file(s) and replace the run's day with them."""
    path = layout.path("landed_register")
    replace_landing_day(read_delimited(spark, source), path, run_ts)
    return StageResult("land_register", "written", path)


def refine_positions(spark: SparkSession, layout: Layout, *, now: Column | None = None) -> StageResult:
    """Refine all landed positions."""
    path = layout.path("positions")
    landed = pending.notes(spark, layout, "landed")
    raw = if_present(scan_landing, spark, layout.path("landed_positions"), merge_schema=True)
    if raw is None:
        return StageResult("refine_positions", "skipped", path, "no landed positions")
    refined = cleaning.refine_positions(raw, now=now)
    missing = cleaning.missing_essentials(refined)
    if layout.by_event_day:
        pending.note(spark.createDataFrame([(True,)], "whole boolean"), layout, "whole")
        overwrite_table(_by_event_day(refined, layout), path, layout.fmt, partition_by=_PLACES)
    else:
        overwrite_table(refined, path, layout.fmt)
    pending.done(spark, landed)
    if missing:
        return StageResult("refine_positions", "unchecked", path, f"missing columns: {missing}")
    return StageResult("refine_positions", "written", path)


#: What positions by event day are partitioned by.
_PLACES = [C.EVENT_DAY, C.EVENT_PART]


def _newly_located(spark: SparkSession, layout: Layout, since: str) -> DataFrame | None:
    """Typed positions landed from day ``since`` on, with the columns of all landing days."""
    raw = if_present(scan_landing, spark, layout.path("landed_positions"), since=since, merge_schema=True)
    if raw is None:
        return None
    fresh = cleaning.locate_positions(raw)
    if C.RAW_TIME not in fresh.columns or cleaning.missing_essentials(fresh):
        raise ValueError(f"an essential column is missing from {raw.columns}: refine all positions")
    return fresh


def first_unrefined(spark: SparkSession, layout: Layout, since: str) -> str:
    """``since``, or an earlier day whose landed positions no run has refined yet."""
    left = pending.rows_of(spark, pending.notes(spark, layout, "landed"))
    first = None if left is None else left.agg(F.min("day")).first()[0]
    return since if first is None else min(since, first)


def touched_days(spark: SparkSession, layout: Layout, since: str) -> DataFrame | None:
    """The event ``day`` and ``part`` of the positions landed from ``since`` on, as a written table."""
    fresh = _newly_located(spark, layout, since)
    if fresh is None:
        return None
    path = scratch_path(spark, "days")
    _places(fresh, layout).select(F.col(C.EVENT_DAY).alias("day"), F.col(C.EVENT_PART).alias("part")).distinct().write.parquet(path)
    return spark.read.parquet(path)


def days_to_serve(spark: SparkSession, layout: Layout) -> DataFrame | None:
    """The event ``day`` and ``part`` of refined positions that the daily totals lack; None for all."""
    if pending.notes(spark, layout, "whole"):
        return None
    return pending.rows_of(spark, pending.notes(spark, layout, "refined"))


def on_days(table: DataFrame, days: DataFrame, *, parts: bool = False) -> DataFrame:
    """The rows of a table by event day on these days (with ``parts``: in these parts of them).

    Written so that Spark prunes the table's partitions by the days it finds at run time,
    for which it wants a comparison on the side of the days.
    """
    places = days.select("day", *["part"] * parts).distinct()
    dated = places.filter(F.year("day") > F.lit(-1_000_000))  # any day
    same = table[C.EVENT_DAY] == dated["day"]
    known = table.join(dated, same & (table[C.EVENT_PART] == dated["part"]) if parts else same, "left_semi")
    undated, nowhen = table.filter(F.col(C.EVENT_DAY).isNull()), places.filter("day is null").withColumnRenamed("day", "no_day")
    at = undated[C.EVENT_PART] == nowhen["part"] if parts else F.col("no_day").isNull()
    return known.unionByName(undated.join(nowhen, at, "left_semi"))


def refine_new_positions(
    spark: SparkSession, layout: Layout, since: str, *, days: DataFrame | None = None
) -> StageResult:
    """Refine the positions landed from day ``since`` on into a table by event day.

    Reads those landing days (and earlier ones that a stopped run has not refined) and the parts of
    event days their positions fall on (``days``, if known), and replaces the latter.  The table is
    then what :func:`refine_positions` would make of all landed positions; a day refined twice
    does no harm.
    """
    path = layout.path("positions")
    if not layout.by_event_day:
        raise ValueError("positions must be kept by_event_day to refine new ones alone")
    landed = pending.notes(spark, layout, "landed")
    current = if_present(load_table, spark, path, layout.fmt)
    if current is None:
        return refine_positions(spark, layout)
    if recover(spark, path, _PLACES, layout.fmt):
        current = load_table(spark, path, layout.fmt)
    first = first_unrefined(spark, layout, since)
    fresh = _newly_located(spark, layout, first)
    if fresh is None:
        return StageResult("refine_positions", "skipped", path, "no landed positions")
    days = touched_days(spark, layout, first) if days is None or first < since else days
    pending.note(days, layout, "refined")
    merged = cleaning.merge_positions(on_days(current, days, parts=True).drop(*_PLACES), fresh)
    replace_in_table(_by_event_day(merged, layout), path, _PLACES, layout.fmt)
    pending.done(spark, landed)
    return StageResult("refine_positions", "written", path, f"positions landed since {first}")


def _places(positions: DataFrame, layout: Layout) -> DataFrame:
    """Positions with the event day and part that they are kept in."""
    key = [F.col(c) for c in C.POSITION_KEY if c in positions.columns]
    part = F.pmod(F.xxhash64(*key), F.lit(layout.parts)).cast("int")
    return positions.withColumns({C.EVENT_DAY: F.to_date(C.EVENT_TIME), C.EVENT_PART: part})


def _by_event_day(positions: DataFrame, layout: Layout) -> DataFrame:
    """Rows grouped by their places; Spark joins small ones and splits large ones by size."""
    return _places(positions, layout).hint("rebalance", *_PLACES)


def refine_register(spark: SparkSession, layout: Layout, *, normalize_first: bool = False) -> StageResult:
    raw = if_present(scan_landing, spark, layout.path("landed_register"), merge_schema=True)
    path = layout.path("register")
    if raw is None:
        return StageResult("refine_register", "skipped", path, "no landed register")
    if C.REGISTER_LINE not in raw.columns:
        return StageResult("refine_register", "skipped", path, f"no {C.REGISTER_LINE} among {raw.columns}")
    overwrite_table(dimensions.extract_dimension(raw, normalize_first=normalize_first), path, layout.fmt)
    versions.touch(spark, _register_known(layout))
    return StageResult("refine_register", "written", path)


def _register_known(layout: Layout) -> str:
    """A mark outside the register's folder that there has been one."""
    head, _, name = layout.path("register").rstrip("/").rpartition("/")
    return f"{head}/_known_{name}"


def _register(spark: SparkSession, layout: Layout) -> DataFrame | None:
    """The register; None only where there has never been one."""
    register = if_present(load_table, spark, layout.path("register"), layout.fmt)
    if register is None and versions.exists(spark, _register_known(layout)):
        raise versions.LostTableError(f"the register was in {layout.path('register')} and is gone; remove {_register_known(layout)} to serve without one")
    return register


def check_positions(
    spark: SparkSession, layout: Layout, *, as_of: Column | None = None, days: DataFrame | None = None
) -> list[dict]:
    """Gate after refining; raises when the table is empty.

    With ``days`` only those event days are read; how many rows the others have is kept with their
    daily totals.  A key holds its time, so keys on other days cannot repeat one on these.
    """
    positions = load_table(spark, layout.path("positions"), layout.fmt)
    daily = None if days is None or not layout.by_event_day else if_present(load_table, spark, layout.path("daily"), layout.fmt)
    if daily is None or _ROWS not in daily.columns:
        return quality.raise_on_failure(quality.positions_checks(positions, as_of=as_of))
    touched = on_days(positions, days)
    places = days.select("day").distinct()
    others = daily.join(places, F.col(C.EVENT_DAY).eqNullSafe(F.col("day")), "left_anti").agg(F.sum(_ROWS)).first()[0] or 0
    return quality.raise_on_failure(quality.positions_checks(touched, as_of=as_of, other_rows=others))


#: Positions of a line on a day, kept with its totals.
_ROWS = "positions"


def build_activity(
    spark: SparkSession, layout: Layout, *, days: DataFrame | None = None, note: str = ""
) -> StageResult:
    """Aggregate the refined positions; without a register all lines are unenriched.

    A layout by event day keeps the totals of each day, of which those of ``days`` and of days
    that no run has served yet are made anew (all without ``days``), and sums them.  ``note`` is the
    result's detail where there is a register.
    """
    positions = if_present(load_table, spark, layout.path("positions"), layout.fmt)
    path = layout.path("activity")
    if positions is None:
        return StageResult("build_activity", "skipped", path, "no refined positions")
    register = _register(spark, layout)
    whole, left = (pending.notes(spark, layout, kind) for kind in ("whole", "refined"))
    if whole:
        days = None
    if layout.by_event_day and days is not None:
        more = pending.rows_of(spark, left)
        days = days.select("day") if more is None else days.select("day").unionByName(more.select("day"))
    totals = _daily_totals(spark, layout, positions, days) if layout.by_event_day else enrich.line_totals(positions)
    write_clustered(enrich.enriched_totals(totals, register), path, [C.LINE], fmt=layout.fmt)
    pending.done(spark, [*left, *whole])
    return StageResult("build_activity", "written", path, "no register" if register is None else note)


def _daily_totals(spark: SparkSession, layout: Layout, positions: DataFrame, days: DataFrame | None) -> DataFrame:
    path = layout.path("daily")
    known = None if days is None else if_present(load_table, spark, path, layout.fmt)
    if known is None or _ROWS not in known.columns:
        overwrite_table(_totals_of(positions), path, layout.fmt, partition_by=[C.EVENT_DAY])
    else:
        recover(spark, path, [C.EVENT_DAY], layout.fmt)
        replace_in_table(_totals_of(on_days(positions, days)), path, [C.EVENT_DAY], layout.fmt)
    return enrich.summed_totals(load_table(spark, path, layout.fmt))


def _totals_of(positions: DataFrame) -> DataFrame:
    return enrich.line_totals(positions, C.EVENT_DAY, more={_ROWS: F.count(F.lit(1))})


def check_activity(spark: SparkSession, layout: Layout) -> list[dict]:
    """Gate after serving; reports the enrichment band."""
    activity = load_table(spark, layout.path("activity"), layout.fmt)
    return quality.raise_on_failure(quality.enrichment_check(activity))


def report(spark: SparkSession, layout: Layout, k: int = C.REPORT_SIZE) -> DataFrame:
    """The busiest lines; raises when there are none."""
    top = enrich.busiest_lines(load_table(spark, layout.path("activity"), layout.fmt), k)
    quality.raise_on_failure(quality.report_check(top))
    return top


def _needed(result: StageResult) -> StageResult:
    if result.status == "skipped":
        raise StageError(f"{result.stage}: {result.detail}")
    return result


def run_daily(
    spark: SparkSession,
    layout: Layout,
    run_ts: datetime,
    *,
    bodies: DataFrame | None = None,
    fields: Sequence[str] | None = None,
    register: str | list[str] | None = None,
    pages: DataFrame | None = None,
    since: str | None = None,
) -> Run:
    """All stages in order.  Inputs left out are not landed; what was landed before is used.

    ``register`` names the register file(s); with ``pages`` it is the link chosen from the
    catalogue pages.  With ``since`` only the positions landed from that day on are refined,
    and only the event days they fall on are checked and counted again, with what earlier runs
    that stopped have left: landed positions not refined, refined days not counted.
    """
    run = Run()
    if bodies is not None:
        run.stages.append(land_positions(bodies, layout, run_ts, fields=fields))
    if register is None and pages is not None:
        register = choose_register(pages, run_ts.year)
    if register is not None:
        run.stages.append(land_register(spark, register, layout, run_ts))
    refined = refine_new_positions(spark, layout, since) if since else refine_positions(spark, layout)
    run.stages.append(_needed(refined))
    # with what stopped runs have refined but not served
    days = days_to_serve(spark, layout) if since and layout.by_event_day else None
    run.stages.append(refine_register(spark, layout))
    skipped = run.stages[-1].status == "skipped"
    note = f"register not refined in this run: {run.stages[-1].detail}" if skipped else ""
    run.checks += check_positions(spark, layout, as_of=F.lit(run_ts), days=days)
    run.stages.append(_needed(build_activity(spark, layout, days=days, note=note)))
    run.checks += check_activity(spark, layout)
    run.report = report(spark, layout)
    return run
