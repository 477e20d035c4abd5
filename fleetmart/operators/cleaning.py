"""Refine landed positions: rename, type, filter, deduplicate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmart import contract as C
from fleetmart.functions.parse import clean_code, compact_timestamp, decimal_comma, named
from fleetmart.functions.schema import orderable_columns, unused


def rename_exact(df: DataFrame, names: Mapping[str, str] = C.POSITION_FIELDS) -> DataFrame:
    """Rename the columns present under exactly these names; all others pass through."""
    return df.toDF(*[names.get(name, name) for name in df.columns])


def stringify_all(df: DataFrame) -> DataFrame:
    """Every column as text in one projection; a missing value stays NULL."""
    return df.select(*[named(name).cast("string").alias(name) for name in df.columns])


def stamp_landing(df: DataFrame, run_ts: datetime) -> DataFrame:
    """Add the ISO text of the run's time."""
    return df.withColumn(C.INGESTED_AT, F.lit(run_ts.isoformat()))


def type_positions(df: DataFrame, *, now: Column | None = None, processed_at: Column | None = None) -> DataFrame:
    """Type the renamed feed columns that exist and add the event and processing times.

    Without a raw time column the event time is ``now`` (default: the query's time).
    """
    clock = F.current_timestamp()
    typed = {name: decimal_comma(F.col(name)) for name in (C.LATITUDE, C.LONGITUDE) if name in df.columns}
    if C.RAW_TIME in df.columns:
        typed[C.EVENT_TIME] = compact_timestamp(F.col(C.RAW_TIME))
    else:
        typed[C.EVENT_TIME] = clock if now is None else now
    typed[C.PROCESSED_AT] = clock if processed_at is None else processed_at
    return df.withColumns(typed)


def keep_located(df: DataFrame, *, reject_nan: bool = False) -> DataFrame:
    """Keep rows with both coordinates; NaN counts as present unless ``reject_nan``."""
    kept = F.col(C.LATITUDE).isNotNull() & F.col(C.LONGITUDE).isNotNull()
    if reject_nan:
        kept &= ~F.isnan(C.LATITUDE) & ~F.isnan(C.LONGITUDE)
    return df.filter(kept)


def dedup_by_key(
    df: DataFrame, keys: Sequence[str], *, order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """One row per key (NULLs are equal): the first by ``order_by``.

    By default all other columns order the rows, so reruns agree on the survivor.  The
    rank-1 filter lets Spark keep one row per key and task before the shuffle, so a key
    that holds a large share of the rows sends one row per task.
    """
    if order_by is None:
        order_by = orderable_columns(df, without=keys)
    ranked = Window.partitionBy(*[named(k) for k in keys]).orderBy(*(order_by or [F.lit(1)]))
    rank = unused("rank", df.columns)
    return df.withColumn(rank, F.row_number().over(ranked)).filter(F.col(rank) == 1).drop(rank)


def missing_essentials(df: DataFrame) -> list[str]:
    """Essential columns a typed position table lacks."""
    return [name for name in C.ESSENTIAL if name not in df.columns]


def locate_positions(
    raw: DataFrame,
    *,
    now: Column | None = None,
    processed_at: Column | None = None,
    reject_nan: bool = False,
    normalize_key: bool = False,
) -> DataFrame:
    """Landed positions -> typed rows that have coordinates.

    When an essential column is missing the typed rows are returned unfiltered, for
    inspection; see :func:`missing_essentials`.  ``normalize_key`` cleans the line code
    the way the register's is cleaned (off by default: codes join as they come).
    """
    typed = type_positions(rename_exact(raw), now=now, processed_at=processed_at)
    if normalize_key and C.LINE in typed.columns:
        typed = typed.withColumn(C.LINE, clean_code(F.col(C.LINE)))
    return typed if missing_essentials(typed) else keep_located(typed, reject_nan=reject_nan)


def refine_positions(
    raw: DataFrame, *, order_by: Sequence[str | Column] | None = None, **options
) -> DataFrame:
    """:func:`locate_positions`, then one row per vehicle and event time (unless an
    essential column is missing)."""
    located = locate_positions(raw, **options)
    return located if missing_essentials(located) else one_per_key(located, order_by)


def one_per_key(positions: DataFrame, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """One typed position per vehicle and event time; by default the first by all feed
    columns, whenever they were processed."""
    if order_by is None:
        order_by = orderable_columns(positions, without=[*C.POSITION_KEY, C.PROCESSED_AT])
    return dedup_by_key(positions, C.POSITION_KEY, order_by=order_by)


def merge_positions(current: DataFrame, located: DataFrame) -> DataFrame:
    """Refined positions after more were located: what refining all at once would give.

    The survivor of a key is the least row in a fixed order, so the least of the earlier
    survivor and the new rows is the least of all.  A column that only one side has is NULL
    on the other, as in landing days that lack it.
    """
    return one_per_key(current.unionByName(located, allowMissingColumns=True))
