"""Landing and table writers.  ``fmt`` may be any installed table format."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetmart.contract import LANDING_DAY
from fleetmart.functions.parse import named
from fleetmart.functions.schema import orderable_columns, unused
from fleetmart.operators.cleaning import stamp_landing, stringify_all
from fleetmart.sinks import columns, versions


def landing_rows(df: DataFrame, run_ts: datetime, *, day: Column | None = None) -> DataFrame:
    """Rows as they land: stamped with the run's time, all text, with their landing day."""
    landing_day = F.lit(f"{run_ts:%Y-%m-%d}") if day is None else day
    return stringify_all(stamp_landing(df.withColumn(LANDING_DAY, landing_day), run_ts))


def _note_columns(rows: DataFrame, base: str, run_ts: datetime, day: Column | None) -> list[str]:
    """Note the columns before the files come, so that no reader misses one; the days of the rows."""
    days = [f"{run_ts:%Y-%m-%d}"] if day is None else [r[0] for r in rows.select(LANDING_DAY).distinct().collect()]
    columns.note(rows.sparkSession, base, days, [c for c in rows.columns if c != LANDING_DAY])
    return days


def append_landing(df: DataFrame, base: str, run_ts: datetime, *, day: Column | None = None) -> None:
    """Add the run's files to its day; earlier files stay."""
    rows = landing_rows(df, run_ts, day=day)
    _note_columns(rows, base, run_ts, day)
    rows.write.mode("append").partitionBy(LANDING_DAY).parquet(base)


def replace_landing_day(df: DataFrame, base: str, run_ts: datetime, *, day: Column | None = None) -> None:
    """Replace the files of the run's day; other days stay.

    Without rows the run's own day is emptied; where ``day`` gives the days of the rows, there
    is then none to replace.
    """
    spark, rows = df.sparkSession, landing_rows(df, run_ts, day=day)
    before = columns.notes(spark, base)
    days = _note_columns(rows, base, run_ts, day)
    seen = Observation()
    replace_partitions(rows.observe(seen, F.count(F.lit(1)).alias("rows")), base, [LANDING_DAY])
    if day is None and not seen.get["rows"]:
        remove(spark, f"{base.rstrip('/')}/{LANDING_DAY}={run_ts:%Y-%m-%d}")
    columns.forget(spark, base, before, days)


def compact_landing_day(spark: SparkSession, base: str, day: str, *, files: int = 1) -> None:
    """Write the many small files of a landing day as ``files`` ones, with all columns of any
    of them.  Runs that only append leave a file set each, which makes every later scan list
    and open more of them.  The old files go when the job commits; the notes on the day's
    columns become one.

    A row's place in its old file tells its new one, and the day is a constant, so that neither
    the shuffle nor the write sorts: a task streams its rows, however many they are.
    """
    rows = spark.read.option("mergeSchema", True).option("basePath", base).parquet(f"{base.rstrip('/')}/{LANDING_DAY}={day}")
    before = columns.notes(spark, base)
    columns.note(spark, base, [day], [c for c in rows.columns if c != LANDING_DAY])
    source = rows.metadataColumn("_metadata")
    spread = rows.repartition(files, F.xxhash64(source["file_path"], source["row_index"]))
    # the writer escapes what the folder's name has escaped
    replace_partitions(spread.withColumn(LANDING_DAY, F.lit(unquote(day, "latin-1"))), base, [LANDING_DAY])
    columns.forget(spark, base, before, [day])


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a folder with all it holds, if it is there."""
    versions.delete(spark, folder)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """Replace the partitions that ``df`` has rows of; others stay.

    The old files go when the job commits, so they may be an input of the new ones.
    """
    writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).save(path)


def replace_in_table(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """:func:`replace_partitions` of a table that :func:`overwrite_table` writes.

    The new partitions are written aside first, whole, and then copied into the table, so that
    a run which stops while partitions are exchanged loses none: :func:`recover` exchanges them
    again.  A transactional format needs no such copy.
    """
    if fmt == "delta":
        replace_partitions(df, path, partition_by, fmt)
        return
    spark = df.sparkSession
    redo = versions.redo_folder(path)
    df.write.format(fmt).partitionBy(*partition_by).save(redo)
    _exchange(spark, redo, path, partition_by, fmt)


def _exchange(spark: SparkSession, redo: str, path: str, partition_by: Sequence[str], fmt: str) -> None:
    live = versions.current(spark, path)
    # partition values as the table has them, where folder names alone do not tell their type
    known = {f.name: f.dataType for f in spark.read.format(fmt).load(live).schema}
    rows = spark.read.format(fmt).load(redo)
    rows = rows.withColumns({c: rows[c].cast(known[c]) for c in partition_by if c in known})
    replace_partitions(rows, live, partition_by, fmt)
    versions.delete(spark, redo)


def recover(spark: SparkSession, path: str, partition_by: Sequence[str], fmt: str = "parquet") -> int:
    """Finish replacements that a stopped run has left in a table; their number."""
    left = [] if fmt == "delta" else versions.unfinished(spark, path)
    for redo in left:
        _exchange(spark, redo, path, partition_by, fmt)
    return len(left)


def overwrite_table(
    df: DataFrame, path: str, fmt: str = "parquet", *, partition_by: Sequence[str] = ()
) -> None:
    """Replace a whole table, columns included.

    A transactional format does this itself.  Otherwise a new version is written beside the
    table and published by one rename (:mod:`fleetmart.sinks.versions`), so a reader finds the
    old or the new table whenever this stops, and the old table may be an input of the new one.
    """
    writer = df.write.format(fmt).partitionBy(*partition_by)
    if fmt == "delta":
        writer.mode("overwrite").option("overwriteSchema", "true").save(path)
        return
    staged = versions.staged_folder(path)
    writer.save(staged)
    versions.publish(df.sparkSession, staged, path)


def cluster_rows(df: DataFrame, by: Sequence[str], *, files: int | None = None) -> DataFrame:
    """Range-partition and sort rows by ``by`` so that a file spans few of its values.

    The range key ends in a hash of the task number and the other columns: a value with
    very many rows, or a row with very many copies, is cut over several files instead of
    filling one task.  Both parts are the same when a lost task is run again.
    """
    keys = [named(k) for k in by]
    spread = unused("spread", df.columns)
    numbered = df.withColumn(spread, F.xxhash64(F.spark_partition_id(), *orderable_columns(df, without=by)))
    ranges = [*keys, F.col(spread)]
    cut = numbered.repartitionByRange(files, *ranges) if files else numbered.repartitionByRange(*ranges)
    return cut.sortWithinPartitions(*keys).drop(spread)


def write_clustered(
    df: DataFrame, path: str, by: Sequence[str], *, files: int | None = None, fmt: str = "parquet"
) -> None:
    """:func:`overwrite_table` with the rows clustered, so readers skip by min/max."""
    overwrite_table(cluster_rows(df, by, files=files), path, fmt)
