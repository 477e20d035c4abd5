"""Enrich positions with the dimension, aggregate activity, report the busiest lines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart import contract as C
from fleetmart.functions.schema import orderable_columns, unused


def left_enrich(facts: DataFrame, dim: DataFrame, on: str, *, salts: int = 1) -> DataFrame:
    """Left equi-join that keeps every fact; several matches give several rows.

    No broadcast hint: Spark broadcasts the dimension when its measured size allows and
    sorts and merges otherwise, splitting skewed partitions at run time.  ``salts`` > 1
    spreads each key over that many partitions by copying the dimension, for clusters
    where run-time splitting is off; the rows are the same.
    """
    if salts <= 1:
        return facts.join(dim, on, "left")
    # task number and row content: both are the same when a lost task is run again
    spread = F.xxhash64(F.spark_partition_id(), *orderable_columns(facts))
    salt = unused("salt", [*facts.columns, *dim.columns])
    salted = facts.withColumn(salt, F.pmod(spread, F.lit(salts)).cast("int"))
    copies = dim.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # Spark's size estimate leaves out the copying, so it must not choose a broadcast by it
    return salted.join(copies.hint("merge"), [on, salt], "left").drop(salt)


def without_dimension(facts: DataFrame) -> DataFrame:
    """Stand-in for the join when there is no dimension: constants for its columns."""
    return facts.withColumns(
        {C.OPERATOR: F.lit(C.UNKNOWN_OPERATOR), C.LINE_NAME: F.lit(C.UNKNOWN_OPERATOR)}
    )


def line_totals(positions: DataFrame, *by: str, more: Mapping[str, Column] | None = None) -> DataFrame:
    """Pings, last time and latitude span per line (and ``by``); ``more`` measures by name."""
    return positions.groupBy(*by, C.LINE).agg(
        F.count(C.VEHICLE).alias("total_pings"),
        F.max(C.EVENT_TIME).alias("last_seen"),
        F.min(C.LATITUDE).alias("min_lat"),
        F.max(C.LATITUDE).alias("max_lat"),
        *[measure.alias(name) for name, measure in (more or {}).items()],
    )


def summed_totals(totals: DataFrame) -> DataFrame:
    """Totals per line of totals per line and something else."""
    return totals.groupBy(C.LINE).agg(
        F.sum("total_pings").alias("total_pings"),
        F.max("last_seen").alias("last_seen"),
        F.min("min_lat").alias("min_lat"),
        F.max("max_lat").alias("max_lat"),
    )


def enriched_totals(per_line: DataFrame, dim: DataFrame | None) -> DataFrame:
    """Totals per line joined with the dimension: one row per (line, operator)."""
    measures = ["last_seen", "min_lat", "max_lat"]
    if dim is None:
        return without_dimension(per_line).select(C.LINE, C.OPERATOR, "total_pings", *measures)
    copies = dim.groupBy(C.LINE, C.OPERATOR).agg(F.count("*").alias("_copies"))
    return left_enrich(per_line, copies, C.LINE).select(
        C.LINE,
        C.OPERATOR,
        (F.col("total_pings") * F.coalesce("_copies", F.lit(1))).alias("total_pings"),
        *measures,
    )


def line_activity(positions: DataFrame, dim: DataFrame | None) -> DataFrame:
    """Pings, last time and latitude span per (line, operator).

    Equals ``left join on line, group by (line, operator)`` but aggregates both sides
    first: counts multiply by the number of matching dimension rows, and minimum and
    maximum do not change under repetition.  What is joined is one row per line on one
    side and one per (line, operator) on the other, however many positions or register
    copies a line has.
    """
    return enriched_totals(line_totals(positions), dim)


def busiest_lines(activity: DataFrame, k: int = C.REPORT_SIZE) -> DataFrame:
    """The ``k`` groups with most pings; ties go by line, then operator."""
    return (
        activity.select(C.LINE, C.OPERATOR, "total_pings", "last_seen")
        .orderBy(F.desc("total_pings"), C.LINE, C.OPERATOR)
        .limit(k)
    )


def busiest_lines_sql(activity: DataFrame, k: int = C.REPORT_SIZE) -> DataFrame:
    """:func:`busiest_lines` as SQL text over the activity table."""
    return activity.sparkSession.sql(
        """
        SELECT cod_linha, consorcio, total_pings, last_seen
        FROM {activity}
        ORDER BY total_pings DESC, cod_linha, consorcio
        LIMIT {k}
        """,
        activity=activity,
        k=k,
    )
