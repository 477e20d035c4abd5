"""Quality rules as rows: (rule, severity, observed, threshold, status).

``status`` is ``ok`` or the severity of the broken rule: ``fail`` stops a run
(:func:`raise_on_failure`), ``alert`` and ``warn`` are reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart import contract as C


class DataQualityError(ValueError):
    """A rule of severity ``fail`` is broken."""


def _rule(name: str, severity: str, observed: Column, threshold: float, broken: Column) -> Column:
    return F.struct(
        F.lit(name).alias("rule"),
        F.lit(severity).alias("severity"),
        observed.cast("double").alias("observed"),
        F.lit(float(threshold)).alias("threshold"),
        F.when(broken, F.lit(severity)).otherwise(F.lit("ok")).alias("status"),
    )


def _as_rows(totals: DataFrame, rules: list[Column]) -> DataFrame:
    return totals.select(F.inline(F.array(*rules)))


def _no_coordinates() -> Column:
    return F.col(C.LATITUDE).isNull() | F.col(C.LONGITUDE).isNull()


def _positions_rules(as_of: Column | None) -> list[Column]:
    rules = [
        _rule("volume", "fail", F.col("volume"), 0, F.col("volume") == 0),
        _rule("null_coordinates", "warn", F.col("no_coords"), 0, F.col("no_coords") > 0),
    ]
    if as_of is not None:
        rules.append(_rule("future_timestamps", "warn", F.col("future"), 0, F.col("future") > 0))
    return rules


def positions_scan_checks(positions: DataFrame, *, as_of: Column | None = None) -> DataFrame:
    """Volume, null coordinates and (with ``as_of``) future times, in one scan, no shuffle
    but that of one row per task."""
    measures = [F.count("*").alias("volume"), F.count_if(_no_coordinates()).alias("no_coords")]
    if as_of is not None:
        measures.append(F.count_if(F.col(C.EVENT_TIME) > as_of).alias("future"))
    return _as_rows(positions.agg(*measures), _positions_rules(as_of))


def duplicate_keys(df: DataFrame, keys: tuple[str, ...] | list[str]) -> DataFrame:
    """Keys held by more than one row, with their row ``count``."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def duplicate_key_check(df: DataFrame, keys: tuple[str, ...] | list[str]) -> DataFrame:
    """The number of duplicated keys (groups, not rows) as a rule."""
    totals = duplicate_keys(df, keys).agg(F.count("*").alias("groups"))
    return _as_rows(totals, [_rule("duplicate_keys", "warn", F.col("groups"), 0, F.col("groups") > 0)])


def positions_checks(
    positions: DataFrame, *, as_of: Column | None = None, other_rows: int = 0
) -> DataFrame:
    """All rules of the refined positions in one job: a single scan and one shuffle.

    Rows are counted per key, which the duplicate rule needs anyway, and the other counts
    ride along as sums.  ``other_rows`` is the number of rows elsewhere where these are a part of a
    table.
    """
    per_key = positions.groupBy(*C.POSITION_KEY).agg(
        F.count("*").alias("rows"), F.count_if(_no_coordinates()).alias("no_coords")
    )
    measures = [
        (F.coalesce(F.sum("rows"), F.lit(0)) + F.lit(other_rows)).alias("volume"),
        F.coalesce(F.sum("no_coords"), F.lit(0)).alias("no_coords"),
        F.count_if(F.col("rows") > 1).alias("groups"),
    ]
    if as_of is not None:
        late = F.when(F.col(C.EVENT_TIME) > as_of, F.col("rows"))
        measures.append(F.coalesce(F.sum(late), F.lit(0)).alias("future"))
    rules = _positions_rules(as_of)
    rules.append(_rule("duplicate_keys", "warn", F.col("groups"), 0, F.col("groups") > 0))
    return _as_rows(per_key.agg(*measures), rules)


def is_unenriched(operator: Column) -> Column:
    """No operator, or a placeholder for it."""
    return operator.isNull() | operator.isin(*C.UNENRICHED)


def enrichment_rate(df: DataFrame, operator: str = C.OPERATOR) -> DataFrame:
    """One row: ``total``, ``unknown`` and the enriched share ``match_rate`` in percent
    (0 for an empty table)."""
    counts = df.agg(F.count("*").alias("total"), F.count_if(is_unenriched(F.col(operator))).alias("unknown"))
    share = (F.col("total") - F.col("unknown")) / F.col("total") * 100
    return counts.withColumn("match_rate", F.when(F.col("total") == 0, F.lit(0.0)).otherwise(share))


def enrichment_check(df: DataFrame, operator: str = C.OPERATOR) -> DataFrame:
    """The enrichment rate as a rule with an alert and a warning band; it never fails."""
    rate = F.col("match_rate")
    alert, warn = F.lit(C.RATE_ALERT_BELOW), F.lit(C.RATE_WARN_BELOW)
    severity = F.when(rate < alert, "alert").otherwise("warn")
    return enrichment_rate(df, operator).select(
        F.lit("enrichment_rate").alias("rule"),
        severity.alias("severity"),
        rate.alias("observed"),
        F.when(rate < alert, alert).otherwise(warn).alias("threshold"),
        F.when(rate < warn, severity).otherwise("ok").alias("status"),
    )


def report_check(report: DataFrame) -> DataFrame:
    """Whether the report has rows, as a rule that fails when it has none."""
    totals = report.agg(F.count("*").alias("rows"))
    return _as_rows(totals, [_rule("report_nonempty", "fail", F.col("rows"), 0, F.col("rows") == 0)])


def raise_on_failure(checks: DataFrame) -> list[dict]:
    """Run the checks (one row per rule) and return them; raise if one failed."""
    results = [row.asDict() for row in checks.collect()]
    failed = [r["rule"] for r in results if r["status"] == "fail"]
    if failed:
        raise DataQualityError(f"failed rules: {', '.join(failed)}; results: {results}")
    return results
