from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fleetmart.operators import quality

SCHEMA = "numero_do_veiculo string, event_timestamp timestamp, latitude double, longitude double"


def positions(spark, rows):
    df = spark.createDataFrame(rows, "numero_do_veiculo string, t int, latitude double, longitude double")
    return df.withColumn("event_timestamp", F.timestamp_seconds("t"))


def by_rule(df):
    return {r["rule"]: (r["observed"], r["status"]) for r in df.collect()}


ROWS = [("a", 1, 1.0, 1.0), ("a", 1, None, 1.0), ("b", 5, 1.0, None), ("b", None, 1.0, 1.0), ("b", None, 1.0, 1.0), ("c", 9, 1.0, 1.0)]


def test_all_rules_in_one_job(spark):
    as_of = F.timestamp_seconds(F.lit(5))
    assert by_rule(quality.positions_checks(positions(spark, ROWS), as_of=as_of)) == {
        "volume": (6.0, "ok"), "null_coordinates": (2.0, "warn"), "future_timestamps": (1.0, "warn"), "duplicate_keys": (2.0, "warn"),
    }


def test_scan_rules_agree_with_the_single_job(spark):
    as_of = F.timestamp_seconds(F.lit(5))
    df = positions(spark, ROWS)
    scan = by_rule(quality.positions_scan_checks(df, as_of=as_of))
    scan |= by_rule(quality.duplicate_key_check(df, quality.C.POSITION_KEY))
    assert scan == by_rule(quality.positions_checks(df, as_of=as_of))


def test_empty_table_fails(spark):
    empty = positions(spark, ROWS).limit(0)
    assert by_rule(quality.positions_checks(empty))["volume"] == (0.0, "fail")
    assert by_rule(quality.positions_scan_checks(empty))["volume"] == (0.0, "fail")
    with pytest.raises(quality.DataQualityError, match="volume"):
        quality.raise_on_failure(quality.positions_checks(empty))


def test_warnings_do_not_stop_a_run(spark):
    results = quality.raise_on_failure(quality.positions_checks(positions(spark, ROWS)))
    assert [r["status"] for r in results] == ["ok", "warn", "warn"]


@pytest.mark.parametrize(
    ("enriched", "unknown", "status"),
    [(0, 0, "alert"), (99, 9901, "alert"), (1, 99, "warn"), (499, 501, "warn"), (1, 1, "ok"), (3, 0, "ok")],
)
def test_enrichment_bands(spark, enriched, unknown, status):
    blanks = F.element_at(F.array(F.lit(None).cast("string"), F.lit("Desconhecido"), F.lit("N/A")), (F.col("id") % 3 + 1).cast("int"))
    df = spark.range(enriched).select(F.lit("801").alias("consorcio")).union(spark.range(unknown).select(blanks))
    row = quality.enrichment_check(df).first()
    total = enriched + unknown
    assert row["status"] == status
    assert row["observed"] == (enriched / total * 100 if total else 0.0)


def test_report_rule(spark):
    assert quality.report_check(spark.range(3)).first()["status"] == "ok"
    with pytest.raises(quality.DataQualityError):
        quality.raise_on_failure(quality.report_check(spark.range(0)))
