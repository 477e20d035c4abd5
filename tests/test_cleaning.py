from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from fleetmart.operators import cleaning

RAW = "LT string, LG string, NV string, NL string, HR string, extra string"
T1, T2 = "20240131120000", "20240131120100"


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_rename_compares_names_with_their_case(spark):
    df = spark.createDataFrame([("1", "2", "3")], "lt string, LG string, x string")
    assert cleaning.rename_exact(df).columns == ["lt", "longitude", "x"]


def test_columns_of_the_refined_table(spark):
    refined = cleaning.refine_positions(raw(spark, [("1,5", "2,5", "v", "8103", T1, "e")]))
    assert refined.dtypes == [
        ("latitude", "double"), ("longitude", "double"), ("numero_do_veiculo", "string"),
        ("cod_linha", "string"), ("datahora_raw", "string"), ("extra", "string"),
        ("event_timestamp", "timestamp"), ("_processed_at", "timestamp"),
    ]
    row = refined.first()
    assert (row["latitude"], row["longitude"], row["datahora_raw"]) == (1.5, 2.5, T1)


def test_rows_without_coordinates_go_and_nan_stays(spark):
    rows = [("None", "1", "a", "l", T1, ""), ("1", None, "b", "l", T1, ""), ("nan", "1", "c", "l", T1, ""), ("1", "1", "d", "l", T1, "")]
    kept = cleaning.refine_positions(raw(spark, rows))
    assert sorted(r["numero_do_veiculo"] for r in kept.collect()) == ["c", "d"]
    strict = cleaning.refine_positions(raw(spark, rows), reject_nan=True)
    assert [r["numero_do_veiculo"] for r in strict.collect()] == ["d"]


def test_dedup_takes_nulls_as_equal(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", 1), (None, 1), (None, 1)], "k string, n int")
    assert cleaning.dedup_by_key(df, ["k", "n"]).count() == 3


def test_unreadable_times_of_a_vehicle_collapse(spark):
    rows = [("1", "1", "a", "l", bad, str(i)) for i, bad in enumerate(["None", "", "x", None, "20240131120000.0"])]
    refined = cleaning.refine_positions(raw(spark, [*rows, ("1", "1", "a", "l", T1, "9")]))
    assert sorted(str(r["event_timestamp"]) for r in refined.collect()) == ["2024-01-31 12:00:00", "None"]


def test_dedup_survivor_does_not_depend_on_row_order(spark):
    rows = [(str(i % 7), str(i), "v", "l", T1, "e") for i in range(50)]
    first = cleaning.refine_positions(raw(spark, rows)).drop("_processed_at").collect()
    second = cleaning.refine_positions(raw(spark, rows[::-1]).repartition(5)).drop("_processed_at").collect()
    assert first == second and len(first) == 1


def test_dedup_by_all_columns(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None)], "k int, v string")
    assert sorted(map(tuple, cleaning.dedup_by_key(df, ["k", "v"]).collect())) == [(1, "a"), (2, None)]


def test_dedup_with_map_columns(spark):
    df = spark.createDataFrame([(1, {"a": "b"}, 2), (1, {"a": "c"}, 1)], "k int, m map<string,string>, o int")
    assert [(r["k"], r["o"]) for r in cleaning.dedup_by_key(df, ["k"]).collect()] == [(1, 1)]


def test_without_raw_time_one_row_per_vehicle(spark):
    rows = [("1", "1", "a", "l", T1, "x"), ("1", "1", "a", "l", T2, "y"), ("1", "1", "b", "l", T2, "y")]
    now = F.lit("2024-06-01 00:00:00").cast("timestamp")
    refined = cleaning.refine_positions(raw(spark, rows).drop("HR"), now=now)
    got = refined.select("numero_do_veiculo", F.col("event_timestamp").cast("timestamp_ntz")).collect()
    assert sorted(map(tuple, got)) == [(v, datetime.datetime(2024, 6, 1)) for v in "ab"]
    wall_clock = cleaning.refine_positions(raw(spark, rows).drop("HR"))
    assert wall_clock.count() == 2 and wall_clock.filter("event_timestamp = _processed_at").count() == 2


@pytest.mark.parametrize("column", ["LT", "LG", "NV"])
def test_missing_essential_column_passes_rows_through(spark, column):
    rows = [("None", "None", "a", "l", T1, "")] * 3
    refined = cleaning.refine_positions(raw(spark, rows).drop(column))
    assert refined.count() == 3
    assert cleaning.missing_essentials(refined) == [cleaning.C.POSITION_FIELDS[column]]


def test_line_codes_come_as_they_are(spark):
    rows = [("1", "1", "a", " sc01", T1, "")]
    assert cleaning.refine_positions(raw(spark, rows)).first()["cod_linha"] == " sc01"
    assert cleaning.refine_positions(raw(spark, rows), normalize_key=True).first()["cod_linha"] == "SC01"


def test_stringify_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, True)], "a int, `b.c` double, d boolean")
    text = cleaning.stringify_all(df)
    assert {t for _, t in text.dtypes} == {"string"}
    assert tuple(text.first()) == ("1", None, "true")
