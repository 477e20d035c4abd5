from __future__ import annotations

import datetime
import math

import pytest
from pyspark.sql import functions as F

from fleetmart.functions.parse import clean_code, compact_timestamp, decimal_comma, named


def one(spark, value, expression):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(expression(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("19,90", 19.90), ("-43,123", -43.123), (None, None), ("None", None), ("1.234,56", None),
        ("1,2,3", None), ("", None), (" 5,5 ", 5.5), ("inf", math.inf), ("12", 12.0),
    ],
)
def test_decimal_comma(spark, text, number):
    assert one(spark, text, decimal_comma) == number


def test_decimal_comma_nan(spark):
    assert math.isnan(one(spark, "nan", decimal_comma))


@pytest.mark.parametrize(
    ("text", "time"),
    [
        ("20240131120000", datetime.datetime(2024, 1, 31, 12)), ("2024-01-31", None), ("None", None),
        ("20240131", None), ("20240131120000.0", None), (None, None), ("20241331120000", None),
    ],
)
def test_compact_timestamp(spark, text, time):
    assert one(spark, text, lambda c: compact_timestamp(c).cast("timestamp_ntz")) == time


def test_clean_code_of_columns_with_blanks_in_their_names(spark):
    df = spark.createDataFrame([("8103 ", " sc01")], "LINHA string, `COD ` string")
    row = df.select(clean_code(named("LINHA")).alias("a"), clean_code(named("COD ")).alias("b")).first()
    assert tuple(row) == ("8103", "SC01")


def test_clean_code_cuts_blanks_only(spark):
    assert one(spark, "\ta ", clean_code) == "\tA"
    assert one(spark, None, clean_code) is None


def test_ansi_mode_is_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_times_are_read_in_the_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        seconds = one(spark, "20240131120000", lambda c: F.unix_timestamp(compact_timestamp(c)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seconds == datetime.datetime(2024, 1, 31, 15, tzinfo=datetime.timezone.utc).timestamp()
