from __future__ import annotations

import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetmart.operators import enrich

POSITION = "cod_linha string, numero_do_veiculo string, event_timestamp timestamp, latitude double"
DIM = "cod_linha string, consorcio string, nome_linha string"
DIM_ROWS = [("8103", "801", "n"), ("8103", "801", "n"), ("SC01", "802", "n"), ("SC01", "803", "n"), (None, "804", "n")]


def positions(spark, rows):
    df = spark.createDataFrame(rows, "cod_linha string, numero_do_veiculo string, t int, latitude double")
    return df.select("cod_linha", "numero_do_veiculo", F.timestamp_seconds("t").alias("event_timestamp"), "latitude")


def joined_then_grouped(facts, dim):
    """The plain join and its groups in SQL, as the registered queries are judged."""
    return facts.sparkSession.sql(
        """
        SELECT f.cod_linha, d.consorcio, count(f.numero_do_veiculo) AS total_pings, max(f.event_timestamp) AS last_seen,
               min(f.latitude) AS min_lat, max(f.latitude) AS max_lat
        FROM {facts} f LEFT JOIN {dim} d ON f.cod_linha = d.cod_linha
        GROUP BY ALL
        """,
        facts=facts,
        dim=dim,
    )


def bag(df):
    return Counter(tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in row) for row in df.collect())


def test_activity_of_a_dimension_with_repeated_rows(spark):
    pings = [("8103", "v1"), ("8103", "v2"), ("sc01", "v1"), ("SC01", "v3"), ("999", "v4"), (None, "v5")]
    facts = positions(spark, [(line, v, 1, 1.0) for line, v in pings])
    got = enrich.line_activity(facts, spark.createDataFrame(DIM_ROWS, DIM))
    assert sorted((str(r["cod_linha"]), str(r["consorcio"]), r["total_pings"]) for r in got.collect()) == [
        ("8103", "801", 4), ("999", "None", 1), ("None", "None", 1), ("SC01", "802", 1), ("SC01", "803", 1),
        ("sc01", "None", 1),
    ]


codes = st.sampled_from(["a", "b", "c", None])
facts_rows = st.lists(
    st.tuples(codes, st.sampled_from(["v", "w", None]), st.one_of(st.none(), st.integers(0, 9)),
              st.sampled_from([None, 1.0, -2.0, math.nan])),
    min_size=1, max_size=30,
)
dim_rows = st.lists(st.tuples(codes, st.sampled_from(["x", "y", None]), st.just("n")), min_size=1, max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(facts_rows, dim_rows)
def test_aggregating_before_the_join_changes_nothing(spark, rows, dims):
    facts, dim = positions(spark, rows), spark.createDataFrame(dims, DIM)
    assert bag(enrich.line_activity(facts, dim)) == bag(joined_then_grouped(facts, dim))


@pytest.mark.parametrize("salts", [1, 3])
def test_left_enrich_keeps_every_fact_and_match(spark, salts):
    facts = positions(spark, [("8103", "v", 1, 1.0)] * 20 + [("SC01", "v", 1, 1.0), (None, "v", 1, 1.0), ("z", "v", 1, 1.0)])
    dim = spark.createDataFrame(DIM_ROWS, DIM)
    got = enrich.left_enrich(facts.repartition(4), dim, "cod_linha", salts=salts)
    assert got.columns == facts.join(dim, "cod_linha", "left").columns
    assert bag(got) == bag(facts.join(dim, "cod_linha", "left"))
    assert got.count() == 44


def test_without_dimension(spark):
    facts = positions(spark, [("1", "v", 1, 1.0), ("1", None, 2, 3.0)])
    row = enrich.line_activity(facts, None).first()
    assert (row["consorcio"], row["total_pings"], row["min_lat"], row["max_lat"]) == ("Desconhecido", 1, 1.0, 3.0)
    assert enrich.without_dimension(facts).first()["nome_linha"] == "Desconhecido"


def test_nan_is_the_greatest_latitude(spark):
    facts = positions(spark, [("1", "v", 1, math.nan), ("1", "v", 1, 1.0), ("1", "v", 1, None)])
    row = enrich.line_activity(facts, None).first()
    assert row["min_lat"] == 1.0 and math.isnan(row["max_lat"])


def test_report_ties_have_an_order(spark):
    rows = [(line, op, n, None) for line, op, n in [("b", "x", 2), ("a", "y", 2), ("a", None, 2), ("c", "x", 9)]]
    activity = spark.createDataFrame(rows, "cod_linha string, consorcio string, total_pings bigint, last_seen timestamp")
    expected = [("c", "x"), ("a", None), ("a", "y")]
    for top in (enrich.busiest_lines(activity, 3), enrich.busiest_lines_sql(activity, 3)):
        assert [(r[0], r[1]) for r in top.collect()] == expected
