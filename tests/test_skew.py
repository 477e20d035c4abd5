"""One key, page, body or group of copies with a third of the rows and more."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from fleetmart.operators import cleaning, enrich, quality
from fleetmart.sinks.writers import cluster_rows
from fleetmart.sources import links

N = 30_000


def hot(column, value):
    """``value`` on a third of the rows, another value per row elsewhere."""
    return F.when(F.col("id") % 3 == 0, value).otherwise(column)


def positions(spark):
    return spark.range(0, N, 1, 8).select(
        hot(F.concat(F.lit("L"), F.col("id") % 500), "HOT").alias("cod_linha"),
        hot(F.concat(F.lit("V"), F.col("id") % 900), "VHOT").alias("numero_do_veiculo"),
        F.when(F.col("id") % 3 != 0, F.timestamp_seconds("id")).alias("event_timestamp"),
        (F.col("id") % 90).cast("double").alias("latitude"),
        F.lit(1.0).alias("longitude"),
        "id",
    )


def test_copies_of_a_key_leave_one_row_per_task(spark):
    df = positions(spark)
    survivors = cleaning.dedup_by_key(df, ["numero_do_veiculo", "event_timestamp"], order_by=["id"])
    assert survivors.count() == N - N // 3 + 1
    assert survivors.filter("numero_do_veiculo = 'VHOT'").first()["id"] == 0
    # rows entering the shuffle, as the partial limit leaves them: one per key and task
    plan = survivors._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("Partial")


@pytest.mark.parametrize("salts", [1, 8])
def test_hot_line_joins_whole(spark, salts):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        facts = positions(spark).select("id", "cod_linha")
        dim = spark.createDataFrame([("HOT", "a"), ("HOT", "b"), ("L1", "c")], "cod_linha string, consorcio string")
        joined = enrich.left_enrich(facts, dim, "cod_linha", salts=salts)
        per_task = joined.rdd.mapPartitions(lambda rows: [sum(r["cod_linha"] == "HOT" for r in rows)]).collect()
        assert sum(per_task) == 2 * N // 3
        if salts > 1:
            assert max(per_task) < sum(per_task) * 0.6
        assert joined.select("id").distinct().count() == N
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_spark_splits_the_hot_line_of_an_unsalted_join(spark):
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        dim = spark.range(500).select(F.concat(F.lit("L"), "id").alias("cod_linha"), F.lit("op").alias("consorcio"))
        joined = enrich.left_enrich(positions(spark).select("id", "cod_linha"), dim, "cod_linha")
        assert len(joined.collect()) == N
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in small:
            spark.conf.unset(key)


def test_hot_line_on_both_sides_is_counted_without_pairs(spark):
    # 10,000 positions x 10,000 register copies of one line: 10^8 pairs if they were joined
    dim = spark.range(N).select(hot(F.lit("L1"), "HOT").alias("cod_linha"), F.lit("op").alias("consorcio"))
    got = enrich.line_activity(positions(spark).withColumn("numero_do_veiculo", F.lit("v")), dim)
    row = got.filter("cod_linha = 'HOT'").first()
    assert row["total_pings"] == (N // 3) * (N // 3)


def test_null_line_is_one_group(spark):
    facts = positions(spark).withColumn("cod_linha", F.when(F.col("cod_linha") != "HOT", F.col("cod_linha")))
    dim = spark.createDataFrame([(None, "x"), ("L1", "y")], "cod_linha string, consorcio string")
    rows = enrich.line_activity(facts, dim).filter("cod_linha IS NULL").collect()
    assert [(r["consorcio"], r["total_pings"]) for r in rows] == [(None, N // 3)]


def test_duplicate_groups_of_a_hot_key(spark):
    checks = {r["rule"]: r["observed"] for r in quality.positions_checks(positions(spark)).collect()}
    assert checks["duplicate_keys"] == 1 and checks["volume"] == N


def test_copies_are_cut_over_clustered_files(spark):
    copies = spark.range(0, N, 1, 8).select(hot(F.col("id"), 5).alias("k"), F.lit("same").alias("v"))
    sizes = cluster_rows(copies, ["k"], files=6).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == N and max(sizes) < N / 3


def test_a_page_with_a_third_of_all_links(spark):
    many = "".join(f'<a href="/{i}.csv">file {2022 + i % 4}</a>' for i in range(5_000))
    rows = [(0, many)] + [(p, '<a href="/a.csv">2023</a><a href="/b.csv">x</a>' * 2) for p in range(1, 2_500)]
    pages = spark.createDataFrame([(p, "http://h.org/", h) for p, h in rows], "page_id int, url string, html string").repartition(4)
    found = links.harvest_links(pages)
    assert found.count() == 5_000 + 4 * 2_499
    latest = Counter((r["href"], r["year"]) for r in links.latest_resource(found, newest_year=2026).collect())
    # the year may stand in the address: only 2026.csv names the newest one
    assert latest == {("http://h.org/2026.csv", 2026): 1, ("http://h.org/a.csv", 2023): 2_499}
