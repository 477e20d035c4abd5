"""What Spark plans: few shuffles, pruned scans, no Python, no hinted broadcast."""

from __future__ import annotations

import pytest

from __spark_entry__ import queries
from fleetmart.catalog import roles
from fleetmart.operators import cleaning, enrich, quality

SF_DIR = "/root/testdata/sf0.001"


def plan(df, mode="simple"):
    execution = df._jdf.queryExecution()
    return execution.executedPlan().toString() if mode == "simple" else execution.optimizedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_and_no_cross_product(spark, name):
    text = plan(queries()[name](spark, SF_DIR))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_dedup_prunes_before_its_only_shuffle(spark):
    text = plan(queries()["dedup_by_key"](spark, SF_DIR))
    assert text.count("Exchange") == 1
    final, exchange, partial = (text.index(x) for x in (", 1, Final", "Exchange", ", 1, Partial"))
    assert final < exchange < partial


def test_positions_are_aggregated_below_the_join(spark, no_broadcast):
    text = plan(queries()["activity_agg"](spark, SF_DIR))
    join = text.index("SortMergeJoin")
    below = text[join:]
    assert below.count("partial_count(numero_do_veiculo") == 1
    assert "HashAggregate" not in text[:join]


def test_activity_needs_one_more_shuffle_per_step_only(spark, no_broadcast):
    # dedup, per line; register: distinct, copies, join
    assert plan(queries()["activity_agg"](spark, SF_DIR)).count("Exchange hashpartitioning") == 5


def test_activity_reads_four_position_columns(spark, tmp_path):
    path = str(tmp_path / "positions")
    cleaning.refine_positions(roles.raw_positions(spark, SF_DIR)).write.parquet(path)
    text = plan(enrich.line_activity(spark.read.parquet(path), None))
    schema = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["cod_linha", "event_timestamp", "latitude", "numero_do_veiculo"]


def test_report_keeps_k_rows_per_task(spark):
    for name in ("topk_activity", "topk_activity_sql"):
        assert "TakeOrderedAndProject(limit=10" in plan(queries()[name](spark, SF_DIR))


def test_quality_rules_scan_once(spark):
    raw = roles.raw_positions(spark, SF_DIR)
    text = plan(quality.positions_checks(cleaning.type_positions(cleaning.rename_exact(raw))))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1


def test_each_page_and_body_is_parsed_once(spark):
    text = plan(queries()["link_harvest"](spark, SF_DIR))
    assert text.count("<(?:!--") == 1
    text = plan(queries()["feed_unwrap"](spark, SF_DIR))
    assert text.count("from_json(") == 2  # one for lists, one for objects


def test_no_broadcast_is_forced(spark, no_broadcast):
    for name in ("left_enrich", "activity_agg", "left_enrich_salted", "fanout_enrich"):
        assert "Broadcast" not in plan(queries()[name](spark, SF_DIR))
