from __future__ import annotations

import json
from datetime import datetime

import pytest

from fleetmart.plans import medallion
from fleetmart.plans.layout import Layout
from fleetmart.sources import feeds


def records(spark, *bodies, **options):
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    return [r["record"] for r in feeds.unwrap_feed(df, **options).collect()]


RECORD = {"NL": "1", "NV": "a"}
TEXT = json.dumps(RECORD)


@pytest.mark.parametrize(
    "body",
    [
        f"[{TEXT}]", f" \n[{TEXT}]", f'{{"entidades": [{TEXT}]}}', f'{{"entidades": [], "records": [{TEXT}]}}',
        f'{{"entidades": null, "records": [{TEXT}]}}', f'{{"result": {{"records": [{TEXT}]}}}}',
        f'{{"records": [], "result": {{"records": [{TEXT}]}}}}', f'<pre>{{"records": [{TEXT}]}}</pre>',
        f'ok: {{\n"entidades": [{TEXT}]\n}}\n-- end',
    ],
)
def test_envelopes(spark, body):
    assert records(spark, body) == [RECORD]


def test_first_filled_envelope_wins(spark):
    body = json.dumps({"result": {"records": [{"a": "3"}]}, "records": [{"a": "2"}], "entidades": [{"a": "1"}, {"a": "0"}]})
    assert records(spark, body) == [{"a": "1"}, {"a": "0"}]


@pytest.mark.parametrize(
    "body", ["nada", '{"entidades":[]}', "[]", "", None, "}{", "{", f"<pre>[{TEXT}]</pre>", '{"records": 5}', '{"result": {}}']
)
def test_bodies_without_records(spark, body):
    assert records(spark, body) == []
    df = spark.createDataFrame([(body,)], "body string")
    with pytest.raises(feeds.EmptyInputError):
        feeds.require_rows(feeds.unwrap_feed(df), "feed")


def test_salvage_can_be_left_out(spark):
    assert records(spark, f'<pre>{{"records": [{TEXT}]}}</pre>', salvage=False) == []


def test_values_are_text_and_missing_fields_null(spark):
    body = '[{"NL": 123, "HR": 20240131120000, "LT": "-19,9"}, {"HR": null, "LT": null}, {"NL": 5, "ok": true}]'
    df = spark.createDataFrame([(body,)], "body string")
    table = feeds.tabulate(feeds.unwrap_feed(df))
    assert table.columns == ["HR", "LT", "NL", "ok"]
    assert [tuple(r) for r in table.collect()] == [
        ("20240131120000", "-19,9", "123", None), (None, None, None, None), (None, None, "5", "true"),
    ]


def test_wanted_fields_and_kept_columns(spark):
    df = spark.createDataFrame([("f1", f"[{TEXT}]"), ("f2", f'{{"records": [{TEXT}, {{}}]}}')], "file string, body string")
    table = feeds.tabulate(feeds.unwrap_feed(df, keep=["file"]), ["NV", "XX"], keep=["file"])
    assert [tuple(r) for r in table.collect()] == [("f1", "a", None), ("f2", "a", None), ("f2", None, None)]


def test_bodies_are_read_whole(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"{n}.json").write_text(json.dumps({"records": [{"n": str(n)}, {"n": "x"}]}, indent=2))
    got = feeds.tabulate(feeds.unwrap_feed(feeds.read_bodies(spark, str(tmp_path))))
    assert sorted(r["n"] for r in got.collect()) == ["0", "1", "2", "x", "x", "x"]


def test_a_large_body_keeps_all_records(spark):
    body = json.dumps({"records": [{"n": str(i), "pad": "x" * 50} for i in range(40_000)]})
    df = spark.createDataFrame([("junk " + body,)], "body string")
    got = feeds.tabulate(feeds.unwrap_feed(df), ["n"])
    assert got.distinct().count() == 40_000


def test_a_feed_of_many_field_names_lands(spark, tmp_path):
    body = json.dumps([{f"k{i}": str(i) for i in range(5_000)}])
    df = spark.createDataFrame([(body,)], "body string")
    layout = Layout(str(tmp_path))
    medallion.land_positions(df, layout, datetime(2024, 6, 1))
    landed = spark.read.parquet(layout.path("landed_positions"))
    assert len([c for c in landed.columns if c.startswith("k")]) == 5_000
    assert landed.select("k4999").collect()[0][0] == "4999"


GOOD = {f'[{TEXT}]', f' {{"records": [{TEXT}]}} ', f'<pre>{{"records": [{TEXT}]}}</pre>'}
BAD = {
    None: "empty",
    "  ": "empty",
    f'{{"records": [{TEXT}': "not JSON",
    f"[{TEXT}": "not JSON",
    "<html>503</html>": "not JSON",
    f"[{TEXT}, 3]": "no records",
    f'{{"records": [{TEXT}, 3]}}': "no records",
    f"\ufeff[{TEXT}]": "not JSON",
    f'{{"records": [{TEXT}]}}{{"records": [{TEXT}]}}': "not JSON",
    f"[{TEXT}][{TEXT}]": "not JSON",
    f"[{TEXT}] trailing": "not JSON",
    f"[{TEXT}], [{TEXT}]": "no records",
    '{"entidades": []}': "no records",
    "[]": "no records",
}


def test_no_body_vanishes(spark):
    df = spark.createDataFrame([(b,) for b in [*GOOD, *BAD]], "body string")
    rows = feeds.split_feed(df, keep=["body"]).collect()
    assert {r["body"]: r["reject"] for r in rows} == {**dict.fromkeys(GOOD), **BAD}
    assert all((r["record"] is None) == (r["reject"] is not None) for r in rows)


def test_bad_bodies_stop_the_landing(spark, tmp_path):
    df = spark.createDataFrame([(b,) for b in [*GOOD, "<html>503</html>", "[]", "[]"]], "body string")
    layout = Layout(str(tmp_path))
    with pytest.raises(feeds.UnusableBodyError, match="3 bodies"):
        medallion.land_positions(df, layout, datetime(2024, 6, 1))
    assert not (tmp_path / "landing").exists()
    with pytest.raises(feeds.EmptyInputError):
        medallion.land_positions(df.limit(0), layout, datetime(2024, 6, 1))


@pytest.mark.parametrize("fields", [None, ["NV"]])
def test_bodies_are_read_once(spark, tmp_path, fields):
    for n in range(3):
        (tmp_path / f"{n}.json").write_text(f"[{TEXT}]")
    reads = spark.sparkContext.accumulator(0)

    def counted(rows):
        for row in rows:
            reads.add(1)
            yield row

    df = spark.createDataFrame(feeds.read_bodies(spark, str(tmp_path)).rdd.mapPartitions(counted), "body string")
    medallion.land_positions(df, Layout(str(tmp_path / "lake")), datetime(2024, 6, 1), fields=fields)
    assert reads.value == 3
