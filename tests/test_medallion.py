from __future__ import annotations

import datetime
import json
import random
import shutil

import pytest
from pyspark.sql import functions as F

from fleetmart.__main__ import main
from fleetmart.operators.quality import DataQualityError
from fleetmart.plans import medallion
from fleetmart.plans.layout import Layout
from fleetmart.sinks.writers import append_landing
from fleetmart.sources.feeds import EmptyInputError
from fleetmart.sources.tables import load_table

RUN = datetime.datetime(2024, 6, 1, 6)


def ping(vehicle, line, time="20240131120000", lat="-19,9"):
    return {"LT": lat, "LG": "-43,9", "NV": vehicle, "NL": line, "HR": time}


PINGS = [
    ping("v1", "8103"), ping("v1", "8103"), ping("v2", "8103", "20240131120500", "-19,5"), ping("v3", "SC01"), ping("v4", "999"),
    ping("v5", "999", lat=None), ping("v6", "sc01", "bad"),
]


def bodies(spark, *lists):
    return spark.createDataFrame([(json.dumps({"records": pings}),) for pings in lists], "body string")


@pytest.fixture
def register(tmp_path):
    file = tmp_path / "register 2024.csv"
    file.write_text("linha;concessionária;viagem\n8103 ;801;1\n8103;801;2\n sc01;802;3\nSC01;803;4\n", encoding="utf-8")
    return str(file)


def activity(spark, layout):
    rows = load_table(spark, layout.path("activity")).collect()
    return sorted((r["cod_linha"], r["consorcio"] or "", r["total_pings"]) for r in rows)


EXPECTED = [("8103", "801", 4), ("999", "", 1), ("SC01", "802", 1), ("SC01", "803", 1), ("sc01", "", 1)]


def test_whole_run(spark, tmp_path, register):
    layout = Layout(str(tmp_path / "lake"))
    run = medallion.run_daily(spark, layout, RUN, bodies=bodies(spark, PINGS[:3], PINGS[3:]), register=register)
    assert [(s.stage, s.status) for s in run.stages] == [
        (stage, "written") for stage in ("land_positions", "land_register", "refine_positions", "refine_register", "build_activity")
    ]
    assert activity(spark, layout) == EXPECTED
    assert {c["rule"]: c["status"] for c in run.checks} == {
        "volume": "ok", "null_coordinates": "ok", "future_timestamps": "ok", "duplicate_keys": "ok", "enrichment_rate": "ok",
    }
    top = run.report.collect()
    assert run.report.columns == ["cod_linha", "consorcio", "total_pings", "last_seen"]
    assert (top[0]["cod_linha"], top[0]["total_pings"], str(top[0]["last_seen"])) == ("8103", 4, "2024-01-31 12:05:00")
    row = load_table(spark, layout.path("activity")).filter("cod_linha = '8103'").first()
    assert (row["min_lat"], row["max_lat"]) == (-19.9, -19.5)


def test_rerun_gives_the_same_tables(spark, tmp_path, register):
    layout = Layout(str(tmp_path / "lake"))
    for hour in (6, 18):
        medallion.run_daily(spark, layout, RUN.replace(hour=hour), bodies=bodies(spark, PINGS), register=register)
    # positions of both runs are landed and deduplicated, the register's day is replaced
    assert activity(spark, layout) == EXPECTED
    landed = spark.read.parquet(layout.path("landed_positions"))
    assert landed.count() == 2 * len(PINGS) and spark.read.parquet(layout.path("landed_register")).count() == 4


def test_register_chosen_from_a_catalogue(spark, tmp_path, register):
    html = '<a href="/old%202023.csv">2023</a><a href="register%202024.csv">2024</a><a href="/last.csv">none</a>'
    pages = spark.createDataFrame([(1, f"file://{tmp_path}/index.html", html)], "page_id int, url string, html string")
    assert medallion.choose_register(pages, 2026) == f"file://{tmp_path}/register%202024.csv"
    other = spark.createDataFrame([(2, f"file://{tmp_path}/", '<a href="/other.csv">2025</a>')], pages.schema)
    with pytest.raises(ValueError, match="several"):
        medallion.choose_register(pages.union(other), 2026)
    plain = pages.withColumn("html", F.replace("html", F.lit("%20"), F.lit(" ")))
    layout = Layout(str(tmp_path / "lake"))
    medallion.run_daily(spark, layout, RUN, bodies=bodies(spark, PINGS), pages=plain)
    assert activity(spark, layout) == EXPECTED


def test_catalogue_without_links(spark):
    pages = spark.createDataFrame([(1, "http://h.org/", "<a href='/x.pdf'>2024</a>")], "page_id int, url string, html string")
    with pytest.raises(EmptyInputError, match="catalogue"):
        medallion.choose_register(pages, 2026)


def test_without_register_all_lines_are_unknown(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    run = medallion.run_daily(spark, layout, RUN, bodies=bodies(spark, PINGS))
    assert {s.stage: s.status for s in run.stages}["refine_register"] == "skipped"
    assert run.stages[-1].detail == "no register"
    assert activity(spark, layout) == [("8103", "Desconhecido", 2), ("999", "Desconhecido", 1), ("SC01", "Desconhecido", 1), ("sc01", "Desconhecido", 1)]
    assert run.checks[-1]["status"] == "alert"


def test_register_without_line_column_is_skipped(spark, tmp_path):
    file = tmp_path / "r.csv"
    file.write_text("rota;concessionaria\n1;2\n")
    layout = Layout(str(tmp_path / "lake"))
    medallion.land_register(spark, str(file), layout, RUN)
    result = medallion.refine_register(spark, layout)
    assert result.status == "skipped" and "LINHA" in result.detail


def test_no_positions_at_all(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    assert medallion.refine_positions(spark, layout).status == "skipped"
    assert medallion.build_activity(spark, layout).status == "skipped"
    with pytest.raises(medallion.StageError, match="no landed positions"):
        medallion.run_daily(spark, layout, RUN)


def test_empty_feed_stops_the_run(spark, tmp_path):
    with pytest.raises(EmptyInputError, match="feed"):
        medallion.land_positions(bodies(spark, []), Layout(str(tmp_path)), RUN)


def test_missing_essential_column_is_written_unchecked(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    pings = [{k: v for k, v in p.items() if k != "LG"} for p in PINGS]
    medallion.land_positions(bodies(spark, pings), layout, RUN)
    result = medallion.refine_positions(spark, layout)
    assert result.status == "unchecked" and "longitude" in result.detail
    assert load_table(spark, layout.path("positions")).count() == len(PINGS)


def test_all_positions_unusable_fails_the_gate(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    with pytest.raises(DataQualityError, match="volume"):
        medallion.run_daily(spark, layout, RUN, bodies=bodies(spark, [ping("v", "l", lat="x")]))


def refined(spark, layout):
    table = load_table(spark, layout.path("positions")).drop("_processed_at", "_event_day", "_event_part")
    # as text: Python has no year 0
    return sorted(map(str, table.select([F.col(c).cast("string") for c in sorted(table.columns)]).collect()))


def days_of(tmp_path, lake):
    newest = max((tmp_path / lake / "refined" / "positions").glob("_v*"))
    return sorted(p.name.split("=")[1] for p in newest.glob("_event_day=*"))


def test_refining_new_days_equals_refining_all(spark, tmp_path):
    rng = random.Random(3)

    def some_pings():
        times = [f"202401{day:02d}{hour:02d}0000" for day in range(1, 6) for hour in (6, 7)] + ["bad", None, "00000101000000"]
        return [ping(f"v{rng.randint(0, 4)}", rng.choice("ab"), rng.choice(times), rng.choice(["1,5", "2,5", "x"])) for _ in range(80)]

    daily, whole = (Layout(str(tmp_path / name), by_event_day=True) for name in ("daily", "whole"))
    plain = Layout(str(tmp_path / "plain"))
    for day in (1, 2, 3):
        run_ts, landed = RUN.replace(day=day), bodies(spark, some_pings(), [ping("new", "a", f"202402{day:02d}000000")])
        for layout in (daily, whole, plain):
            medallion.land_positions(landed, layout, run_ts)
        medallion.refine_new_positions(spark, daily, f"2024-06-{day:02d}")
    medallion.refine_positions(spark, whole)
    medallion.refine_positions(spark, plain)
    assert refined(spark, daily) == refined(spark, whole) == refined(spark, plain)
    assert days_of(tmp_path, "daily") == days_of(tmp_path, "whole")
    again = refined(spark, daily)
    medallion.refine_new_positions(spark, daily, "2024-06-02")
    assert refined(spark, daily) == again
    for layout in (daily, plain):
        medallion.build_activity(spark, layout)
    assert activity(spark, daily) == activity(spark, plain)


def test_refining_new_days_leaves_other_days_alone(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"), by_event_day=True)
    medallion.run_daily(spark, layout, RUN, bodies=bodies(spark, [ping("v", "l", "20240101000000"), ping("w", "l", "20240102000000")]))
    untouched = sorted((tmp_path / "lake" / "refined" / "positions").glob("_v*/_event_day=2024-01-01/*/*.parquet"))
    assert len(untouched) == 1
    later = RUN.replace(day=2)
    run = medallion.run_daily(spark, layout, later, bodies=bodies(spark, [ping("x", "l", "20240102000000")]), since="2024-06-02")
    assert [s.detail for s in run.stages if s.stage == "refine_positions"] == ["positions landed since 2024-06-02"]
    assert sorted(untouched[0].parent.glob("*.parquet")) == untouched
    assert activity(spark, layout) == [("l", "Desconhecido", 3)]


def test_new_positions_on_very_many_days_keep_archived_ones(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"), by_event_day=True)
    old = [ping("v", "l", f"201901{day:02d}000000") for day in range(1, 4)]
    medallion.run_daily(spark, layout, RUN, bodies=bodies(spark, old))
    shutil.move(str(tmp_path / "lake" / "landing" / "positions" / "partition_date=2024-06-01"), str(tmp_path / "archive"))
    start = datetime.datetime(2020, 1, 1)
    fresh = [ping("v", "l", f"{start + datetime.timedelta(days=d):%Y%m%d}000000") for d in range(1_100)]
    run = medallion.run_daily(spark, layout, RUN.replace(day=2), bodies=bodies(spark, fresh), since="2024-06-02")
    assert len(refined(spark, layout)) == 1_103
    assert activity(spark, layout) == [("l", "Desconhecido", 1_103)]
    assert {c["rule"]: c["observed"] for c in run.checks}["volume"] == 1_103


def test_fields_that_appear_later(spark, tmp_path):
    """Day 2 brings a field, and the time, in the same landing folder."""
    first = [{"LT": "1", "LG": "1", "NV": "v", "NL": "l"}]
    second = [{**ping("w", "l", "20240102030405"), "extra": "new"}]
    tables = []
    for by_event_day in (False, True):
        layout = Layout(str(tmp_path / f"lake{by_event_day}"), by_event_day=by_event_day)
        for day, pings in enumerate((first, second), 1):
            medallion.land_positions(bodies(spark, pings), layout, RUN.replace(day=day))
            if by_event_day and day == 2:
                medallion.refine_new_positions(spark, layout, "2024-06-02")
            else:
                medallion.refine_positions(spark, layout)
        got = load_table(spark, layout.path("positions"))
        tables.append({r["numero_do_veiculo"]: (str(r["event_timestamp"]), r["extra"]) for r in got.collect()})
    assert tables[0] == {"v": ("None", None), "w": ("2024-01-02 03:04:05", "new")}
    assert tables[1]["w"] == tables[0]["w"] and tables[1]["v"][1] is None


def test_new_fields_give_the_table_of_a_whole_refresh(spark, tmp_path):
    first = [ping("v", "l", "20240101000000"), ping("w", "l", "20240101000000")]
    second = [{**ping("v", "l", "20240101000000"), "LT": "0,5", "extra": "new"}, {**ping("x", "l", "20240101000000"), "extra": "new"}]
    daily, plain = Layout(str(tmp_path / "daily"), by_event_day=True), Layout(str(tmp_path / "plain"))
    for layout in (daily, plain):
        medallion.run_daily(spark, layout, RUN, bodies=bodies(spark, first))
        since = "2024-06-02" if layout.by_event_day else None
        medallion.run_daily(spark, layout, RUN.replace(day=2), bodies=bodies(spark, second), since=since)
    columns = ["numero_do_veiculo", "latitude", "extra", "event_timestamp"]
    rows = [sorted(map(str, load_table(spark, x.path("positions")).select(columns).collect())) for x in (daily, plain)]
    assert rows[0] == rows[1] and activity(spark, daily) == activity(spark, plain)


def test_incremental_stages_read_the_touched_days_alone(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"), by_event_day=True)
    medallion.run_daily(spark, layout, RUN, bodies=bodies(spark, [ping("v", "l", f"202401{d:02d}000000") for d in range(1, 29)]))
    medallion.land_positions(bodies(spark, [ping("w", "m", "20240103000000")]), layout, RUN.replace(day=2))
    days = medallion.touched_days(spark, layout, "2024-06-02")
    some = medallion.on_days(load_table(spark, layout.path("positions")), days)
    assert some.count() == 1
    assert "dynamicpruning" in some._jdf.queryExecution().executedPlan().toString()


def test_a_skipped_register_is_reported(spark, tmp_path, register):
    layout = Layout(str(tmp_path / "lake"))
    medallion.run_daily(spark, layout, RUN, bodies=bodies(spark, PINGS), register=register)
    shutil.rmtree(tmp_path / "lake" / "landing" / "register")
    run = medallion.run_daily(spark, layout, RUN.replace(day=2))
    assert "register not refined" in next(s.detail for s in run.stages if s.stage == "build_activity")


def test_refining_new_days_asks_for_a_whole_refresh(spark, tmp_path):
    with pytest.raises(ValueError, match="by_event_day"):
        medallion.refine_new_positions(spark, Layout(str(tmp_path)), "2024-06-01")
    layout = Layout(str(tmp_path / "lake"), by_event_day=True)
    medallion.run_daily(spark, layout, RUN, bodies=bodies(spark, PINGS))
    other = Layout(str(tmp_path / "essential"), by_event_day=True, positions=layout.path("positions"))
    medallion.land_positions(bodies(spark, [{"LT": "1", "LG": "1", "NV": "v", "NL": "l"}]), other, RUN)
    with pytest.raises(ValueError, match="essential"):
        medallion.refine_new_positions(spark, other, "2024-06-01")


def test_command_line(spark, tmp_path, register, capsys):
    (tmp_path / "feed").mkdir()
    for n, pings in enumerate((PINGS[:3], PINGS[3:])):
        (tmp_path / "feed" / f"{n}.json").write_text(json.dumps({"entidades": pings}))
    main(["--base", str(tmp_path / "lake"), "--feed", str(tmp_path / "feed"), "--register", register, "--run-ts", "2024-06-01T06:00:00"])
    out = capsys.readouterr().out
    assert "build_activity: written" in out and "enrichment_rate: ok (60)" in out
    assert activity(spark, Layout(str(tmp_path / "lake"))) == EXPECTED


def test_paths_can_be_full(spark, tmp_path):
    landed = str(tmp_path / "elsewhere")
    append_landing(spark.createDataFrame([tuple(ping("v", "l").values())], list(ping("v", "l"))), landed, RUN)
    layout = Layout(str(tmp_path / "lake"), landed_positions=landed)
    assert medallion.refine_positions(spark, layout).status == "written"
