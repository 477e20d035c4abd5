"""Runs and writers that stop anywhere."""

from __future__ import annotations

import datetime
import json
import shutil

import pytest
from pyspark.sql import functions as F

from fleetmart.plans import medallion, pending
from fleetmart.plans.layout import Layout
from fleetmart.sinks import columns, versions, writers
from fleetmart.sources.tables import if_present, load_table, scan_landing

RUN = datetime.datetime(2024, 6, 1, 6)


class Stopped(Exception):
    pass


def ping(vehicle, line, time="20240131120000", lat="-19,9"):
    return {"LT": lat, "LG": "-43,9", "NV": vehicle, "NL": line, "HR": time}


def bodies(spark, *pings):
    return spark.createDataFrame([(json.dumps({"records": list(pings)}),)], "body string")


def totals(spark, layout):
    return sorted((r["cod_linha"], r["total_pings"]) for r in load_table(spark, layout.path("activity")).collect())


def since(day):
    return f"2024-06-{day:02d}"


def day_pings(day):
    return [ping(f"v{day}", "a", f"202401{day:02d}120000"), ping(f"w{day}", f"b{day}", f"202401{day:02d}130000"), ping("v1", "a", "20240101120000", f"0,{9 - day}")]


EXPECTED = [("a", 3), ("b1", 1), ("b2", 1), ("b3", 1)]


@pytest.mark.parametrize("stage", ["append_landing", "refine_new_positions", "refine_register", "check_positions", "_daily_totals", "write_clustered", "check_activity"])
def test_next_run_does_what_a_stopped_one_left(spark, tmp_path, monkeypatch, stage):
    layout = Layout(str(tmp_path / "lake"), by_event_day=True, parts=2)
    medallion.run_daily(spark, layout, RUN, bodies=bodies(spark, *day_pings(1)))
    whole = getattr(medallion, stage)

    def stop_after(*args, **kwargs):
        whole(*args, **kwargs)
        raise Stopped

    monkeypatch.setattr(medallion, stage, stop_after)
    with pytest.raises(Stopped):
        medallion.run_daily(spark, layout, RUN.replace(day=2), bodies=bodies(spark, *day_pings(2)), since=since(2))
    monkeypatch.setattr(medallion, stage, whole)
    run = medallion.run_daily(spark, layout, RUN.replace(day=3), bodies=bodies(spark, *day_pings(3)), since=since(3))
    assert totals(spark, layout) == EXPECTED
    assert {c["rule"]: c["observed"] for c in run.checks}["volume"] == 6
    assert [pending.notes(spark, layout, kind) for kind in ("landed", "refined", "whole")] == [[], [], []]


def test_a_whole_refresh_that_stops_before_serving(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"), by_event_day=True)
    medallion.run_daily(spark, layout, RUN, bodies=bodies(spark, *day_pings(1)))
    medallion.land_positions(bodies(spark, *day_pings(2)), layout, RUN.replace(day=2))
    medallion.refine_positions(spark, layout)
    medallion.run_daily(spark, layout, RUN.replace(day=3), bodies=bodies(spark, *day_pings(3)), since=since(3))
    assert totals(spark, layout) == EXPECTED


def test_partitions_lost_while_they_are_exchanged_come_back(spark, tmp_path, monkeypatch):
    layout = Layout(str(tmp_path / "lake"), by_event_day=True)
    medallion.run_daily(spark, layout, RUN, bodies=bodies(spark, *day_pings(1)))
    exchange = writers.replace_partitions

    def stops_half_way(df, path, by, fmt="parquet"):
        for place in (tmp_path / "lake" / "refined" / "positions").glob("_v*/_event_day=2024-01-01"):
            shutil.rmtree(place)
        raise Stopped

    medallion.land_positions(bodies(spark, *day_pings(2)), layout, RUN.replace(day=2))
    monkeypatch.setattr(writers, "replace_partitions", stops_half_way)
    with pytest.raises(Stopped):
        medallion.refine_new_positions(spark, layout, since(2))
    monkeypatch.setattr(writers, "replace_partitions", exchange)
    medallion.run_daily(spark, layout, RUN.replace(day=3), bodies=bodies(spark, *day_pings(3)), since=since(3))
    assert totals(spark, layout) == EXPECTED


@pytest.mark.parametrize("stop_at", range(1, 9))
def test_readers_find_the_old_or_the_new_table(spark, tmp_path, monkeypatch, stop_at):
    path = str(tmp_path / "t")
    for n in (3, 4, 5):  # two versions stay, so that the next overwrite removes one
        writers.overwrite_table(spark.range(n), path)
    steps = iter(range(1, 100))

    def counted(do):
        def step(*args):
            if next(steps) == stop_at:
                raise Stopped
            return do(*args)

        return step

    for name in ("rename", "delete", "children"):
        monkeypatch.setattr(versions, name, counted(getattr(versions, name)))
    try:
        writers.overwrite_table(spark.range(6), path)
        stopped = False
    except Stopped:
        stopped = True
    monkeypatch.undo()
    assert load_table(spark, path).count() in ((5, 6) if stopped else (6,))
    writers.overwrite_table(spark.range(7), path)
    assert load_table(spark, path).count() == 7
    assert len(list((tmp_path / "t").glob("_v*"))) == 2 and not list((tmp_path / "t").glob("_staged*"))


def test_a_reader_keeps_the_version_it_began_with(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.overwrite_table(spark.range(3), path)
    old = load_table(spark, path)
    writers.overwrite_table(spark.range(5), path)
    assert (old.count(), load_table(spark, path).count()) == (3, 5)


def test_plain_files_are_a_table_until_a_version_comes(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert load_table(spark, path).count() == 3
    writers.overwrite_table(load_table(spark, path).selectExpr("id + 1 AS id"), path)
    assert sorted(r.id for r in load_table(spark, path).collect()) == [1, 2, 3]
    assert not list((tmp_path / "t").glob("*.parquet"))


def test_a_table_of_leftovers_alone_is_lost_not_absent(spark, tmp_path):
    (tmp_path / "t" / "_staged_x").mkdir(parents=True)
    with pytest.raises(versions.LostTableError, match="no complete version"):
        if_present(load_table, spark, str(tmp_path / "t"))


def test_a_lost_register_stops_the_run(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    register = tmp_path / "r.csv"
    register.write_text("linha;concessionaria\na;801\n")
    medallion.run_daily(spark, layout, RUN, bodies=bodies(spark, ping("v", "a")), register=str(register))
    shutil.move(tmp_path / "lake" / "refined" / "register", tmp_path / "aside")
    shutil.rmtree(tmp_path / "lake" / "landing" / "register")
    with pytest.raises(versions.LostTableError, match="register"):
        medallion.run_daily(spark, layout, RUN.replace(day=2))
    shutil.move(tmp_path / "aside", tmp_path / "lake" / "refined" / "register")
    medallion.run_daily(spark, layout, RUN.replace(day=2))
    assert totals(spark, layout) == [("a", 1)]


def test_a_late_position_rewrites_one_part_of_its_day(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"), by_event_day=True, parts=8)
    many = [ping(f"v{i}", "l", "20240101000000") for i in range(200)]
    medallion.run_daily(spark, layout, RUN, bodies=bodies(spark, *many))

    def files():
        return {str(f): f.stat().st_mtime_ns for f in (tmp_path / "lake" / "refined" / "positions").glob("_v*/*/*/*.parquet")}

    before = files()
    assert len({f.rsplit("/", 2)[1] for f in before}) == 8
    medallion.run_daily(spark, layout, RUN.replace(day=2), bodies=bodies(spark, ping("late", "l", "20240101000000")), since=since(2))
    after = files()
    assert len({f.rsplit("/", 2)[1] for f in set(before) - set(after)}) == 1
    assert all(before[f] == after[f] for f in set(before) & set(after))
    assert totals(spark, layout) == [("l", 201)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_since_a_day_list_its_folders_alone(spark, tmp_path):
    base = str(tmp_path / "t")
    for day in range(1, 5):
        rows = spark.createDataFrame([("x", "y")], ["a", f"only_{day}"])
        writers.append_landing(rows, base, RUN.replace(day=day))
    recent = scan_landing(spark, base, since=since(4), merge_schema=True, keep_day=True)
    assert {f.split("partition_date=")[1][:10] for f in recent.inputFiles()} == {since(4)}
    assert "InMemoryFileIndex(1 paths)" in plan_of(recent)
    assert recent.columns == ["a", "only_1", "_ingestion_timestamp", "only_2", "only_3", "only_4", "partition_date"]
    assert recent.first().asDict() | {"_ingestion_timestamp": None} == dict.fromkeys(recent.columns) | {"a": "x", "only_4": "y", "partition_date": datetime.date(2024, 6, 4)}


def test_no_footers_are_opened_of_noted_days(spark, tmp_path):
    base = str(tmp_path / "t")
    writers.append_landing(spark.sql("SELECT 1 AS a"), base, RUN)
    for file in (tmp_path / "t" / "partition_date=2024-06-01").glob("*"):
        file.write_bytes(b"no parquet at all")
    for file in (tmp_path / "t" / "partition_date=2024-06-01").glob(".*.crc"):
        file.unlink()
    writers.append_landing(spark.sql("SELECT 2 AS a, 3 AS b"), base, RUN.replace(day=2))
    recent = scan_landing(spark, base, since=since(2), merge_schema=True)
    assert [(r["a"], r["b"]) for r in recent.collect()] == [("2", "3")]


def test_days_landed_by_others_are_read_with_their_own_footers(spark, tmp_path):
    base = str(tmp_path / "t")
    writers.append_landing(spark.sql("SELECT 1 AS a"), base, RUN)
    spark.sql("SELECT 2 AS a, 'n' AS z").write.parquet(f"{base}/partition_date={since(2)}")
    rows = scan_landing(spark, base, merge_schema=True)
    assert "z" in rows.columns
    assert scan_landing(spark, base, merge_schema=True, since=since(2)).select("z").first()["z"] == "n"


def test_columns_of_a_replaced_day_go(spark, tmp_path):
    base = str(tmp_path / "t")
    writers.replace_landing_day(spark.sql("SELECT 1 AS a, 2 AS gone"), base, RUN)
    writers.replace_landing_day(spark.sql("SELECT 1 AS a"), base, RUN.replace(hour=8))
    assert scan_landing(spark, base, merge_schema=True).columns == ["a", "_ingestion_timestamp"]
    for hour in range(3):
        writers.append_landing(spark.sql(f"SELECT 1 AS a, 2 AS c{hour}"), base, RUN.replace(day=2, hour=hour))
    writers.compact_landing_day(spark, base, since(2))
    assert len(columns.notes(spark, base)) == 2
    assert set(scan_landing(spark, base, merge_schema=True).columns) == {"a", "_ingestion_timestamp", "c0", "c1", "c2"}


def test_the_gate_reads_the_touched_days_alone(spark, tmp_path, monkeypatch):
    layout = Layout(str(tmp_path / "lake"), by_event_day=True)
    medallion.run_daily(spark, layout, RUN, bodies=bodies(spark, *[ping("v", "l", f"202401{d:02d}000000") for d in range(1, 20)]))
    for place in (tmp_path / "lake" / "refined" / "positions").glob("_v*/_event_day=2024-01-0[2-9]/*/*.parquet"):
        place.write_bytes(b"not to be opened")
        place.with_name(f".{place.name}.crc").unlink()
    spark.createDataFrame([(datetime.date(2024, 1, 1), 0)], "day date, part int").write.parquet(str(tmp_path / "days"))
    days = spark.read.parquet(str(tmp_path / "days"))
    checks = medallion.check_positions(spark, layout, as_of=F.lit(RUN), days=days)
    assert {c["rule"]: c["observed"] for c in checks}["volume"] == 19
