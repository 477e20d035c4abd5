from __future__ import annotations

import datetime
import pathlib
import tempfile
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fleetmart.operators.cleaning import dedup_by_key
from fleetmart.operators.enrich import left_enrich
from fleetmart.sinks import writers
from fleetmart.sinks.scratch import scratch_path
from fleetmart.sources.delimited import read_delimited
from fleetmart.sources.tables import if_present, load_table, scan_landing

DAY_1 = datetime.datetime(2024, 6, 1, 6)
DAY_1_LATER = datetime.datetime(2024, 6, 1, 18, 30)
DAY_2 = datetime.datetime(2024, 6, 2, 6)


def landed(spark, base):
    rows = scan_landing(spark, base, keep_day=True)
    return Counter((r["n"], r["_ingestion_timestamp"], str(r["partition_date"])) for r in rows.collect())


def landed_rows(spark, base):
    return Counter(map(str, spark.read.parquet(base).collect()))


def test_append_adds_to_the_day(spark, tmp_path):
    base = str(tmp_path / "t")
    for run_ts in (DAY_1, DAY_1_LATER, DAY_2):
        writers.append_landing(spark.range(2).select(F.col("id").alias("n")), base, run_ts)
    stamps = [("2024-06-01T06:00:00", "2024-06-01"), ("2024-06-01T18:30:00", "2024-06-01"), ("2024-06-02T06:00:00", "2024-06-02")]
    assert landed(spark, base) == Counter((n, *s) for n in "01" for s in stamps)
    assert sorted(p.name for p in (tmp_path / "t").glob("partition_date=*")) == ["partition_date=2024-06-01", "partition_date=2024-06-02"]


def test_replace_replaces_its_day_only(spark, tmp_path):
    base = str(tmp_path / "t")
    writers.replace_landing_day(spark.range(3).select(F.col("id").alias("n")), base, DAY_1)
    writers.replace_landing_day(spark.range(1).select(F.col("id").alias("n")), base, DAY_2)
    writers.replace_landing_day(spark.range(2).select(F.col("id").alias("n")), base, DAY_1_LATER)
    assert landed(spark, base) == Counter(
        [("0", "2024-06-01T18:30:00", "2024-06-01"), ("1", "2024-06-01T18:30:00", "2024-06-01"), ("0", "2024-06-02T06:00:00", "2024-06-02")]
    )


def test_landing_scan_drops_the_day_and_prunes_by_it(spark, tmp_path):
    base = str(tmp_path / "t")
    for run_ts in (DAY_1, DAY_2):
        writers.append_landing(spark.range(2).select(F.col("id").alias("n")), base, run_ts)
    assert scan_landing(spark, base).dtypes == [("n", "string"), ("_ingestion_timestamp", "string")]
    recent = scan_landing(spark, base, since="2024-06-02")
    assert recent.count() == 2
    assert "partition_date" in recent._jdf.queryExecution().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_landed_days_with_other_columns(spark, tmp_path):
    base = str(tmp_path / "t")
    writers.append_landing(spark.sql("SELECT 1 AS a"), base, DAY_1)
    writers.append_landing(spark.sql("SELECT 2 AS a, 3 AS b"), base, DAY_2)
    united = scan_landing(spark, base, merge_schema=True)
    assert sorted((r["a"], r["b"] or "") for r in united.collect()) == [("1", ""), ("2", "3")]


def test_overwrite_replaces_columns_and_may_read_its_own_table(spark, tmp_path):
    path = str(tmp_path / "deep" / "t")
    writers.overwrite_table(spark.range(5).select("id", F.lit("x").alias("old")), path)
    writers.overwrite_table(load_table(spark, path).select((F.col("id") * 2).alias("new")), path)
    assert sorted(r["new"] for r in load_table(spark, path).collect()) == [0, 2, 4, 6, 8]
    assert [p.name for p in (tmp_path / "deep").iterdir()] == ["t"]


def test_a_failed_overwrite_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.overwrite_table(spark.range(3), path)
    with pytest.raises(Exception, match="broken"):
        writers.overwrite_table(spark.range(3).select(F.raise_error(F.lit("broken"))), path)
    assert load_table(spark, path).count() == 3


def file_ranges(path, column):
    ranges = []
    for file in sorted(pathlib.Path(path).glob("_v*/*.parquet")):
        values = pq.read_table(file, columns=[column])[column].to_pylist()
        assert values == sorted(values)
        if values:
            ranges.append((values[0], values[-1], len(values)))
    return sorted(ranges)


def test_clustered_files_do_not_overlap(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(4000).select((F.col("id") * 7919 % 1000).alias("k"), "id").repartition(7)
    writers.write_clustered(df, path, ["k"], files=4)
    ranges = file_ranges(path, "k")
    assert len(ranges) == 4 and sum(n for *_, n in ranges) == 4000
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_a_hot_value_is_cut_over_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(9000).select(F.when(F.col("id") % 3 < 2, 5).otherwise(F.col("id") % 10).alias("k"), "id")
    writers.write_clustered(df, path, ["k"], files=6)
    ranges = file_ranges(path, "k")
    assert len(ranges) == 6 and max(n for *_, n in ranges) < 9000 / 3
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert load_table(spark, path).distinct().count() == 9000


def test_absent_tables_are_none_and_other_errors_are_raised(spark, tmp_path):
    assert if_present(load_table, spark, str(tmp_path / "nothing")) is None
    assert if_present(scan_landing, spark, str(tmp_path / "nothing")) is None
    (tmp_path / "empty").mkdir()
    assert if_present(scan_landing, spark, str(tmp_path / "empty")) is None
    (tmp_path / "bad.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        if_present(load_table, spark, str(tmp_path / "bad.parquet"))
    with pytest.raises(AnalysisException):
        if_present(lambda: spark.range(1).select("nope"))


def test_delimited_text(spark, tmp_path):
    file = tmp_path / "r.csv"
    file.write_text(' linha ;Concessionária; n\n0801;"a;""b""";\n SC01 ;x;1,5\n', encoding="utf-8")
    df = read_delimited(spark, str(file))
    assert df.dtypes == [("LINHA", "string"), ("CONCESSIONÁRIA", "string"), ("N", "string")]
    assert [tuple(r) for r in df.collect()] == [("0801", 'a;"b"', None), (" SC01 ", "x", "1,5")]


def test_short_lines_are_filled_and_long_ones_fail(spark, tmp_path):
    file = tmp_path / "r.csv"
    file.write_text("a;b;c\n1\n\n1;2;3\n", encoding="utf-8")
    assert sorted(map(str, read_delimited(spark, str(file)).collect())) == sorted(
        ["Row(A='1', B=None, C=None)", "Row(A='1', B='2', C='3')"]
    )
    file.write_text("a;b;c\n1;2;3;4\n", encoding="utf-8")
    with pytest.raises(Exception, match="more fields than the header"):
        read_delimited(spark, str(file)).select("A").collect()


def test_other_encodings(spark, tmp_path):
    file = tmp_path / "r.csv"
    file.write_bytes("concessionária;n\nSão;1\n".encode("latin-1"))
    df = read_delimited(spark, str(file), encoding="ISO-8859-1")
    assert df.columns == ["CONCESSIONÁRIA", "N"] and tuple(df.first()) == ("São", "1")


def test_delimited_text_with_line_breaks(spark, tmp_path):
    file = tmp_path / "r.csv"
    file.write_text('a;b\n"one\ntwo";2\n', encoding="utf-8")
    assert [tuple(r) for r in read_delimited(spark, str(file), multi_line=True).collect()] == [("one\ntwo", "2")]


def test_scratch_is_below_the_checkpoint_folder(spark):
    path = scratch_path(spark, "x")
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert path.startswith(shared) and path != scratch_path(spark, "x")


def test_a_day_without_rows_is_emptied(spark, tmp_path):
    base, day = str(tmp_path / "landing"), datetime.datetime(2024, 6, 1)
    df = spark.createDataFrame([("1",)], "LINHA string")
    writers.replace_landing_day(df, base, day)
    writers.replace_landing_day(df, base, day.replace(day=2))
    writers.replace_landing_day(df.limit(0), base, day)
    assert [r["partition_date"].isoformat() for r in spark.read.parquet(base).collect()] == ["2024-06-02"]


def test_compaction_keeps_all_rows_and_columns(spark, tmp_path):
    base, day = str(tmp_path / "landing"), datetime.datetime(2024, 6, 1)
    for n, schema in enumerate(("a string", "a string, b string", "b string")):
        writers.append_landing(spark.createDataFrame([("x",) * len(schema.split(","))] * 3, schema).repartition(3), base, day.replace(hour=n))
    writers.append_landing(spark.createDataFrame([("y",)], "a string"), base, day.replace(day=2))
    before = sorted(map(str, spark.read.option("mergeSchema", True).parquet(base).select("a", "b", "partition_date").collect()))
    other = sorted((tmp_path / "landing" / "partition_date=2024-06-02").glob("*.parquet"))
    writers.compact_landing_day(spark, base, "2024-06-01")
    assert len(list((tmp_path / "landing" / "partition_date=2024-06-01").glob("*.parquet"))) == 1
    assert sorted((tmp_path / "landing" / "partition_date=2024-06-02").glob("*.parquet")) == other
    assert sorted(map(str, spark.read.option("mergeSchema", True).parquet(base).select("a", "b", "partition_date").collect())) == before


def test_compaction_spreads_equal_rows_and_sorts_none(spark, tmp_path, monkeypatch):
    base, plans, write = str(tmp_path / "landing"), [], writers.replace_partitions

    def noted(df, path, partition_by):
        # a partitioned write asks for rows in the order of its columns
        plans.append(df.sortWithinPartitions(*partition_by)._jdf.queryExecution().executedPlan().toString())
        write(df, path, partition_by)

    monkeypatch.setattr(writers, "replace_partitions", noted)
    for run_ts in (DAY_1, DAY_1_LATER):
        writers.append_landing(spark.range(2000).selectExpr("'x' AS a", "CAST(NULL AS STRING) AS _metadata").repartition(3), base, run_ts)
    before = landed_rows(spark, base)
    writers.compact_landing_day(spark, base, "2024-06-01", files=4)
    assert len(plans) == 1 and "Sort [" not in plans[0] and "RoundRobin" not in plans[0]
    files = [pq.read_metadata(f).num_rows for f in (tmp_path / "landing" / "partition_date=2024-06-01").glob("*.parquet")]
    assert len(files) == 4 and min(files) > 700 and sum(files) == 4000
    assert landed_rows(spark, base) == before


@pytest.mark.parametrize("day", ["2024-06-01", "a:b%41é", "01", None, "2024-06-01 06:00:00"])
def test_compaction_writes_the_folder_it_read(spark, tmp_path, day):
    base = str(tmp_path / "landing")
    for run_ts in (DAY_1, DAY_2):
        writers.append_landing(spark.range(3).selectExpr("CAST(id AS STRING) AS a"), base, run_ts, day=F.lit(day).cast("string"))
    before, [folder] = landed_rows(spark, base), (tmp_path / "landing").glob("partition_date=*")
    writers.compact_landing_day(spark, base, folder.name.removeprefix("partition_date="))
    assert list((tmp_path / "landing").glob("partition_date=*")) == [folder] and len(list(folder.glob("*.parquet"))) == 1
    assert landed_rows(spark, base) == before


def test_helper_names_do_not_clash(spark):
    df = spark.createDataFrame([("a", 1, 2, 3, "x"), ("a", 2, 2, 3, "y")], "k string, _rank int, _SALT int, _spread int, _excess string")
    assert dedup_by_key(df, ["k"]).columns == df.columns
    assert writers.cluster_rows(df, ["k"]).columns == df.columns
    dim = spark.createDataFrame([("a", "d")], "k string, d string")
    joined = left_enrich(df, dim, "k", salts=4)
    assert joined.columns == [*df.columns, "d"] and joined.count() == 2


def test_a_salted_join_never_broadcasts(spark):
    facts, dim = spark.range(1000).selectExpr("id % 7 AS k", "id"), spark.range(7).withColumnRenamed("id", "k")
    plan = left_enrich(facts, dim, "k", salts=256)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_scratch_leaves_the_checkpoint_folder_alone(spark):
    before = spark.sparkContext.getCheckpointDir()
    scratch_path(spark, "x")
    assert spark.sparkContext.getCheckpointDir() == before


def delimited(spark, tmp_path, files, **options):
    folder = tempfile.mkdtemp(dir=tmp_path)
    for n, text in enumerate(files):
        with open(f"{folder}/{n}.csv", "w", newline="", encoding="utf-8") as out:
            out.write(text)
    df = read_delimited(spark, folder, **options)
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=str)


@pytest.mark.parametrize("pad", [0, 500])
def test_columns_go_by_each_files_header(spark, tmp_path, pad):
    got = delimited(spark, tmp_path, ["linha;OP\n1;a\n" * 1 + "2;b\n" * pad, " op ;LINHA\nc;3\n", ""])
    assert set(got) == {(("LINHA", "1"), ("OP", "a")), (("LINHA", "3"), ("OP", "c"))} | ({(("LINHA", "2"), ("OP", "b"))} if pad else set())
    assert len(got) == pad + 2
    with pytest.raises(AnalysisException):
        delimited(spark, tmp_path, ["LINHA;OP\n1;a\n", "LINHA;OTHER\n1;a\n"])


@pytest.mark.parametrize("multi_line", [False, True])
@pytest.mark.parametrize("line", ["1;2;x", "1;2;;x", '1;"2";"";"x;y"'])
def test_no_field_is_lost(spark, tmp_path, line, multi_line):
    with pytest.raises(Exception, match="more fields"):
        delimited(spark, tmp_path, [f"LINHA;OP\n1;2\n{line}\n"], multi_line=multi_line)


@pytest.mark.parametrize("multi_line", [False, True])
def test_lines_that_are_whole(spark, tmp_path, multi_line):
    got = delimited(spark, tmp_path, ['LINHA;OP\n"a;b";"say ""x"""\n5" pipe;\n3\n4;5;;\n; y \n'], multi_line=multi_line)
    expected = [("a;b", 'say "x"'), ('5" pipe', None), ("3", None), ("4", "5"), (None, " y ")]
    assert got == sorted(((("LINHA", a), ("OP", b)) for a, b in expected), key=str)


def test_a_quoted_line_break(spark, tmp_path):
    files = ['LINHA;OP\n"a\nb";O1\n']
    assert delimited(spark, tmp_path, files, multi_line=True) == [(("LINHA", "a\nb"), ("OP", "O1"))]
    with pytest.raises(Exception, match="multi_line"):
        delimited(spark, tmp_path, files)
