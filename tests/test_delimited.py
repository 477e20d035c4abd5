"""Delimited files: headers read in tasks, quoted line breaks in files that are cut anywhere."""

from __future__ import annotations

import csv
import gzip
import io
import random
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetmart.sources import delimited
from fleetmart.sources.delimited import read_delimited


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40b")
    spark.conf.set("spark.sql.files.openCostInBytes", "16b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def rows_of(df):
    return sorted(tuple(v or "" for v in r) for r in df.collect())


def written(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, delimiter=";", lineterminator=end).writerows(rows)
    return out.getvalue()


FIELD = st.text(alphabet='ab;"\n é', max_size=12)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(FIELD, FIELD), max_size=25), st.sampled_from(["\n", "\r\n"]))
def test_records_cut_anywhere_equal_one_reader(spark, tmp_path, small_splits, rows, end):
    rows = [("x" + a, b) for a, b in rows]
    file = tmp_path / f"{random.random()}.csv"
    file.write_bytes(written([("K", "V"), *rows], end).encode())
    got = read_delimited(spark, str(file), multi_line=True)
    assert got.columns == ["K", "V"]
    assert rows_of(got) == sorted(rows)


def test_many_splits_and_files(spark, tmp_path, small_splits):
    rng = random.Random(4)
    rows = [(f"k{i}", "\n".join(rng.choice(["", "line", 'say "x"', "a;b"]) for _ in range(rng.randrange(1, 30)))) for i in range(60)]
    for n in range(3):
        (tmp_path / f"{n}.csv").write_text(written([("K", "V") if n else ("V", "K"), *(r if n else r[::-1] for r in rows[n::3])]))
    got = read_delimited(spark, str(tmp_path), multi_line=True)
    assert rows_of(got.select("K", "V")) == sorted(rows)
    assert got.rdd.getNumPartitions() > 20


def test_text_in_latin_1_and_a_quote_within_a_field(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_bytes('K;V\nk;5" pipe\nl;"é\nü"\nm;\n'.encode("latin-1"))
    got = read_delimited(spark, str(tmp_path / "a.csv"), multi_line=True, encoding="ISO-8859-1")
    assert rows_of(got) == [("k", '5" pipe'), ("l", "é\nü"), ("m", "")]


def test_an_open_quote_at_the_end_stops_the_read(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text("K;V\nk;1\n" * 1 + 'l;"never closed\n' + "m;2\n" * 30)
    with pytest.raises(Exception, match="unclosed quote"):
        read_delimited(spark, str(tmp_path / "a.csv"), multi_line=True).collect()


def test_compressed_and_hidden_files_and_folders(spark, tmp_path):
    (tmp_path / "a.csv.gz").write_bytes(gzip.compress('﻿K;V\nk;"1\n2"\n'.encode()))
    (tmp_path / "_hidden").write_text("other;header\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "b.csv").write_text("k;v;w\nl;3;4\n")
    (tmp_path / "b.csv").rename(tmp_path / "sub.csv")
    got = read_delimited(spark, str(tmp_path / "a.csv.gz"), multi_line=True)
    assert rows_of(got) == [("k", "1\n2")]
    with pytest.raises(Exception, match="W"):
        read_delimited(spark, str(tmp_path)).collect()
    with pytest.raises(ValueError, match="no header"):
        read_delimited(spark, str(tmp_path / "empty.csv"))


def test_names_with_spaces_and_signs(spark, tmp_path):
    for n, name in enumerate(["a b.csv", "50%25.csv", "x#y.csv", "é+ü.csv"]):
        (tmp_path / name).write_text(f"K;V\n{n};1\n")
    assert rows_of(read_delimited(spark, str(tmp_path))) == [(str(n), "1") for n in range(4)]
    assert rows_of(read_delimited(spark, str(tmp_path), multi_line=True)) == [(str(n), "1") for n in range(4)]
    assert rows_of(read_delimited(spark, str(tmp_path / "a b.csv"))) == [("0", "1")]


def test_heads_by_spark_equal_those_that_tasks_open(spark, tmp_path):
    for n, text in enumerate(["A;B\n1;2\n", "A;B", "B;A\r\n3;4\r\n", "﻿Ç;D\n"]):
        (tmp_path / f"{n}.csv").write_text(text, encoding="utf-8")
    files = delimited._files(spark, [str(tmp_path)])
    opened, scanned = (
        sorted((f.rsplit("/", 1)[1], line) for f, line in map(tuple, heads(spark, files, "UTF-8").collect()))
        for heads in (delimited._opened_heads, delimited._scanned_heads)
    )
    assert opened == scanned == [("0.csv", "A;B"), ("1.csv", "A;B"), ("2.csv", "B;A"), ("3.csv", "Ç;D")]


def test_headers_of_many_files_are_read_in_tasks(spark, tmp_path, monkeypatch):
    for n in range(3_000):
        (tmp_path / f"{n}.csv").write_text(f"{'a;b' if n % 3 else 'b;a'}\n{n};0\n")
    start = time.time()
    found = delimited._headers(spark, [str(tmp_path)], "UTF-8")
    assert {line: len(files) for line, files in found} == {"a;b": 2000, "b;a": 1000}
    assert time.time() - start < 60
