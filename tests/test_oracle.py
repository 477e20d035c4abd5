"""Every registered query against its SQL, run by another engine on the same files."""

from __future__ import annotations

import datetime
import math
import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries

NAMES = sorted(oracle_sql())

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    yield con
    con.close()


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, datetime.datetime):
        assert v.tzinfo is None
    return v


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    cursor = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    got = [tuple(row) for row in df.collect()]
    assert sorted(df.columns) == sorted(columns)
    assert len(got) == len(expected)
    assert len(got) > 0
    mine, theirs = _bag(df.columns, got), _bag(columns, expected)
    assert mine == theirs, (list((mine - theirs).items())[:3], list((theirs - mine).items())[:3])


@pytest.mark.parametrize("name", NAMES)
def test_types_match_sql(spark, duck, name):
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE"}
    df = queries()[name](spark, SF_DIR)
    described = duck.execute(f"DESCRIBE {oracle_sql()[name]}").fetchall()
    assert {c: kinds[t] for c, t in df.dtypes} == {row[0]: row[1] for row in described}
