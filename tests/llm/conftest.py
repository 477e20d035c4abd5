from __future__ import annotations

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, cls string, slice string, node string, size string, kept string, rest string, label string, group string"


def _row(doc_id, text, name="x"):
    return (doc_id, text, None, "src", None if text is None else len(text), 0.5, *[name] * 8)


LONG = " ".join(f"word{i * 7919 % 1000} tail{i % 13}" for i in range(12_000))
ODD = [
    _row(None, "a row without an id and with some words to count"),
    _row(None, None, None),
    _row(5, None),
    _row(6, ""),
    _row(7, " \n\t "),
    _row(8, "one"),
    _row(9, "Ünïcödé 日本語 😀 <|endoftext|> it's 12'll ½"),
    _row(10, LONG),
    _row(11, "x" * 60_000),
    _row(12, "the same row twice, with enough words to make some shingles"),
    _row(12, "the same row twice, with enough words to make some shingles"),
    _row(12, "the same id with another text, which also has a few more words"),
    _row(13, "the same row twice, with enough words to make some shingles"),
    _row(-(1 << 63), "the least id"),
    _row((1 << 63) - 1, "the greatest id"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
