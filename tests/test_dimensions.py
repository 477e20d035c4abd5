from __future__ import annotations

import pytest

from fleetmart.operators import dimensions

PAIRS = [("8103 ", "801"), ("8103", "801"), (" sc01", "802"), ("SC01", "803"), ("8103", "801")]


def pairs(df):
    return sorted((r["cod_linha"], r["consorcio"]) for r in df.collect())


@pytest.mark.parametrize("operator", ["CONCESSIONÁRIA", "CONCESSIONARIA"])
def test_distinct_before_cleaning(spark, operator):
    register = spark.createDataFrame(PAIRS, ["LINHA", operator])
    dim = dimensions.extract_dimension(register)
    assert dim.columns == ["cod_linha", "consorcio", "nome_linha"]
    assert pairs(dim) == [("8103", "801"), ("8103", "801"), ("SC01", "802"), ("SC01", "803")]
    assert {r["nome_linha"] for r in dim.collect()} == {"N/A - Ver MCO"}


def test_cleaning_before_distinct(spark):
    register = spark.createDataFrame(PAIRS, ["LINHA", "CONCESSIONARIA"])
    dim = dimensions.extract_dimension(register, normalize_first=True)
    assert pairs(dim) == [("8103", "801"), ("SC01", "802"), ("SC01", "803")]


def test_the_accented_header_comes_first(spark):
    register = spark.createDataFrame([("1", "plain", "accented")], ["LINHA", "CONCESSIONARIA", "CONCESSIONÁRIA"])
    assert pairs(dimensions.extract_dimension(register)) == [("1", "ACCENTED")]


@pytest.mark.parametrize("columns", [["linha", "CONCESSIONARIA"], ["LINHA", "OPERADOR"]])
def test_missing_column(spark, columns):
    with pytest.raises(dimensions.MissingColumnError):
        dimensions.extract_dimension(spark.createDataFrame([("1", "2")], columns))
