"""Extract the line -> operator dimension from the trip register."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart import contract as C
from fleetmart.functions.parse import clean_code, named


class MissingColumnError(ValueError):
    """A column that must exist does not."""


def first_present(df: DataFrame, spellings: Sequence[str]) -> str:
    """The first of several spellings of a column name that the table has."""
    for name in spellings:
        if name in df.columns:
            return name
    raise MissingColumnError(f"none of {list(spellings)} among {df.columns}")


def extract_dimension(
    register: DataFrame,
    *,
    line: str = C.REGISTER_LINE,
    operator: Sequence[str] = C.REGISTER_OPERATOR,
    normalize_first: bool = False,
) -> DataFrame:
    """Distinct (line, operator) pairs of the register with cleaned codes.

    By default pairs are made distinct as written and cleaned afterwards, so two
    spellings of one pair stay two rows and multiply in a join.  ``normalize_first``
    cleans before ``distinct``.
    """
    line = first_present(register, [line])
    pairs = register.select(
        named(line).alias(C.LINE), named(first_present(register, operator)).alias(C.OPERATOR)
    )
    cleaned = {name: clean_code(F.col(name)) for name in (C.LINE, C.OPERATOR)}
    if normalize_first:
        pairs = pairs.withColumns(cleaned).distinct()
    else:
        pairs = pairs.distinct().withColumns(cleaned)
    return pairs.withColumn(C.LINE_NAME, F.lit(C.NO_LINE_NAME))
