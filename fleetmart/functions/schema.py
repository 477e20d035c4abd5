"""Questions about column types."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from fleetmart.functions.parse import named


def orderable(dtype: T.DataType) -> bool:
    """Whether Spark can compare and hash values of this type."""
    if isinstance(dtype, T.ArrayType):
        return orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def orderable_columns(df: DataFrame, *, without: Iterable[str] = ()) -> list[Column]:
    """The comparable columns of a table, minus some names."""
    left_out = set(without)
    return [named(f.name) for f in df.schema.fields if f.name not in left_out and orderable(f.dataType)]


def unused(name: str, taken: Iterable[str]) -> str:
    """A name for a helper column that none of the taken ones has, in any case of letters."""
    known = {t.lower() for t in taken}
    helper = f"_{name}"
    while helper.lower() in known:
        helper = f"_{helper}"
    return helper
