"""Registry of named queries."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    run: Run
    sql: str


CATALOG: dict[str, Query] = {}


def query(name: str, sql: str) -> Callable[[Run], Run]:
    """Register a query with the SQL that must give the same rows."""

    def register(run: Run) -> Run:
        if name in CATALOG:
            raise ValueError(f"query {name} is registered twice")
        CATALOG[name] = Query(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def zoneless(name: str) -> Column:
    """A timestamp column as the tables hold timestamps: without a time zone."""
    return F.col(name).cast("timestamp_ntz").alias(name)
