"""Helpers of the operators: input columns, written intermediate tables, files of tasks."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.sinks.scratch import scratch_path


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``doc_id`` (long) and ``text`` (null: empty); others are left out."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


#: Rows that a task should write where their number is known beforehand.
ROWS_A_TASK = 50_000


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there, and a lost executor costs nothing.

    ``rows``, if known, bounds their number: small tables then take few tasks however many
    partitions a shuffle has."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_A_TASK)))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def filesystem(folder: str):
    """File system and path of a folder, for tasks that write files of their own format."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("/") else fs.FileSystem.from_uri(f"file://{folder}")


def hadoop_uri(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as ``filesystem`` takes it."""
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(sc._jsc.hadoopConfiguration())
    uri = fs.makeQualified(place).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def unused_name(folder: str, suffix: str) -> str:
    """Each attempt of a task writes a file of its own; only finished attempts get into the manifest."""
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"


def spread(df: DataFrame) -> DataFrame:
    """One task per row, for short lists of files."""
    return df.repartition(max(1, df.count()))


_held: dict[Hashable, Any] = {}


def process_cache(owner: Hashable, make: Callable[[], Any]) -> Any:
    """What an operator keeps in a worker process from one task to the next. Workers outlive
    stages, so what other operators have kept is given up when one begins."""
    if owner not in _held:
        _held.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)
        _held[owner] = make()
    return _held[owner]
