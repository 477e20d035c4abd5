"""Scores learned from labels: the training rows, and scoring of whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows scored at once.
ROWS_AT_ONCE = 1000


def held_out(id_column: Column) -> Column:
    """Whether labels of this document are kept from training."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, *, positives: int, negatives: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, y, text`` of a sample of labelled documents outside the held-out fold: at most so many
    rows with label 1 and 0, those of the least hash of the id. Rows without id or label are left out,
    of repeated labels the larger counts, of documents with equal ids the text of least hash. The
    sample's ids are the only rows broadcast, and both bounds limit them."""
    known = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .filter("doc_id is not null and y in (0, 1)")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .withColumn("draw", F.xxhash64("doc_id", F.lit(17)))
    )
    drawn = [known.filter(F.col("y") == y).orderBy("draw", "doc_id").limit(most).select("doc_id", "y") for y, most in ((1, positives), (0, negatives))]
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(drawn[0].union(drawn[1])), "doc_id")
    one = found.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("key"), "text")).alias("least"))
    return one.select("doc_id", "y", F.col("least.text").alias("text"))


def unused_column(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_score(docs: DataFrame, score: Callable[[list[str]], np.ndarray], name: str, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` and a double column ``name``, which must be unused."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                scores = score([t or "" for t in part.column(text_col).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=[*part.schema.names, name])

    return docs.mapInArrow(run, schema)


def features_of(rows: DataFrame, extract: Callable[[list[str]], np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a bounded sample, computed where its texts are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = extract(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    got = rows.select("doc_id", "y", "text").mapInArrow(run, "doc_id long, y int, x array<double>").toArrow()
    x = np.array(got.column("x").to_pylist(), dtype=np.float64).reshape(-1, width)
    order = np.lexsort((*x.T[::-1], got.column("doc_id").to_numpy()))  # the same model whatever order rows came in
    return x[order], got.column("y").to_numpy()[order]
