"""Comparison of the rows of a group: large groups in pairs of blocks, a task's groups in a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A group's rows in one task, and of its size the blocks that larger ones are cut into.
ROWS = 256


def blocked(members: DataFrame, row_id: str = "cls") -> DataFrame:
    """Rows of groups with their ``size``, dealt out for comparison: a group of more than ``ROWS``
    is cut into blocks, and a row goes to every pair of blocks that its own is part of. Columns
    ``i``, ``j`` name the pair of blocks, ``own`` is the row's. No pair of rows is left out."""
    blocks = F.ceil(F.col("size") / F.lit(ROWS * 3 // 4)).cast("int")
    many = F.col("size") > ROWS
    own = F.when(many, F.pmod(F.xxhash64(row_id, F.lit(5)), blocks).cast("int")).otherwise(0)
    rows = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.when(many, blocks - 1).otherwise(0))))
    return rows.select("*", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).drop("other", "size")


def with_first_block(members: DataFrame, row_id: str = "cls") -> DataFrame:
    """Rows of large groups, dealt out for comparison with their group's first block alone: the
    pairs of blocks (0, j) in the columns of :func:`blocked`."""
    blocks = F.ceil(F.col("size") / F.lit(ROWS * 3 // 4)).cast("int")
    rows = members.withColumn("own", F.pmod(F.xxhash64(row_id, F.lit(5)), blocks).cast("int"))
    every = F.sequence(F.lit(0), blocks - 1)
    return rows.withColumn("j", F.explode(F.when(F.col("own") == 0, every).otherwise(F.array("own")))).withColumn("i", F.lit(0)).drop("size")


def between_labels(members: DataFrame, key: str, row_id: str = "cls") -> DataFrame:
    """Rows of groups with a ``label`` each, dealt out so that every two rows of a group with
    different labels meet. Rows of a label that fill a block make up blocks of their own, which are
    not compared among themselves; all others are pooled, the rows of a label in one block."""
    per_block = F.lit(ROWS * 3 // 4)
    counts = members.groupBy(key, "label").agg(F.count(F.lit(1)).alias("n"))
    known = members.join(counts, [key, "label"])
    pools = counts.filter(F.col("n") <= ROWS).groupBy(key).agg(F.ceil(F.sum("n") / per_block).cast("long").alias("pools"))
    known = known.join(pools, key, "left")
    alone = F.col("n") > ROWS
    place = F.when(alone, F.pmod(F.xxhash64(row_id, F.lit(5)), F.ceil(F.col("n") / per_block).cast("long"))).otherwise(F.pmod(F.xxhash64("label", F.lit(6)), "pools"))
    known = known.withColumn("mine", F.when(alone, F.col("label"))).withColumn("own", F.xxhash64(F.col(key), F.coalesce(F.hex("mine"), F.lit("")), place))
    blocks = known.select(key, "mine", "own").distinct()
    others = blocks.select(F.col(key), F.col("mine").alias("theirs"), F.col("own").alias("other"))
    pairs = blocks.join(others, key).filter("mine is null or theirs is null or mine <> theirs").select(key, "own", "other")
    dealt = known.drop("n", "pools", "mine", "label").join(pairs, [key, "own"])
    return dealt.select("*", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).drop("other", "size")


def each_group(rows: DataFrame, keys: list[str], row_id: str, work: Callable[[pa.Table], pa.RecordBatch], schema: str) -> DataFrame:
    """``work`` on the rows of every value of ``keys`` with ``i`` and ``j``, which must all be
    numbers. A task holds one group and an Arrow batch at a time."""
    keys = [*keys, "i", "j"]

    def cuts_of(table: pa.Table) -> np.ndarray:
        ids = np.stack([table.column(k).to_numpy() for k in keys])
        return np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = pa.Table.from_batches([*held, batch])
            cuts = cuts_of(whole)
            for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=False):
                yield work(whole.slice(a, b - a))
            held = whole.slice(int(cuts[-1]) if len(cuts) else 0).to_batches()
        if held:
            yield work(pa.Table.from_batches(held))

    return rows.repartition(*keys).sortWithinPartitions(*keys, row_id).mapInArrow(run, schema)


def pairs_of(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows that a group compares: all, or those between its two blocks."""
    n, own = group.num_rows, group.column("own").to_numpy()
    i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
    if i == j:
        return np.triu_indices(n, 1)
    here, there = np.flatnonzero(own == i), np.flatnonzero(own != i)
    return np.repeat(here, len(there)), np.tile(there, len(here))


def stars(n: int, left: np.ndarray, right: np.ndarray) -> list[int]:
    """For each of ``n`` nodes the first node of its component of the given edges."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return [root(x) for x in range(n)]
