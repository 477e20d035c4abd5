"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.shared import written


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge down or only edges up."""
    down = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).select(F.col("a").alias("node"), "n", F.lit(0).alias("up"))
    up = edges.select(F.col("b").alias("node"), F.lit(0).cast("long").alias("n"), F.lit(1).alias("up"))
    return down.unionByName(up).groupBy("node").agg(F.sum("n").alias("n"), F.max("up").alias("up")).filter("n + up > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every end of an edge: the label is the least node that it reaches.

    ``edges`` has the columns ``a`` and ``b`` of one orderable type. Rounds of large stars (each
    neighbour above a node is tied to the least of the node's neighbourhood) and small stars (the
    same below it) shrink every component to a star, in a number of rounds that grows with the
    logarithm of its size. A node with very many neighbours is only ever the key of a partial
    aggregate or of a plain join, which adaptive execution splits; each half of a round ends in a
    written table.
    """
    edges = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    n = edges.count()
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least", 2 * n)
        large = written(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct(), "large", n)
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "least", n)
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = written(small.filter("a <> b").distinct(), "edges", n)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
