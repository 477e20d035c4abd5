"""Near-duplicate vectors by a forest of random-projection trees.

Rows with equal vectors and labels form a class. In every tree the classes of a label are split
again and again: at a quantile of their projections on a random direction, where those within a
margin of the cut go to both sides (spill). A node of at most ``ROWS`` classes is a leaf, and so is
one where every cut would leave so many classes on both sides that comparing them takes over
``LEAST_GAIN`` of the work of the whole node; leaves larger than ``ROWS`` are compared in pairs of
blocks, which loses nothing. A label that is such a leaf as a whole is compared in one tree only.
Within a leaf all cosines are computed in double precision. A pair that shares several leaves counts
in the first only, so links are counted without ever being listed, and each leaf adds only as many
edges as connect its links.

The margin is the standard deviation of the difference of projections of two vectors at the asked
cosine, so a split parts such a pair only if they differ by over two deviations across the cut: 0.14
percent of the pairs where vectors are spread out evenly, about 0.3 percent in the most concentrated
nodes that are still split, and about 0.9 percent if all pairs lay at the cut. Even at the last rate
five trees of twenty-five levels miss fewer than one pair in a thousand at the threshold, and fewer
above it. Links are exact.

Rows with null label, null, empty or zero vectors or null or non-finite components link with
nothing and are components of their own. Vectors are only compared with those of equal length.
Null ids: as any row, but ``component_id`` is null only if no linked row has an id. Repeated ids:
each row is a vector. An empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.components import components
from fleetmart.llm.groups import ROWS, blocked, each_group, stars
from fleetmart.llm.shared import written

TREES = 5
#: Of the work of comparing a node, the share that its two sides may take for it to be split: two
#: thirds of the classes on either side.
LEAST_GAIN = 8 / 9
#: Levels beyond those that sides of two thirds would take, as cuts may be uneven.
MORE_LEVELS = 4
#: Shares of a node's classes below the places where it may be cut.
QUANTILES = [k / 20 for k in range(21)]
UNITS = "vec_id long, cls binary, part long, unit array<double>"


def _units(vectors: DataFrame) -> DataFrame:
    """Every row with its class and unit vector, both null for rows that link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, label in zip(batch.column("embedding").to_pylist(), batch.column("label").to_pylist(), strict=True):
                if label is None or not value or any(x is None for x in value):
                    out.append((None, None, None))
                    continue
                v = np.array(value, dtype=np.float64)
                most = np.abs(v).max()
                if not np.isfinite(v).all() or most == 0:
                    out.append((None, None, None))
                    continue
                scaled = v / most
                head = f"{label}\0{len(v)}\0".encode()
                part = int.from_bytes(hashlib.blake2b(head, digest_size=8).digest(), "little", signed=True)
                out.append((hashlib.blake2b(head + v.tobytes(), digest_size=16).digest(), part, (scaled / np.sqrt(scaled @ scaled)).tolist()))
            cls, part, unit = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cls, pa.binary()), pa.array(part, pa.int64()), pa.array(unit, pa.list_(pa.float64()))], names=["vec_id", "cls", "part", "unit"])

    return vectors.mapInArrow(run, UNITS)


def _directions(width: int, levels: int) -> np.ndarray:
    drawn = np.random.default_rng([77, width]).standard_normal((TREES * levels, width))
    return drawn / np.linalg.norm(drawn, axis=1, keepdims=True)


def _projected(classes: DataFrame, levels: int) -> DataFrame:
    """A row for each class and tree with the projections of all levels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            out = []
            for unit in batch.column("unit").to_pylist():
                along = known.get(len(unit))
                if along is None:
                    along = known[len(unit)] = _directions(len(unit), levels)
                # In units of the deviation of a random vector's projection.
                out.append((along @ np.array(unit) * math.sqrt(len(unit))).astype(np.float32).tolist())
            yield pa.RecordBatch.from_arrays([batch.column("cls"), batch.column("part"), pa.array(out, pa.list_(pa.float32()))], names=["cls", "part", "all"])

    rows = classes.select("cls", "part", "unit").mapInArrow(run, "cls binary, part long, all array<float>")
    trees = rows.select("cls", "part", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.slice("all", t * levels + 1, F.lit(levels)))).alias("tree", "along"))
    return trees.select("tree", F.xxhash64("tree", "part").alias("node"), "part", "cls", "along")


def _cuts(nodes: DataFrame, margin: float) -> DataFrame:
    """``tree, node, part, size, cut, leaf`` of nodes with their quantiles ``q``: the place where the two
    sides, with what lies within the margin, take least work to compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts, leaf = [], []
            for size, q in zip(batch.column("size").to_pylist(), batch.column("q").to_pylist(), strict=True):
                # Of equal quantiles, what is at or below a place counts up to the last, at or above it from the first.
                places = np.array(q, dtype=np.float64)
                left = _shares(places, places + margin, "right")
                right = 1 - _shares(places, places - margin, "left")
                work = (left**2 + right**2)[1:-1]
                best = int(work.argmin())
                cuts.append(float(places[best + 1]))
                leaf.append(bool(size <= ROWS or work[best] > LEAST_GAIN))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("tree", "node", "part", "size")), pa.array(cuts, pa.float64()), pa.array(leaf, pa.bool_())], names=["tree", "node", "part", "size", "cut", "leaf"])

    return nodes.mapInArrow(run, "tree int, node long, part long, size long, cut double, leaf boolean")


def _shares(places: np.ndarray, at: np.ndarray, side: str) -> np.ndarray:
    """The share of a node's classes below each of the numbers ``at``, between its quantiles."""
    upto = np.searchsorted(places, at, side=side)
    low, high = np.clip(upto - 1, 0, None), np.clip(upto, None, len(places) - 1)
    gap = places[high] - places[low]
    part = np.divide(at - places[low], gap, out=np.zeros_like(at), where=gap > 0)
    shares = (low + np.clip(part, 0, 1) * (high - low)) / (len(places) - 1)
    return np.where(upto == 0, 0.0, np.where(upto == len(places), 1.0, shares))


def leaves(classes: DataFrame, n: int, largest: int, cosine: float) -> DataFrame:
    """``tree, node, cls, size``: the leaves of every class. One pass over the members of nodes
    that are still too large per level; quantiles come from partial aggregates."""
    margin = math.sqrt(2 - 2 * cosine)
    levels = max(1, math.ceil(math.log(max(2, largest / ROWS), 1.5)) + MORE_LEVELS)
    state = written(_projected(classes, levels), "state", n * TREES)
    done = []
    for level in range(levels + 1):
        if level == levels:
            sizes = written(state.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("size")), "sizes", n * TREES)
            done.append(state.join(sizes, ["tree", "node"]).select("tree", "node", "cls", "size"))
            break
        value = F.get("along", F.lit(level))
        nodes = state.groupBy("tree", "node").agg(F.first("part").alias("part"), F.count(F.lit(1)).alias("size"), F.percentile_approx(value, QUANTILES, 400).alias("q"))
        nodes = written(_cuts(nodes, margin), "nodes", n * TREES)
        if level == 0:  # a label that one tree compares whole needs no other
            whole = nodes.filter("leaf").groupBy("part").agg(F.min("tree").alias("only"))
            nodes = written(nodes.join(whole, "part", "left").filter("only is null or tree = only").drop("only"), "nodes", n * TREES)
        met = state.join(nodes.drop("part"), ["tree", "node"])
        done.append(met.filter("leaf").select("tree", "node", "cls", "size"))
        more = nodes.filter("not leaf").agg(F.sum("size")).first()[0]
        if not more:
            break
        sides = F.array_compact(F.array(F.when(value <= F.col("cut") + margin, F.lit(0)), F.when(value >= F.col("cut") - margin, F.lit(1))))
        state = written(met.filter("not leaf").select("tree", F.explode(sides).alias("side"), "node", "part", "cls", "along").select("tree", F.xxhash64("node", "side").alias("node"), "part", "cls", "along"), "state", 2 * more)
    found = done[0]
    for other in done[1:]:
        found = found.unionByName(other)
    return written(found, "leaves")


def _linked(cosine: float):
    """Of one leaf or pair of blocks: ``cls, root, n``, for each class that has a link its
    component's first class and the vectors that it links with here and in no earlier leaf."""
    close = 1e-9

    def work(group: pa.Table) -> pa.RecordBatch:
        cls, own = group.column("cls").to_pylist(), group.column("own").to_numpy()
        n, here = len(cls), (group.column("tree")[0].as_py(), group.column("node")[0].as_py())
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        units = np.array(group.column("unit").to_pylist())
        cosines = units @ units.T
        for a, b in zip(*np.nonzero(np.triu(np.abs(cosines - cosine) < close, 1)), strict=True):
            cosines[a, b] = cosines[b, a] = math.fsum(units[a] * units[b]) / math.sqrt(math.fsum(units[a] ** 2) * math.fsum(units[b] ** 2))
        linked = cosines >= cosine
        np.fill_diagonal(linked, False)
        if i != j:
            linked &= (own == i)[:, None] != (own == i)[None, :]
        left, right = np.nonzero(np.triu(linked, 1))
        if not len(left):
            return _found([], [], [])
        earlier: dict[tuple[int, int], int] = {}
        rows, columns = [], []
        for k, places in enumerate(group.column("places").to_pylist()):
            for p in places:
                at = (p["tree"], p["node"])
                if at < here:
                    rows.append(k)
                    columns.append(earlier.setdefault(at, len(earlier)))
        if earlier:
            met = np.zeros((n, len(earlier)), dtype=np.float32)
            met[rows, columns] = 1
            new = linked & (met @ met.T == 0)
        else:
            new = linked
        counts = new @ group.column("copies").to_numpy()
        roots = stars(n, left, right)
        some = np.flatnonzero(linked.any(axis=1)).tolist()
        return _found([cls[k] for k in some], [cls[roots[k]] for k in some], [int(counts[k]) for k in some])

    return work


def _found(cls: list, roots: list, counts: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cls, pa.binary()), pa.array(roots, pa.binary()), pa.array(counts, pa.int64())], names=["cls", "root", "n"])


def near_duplicates(vectors: DataFrame, cosine: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row; see the module's text."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"), F.col(label_col).cast("string").alias("label"))
    rows = written(_units(rows), "units")
    classes = written(rows.filter("cls is not null").groupBy("cls").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("part").alias("part"), F.first("unit").alias("unit")), "classes")
    n, largest = classes.groupBy("part").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
    n = n or 0
    found = leaves(classes, n, largest or 1, cosine)
    crowded = found.filter("size > 1")
    places = written(crowded.groupBy("cls").agg(F.collect_list(F.struct("tree", "node")).alias("places")), "places", n)
    dealt = blocked(crowded).join(places, "cls").join(classes.select("cls", "copies", "unit"), "cls")
    links = written(each_group(dealt, ["tree", "node"], "cls", _linked(cosine), "cls binary, root binary, n long"), "links")
    counts = links.groupBy("cls").agg(F.sum("n").alias("n"))
    component = components(links.select(F.col("cls").alias("a"), F.col("root").alias("b"))).withColumnsRenamed({"node": "cls"})
    ids = classes.select("cls", "first_id", "copies")
    named = written(ids.join(counts, "cls", "left").join(component, "cls", "left").withColumn("label", F.coalesce("label", "cls")), "named", n)
    least = written(named.groupBy("label").agg(F.min("first_id").alias("component_id")), "least", n)
    facts = written(named.join(least, "label").select("cls", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "facts", n)
    result = rows.select("vec_id", "cls").join(facts, "cls", "left")
    component_id = F.coalesce("component_id", "vec_id")
    return result.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component_id.alias("component_id"), F.col("vec_id").eqNullSafe(component_id).alias("kept"))
