"""Near-duplicates by chosen-path set similarity join on word shingles.

A document's set holds the hashes of its distinct runs of five words (A-Z lower-cased; with fewer
words the whole sequence). Rows with equal sets form a class, and only classes are compared.

Every class walks down a number of independent trees. At each node a coin, thrown from the node
and a minwise token, chooses about ``1 / similarity`` of the class's tokens, and each chosen one
leads to a child; classes that agree in a token take the same path. Nodes of at most ``ROWS``
classes are compared exhaustively by 8-bit minwise signatures, larger ones branch further, and
those that still are larger after ``DEPTH`` levels are compared with one block of theirs first and then
between components only, block against block, which loses nothing. Pairs whose signatures agree in the similarity asked for, less ``SIFT`` deviations of such
an estimate, become candidates. Of each node
only as many edges are kept as connect its candidates, so no group is spelled out as pairs.

Connected candidates are then confirmed on full sets, each group once and in blocks of about
``ROWS`` classes, and the confirmed links give the components. Links are exact; a pair is missed
only if no tree brings it together or the signatures, which all trees share, agree too little (fewer than one
pair in 300,000 at similarity 0.85 or 0.8), and no other links connect it. At similarity 0.85 a tree of
one level finds a pair with probability 0.63, of two with 0.47, of three with 0.37; 14 trees
miss one in a million at the first level, one in 7000 at the second and one in 700 at the last.

Null or wordless text: an empty set, linked with nothing and a component of its own. Rows with a
null ``doc_id`` are linked like others but never name a component that has an id; ``component_id``
is null only if no linked row has one. Equal ``doc_id`` in several rows: each row is a document.
An empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.components import components
from fleetmart.llm.groups import ROWS, between_labels, blocked, each_group, pairs_of, stars, with_first_block
from fleetmart.llm.hashing import Stretches, buffers, mixed
from fleetmart.llm.shared import written

_U = np.uint64
SHINGLE = 5
PLACES = 128
TREES = 14
DEPTH = 2
#: How many standard deviations of an estimate from ``PLACES`` places candidates may agree in less
#: than the similarity asked for.
SIFT = 5.0
BYTES_AT_ONCE = 2 << 20
PAIRS_AT_ONCE = 1 << 16
#: White space of the contract: space and the controls from tab to carriage return.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ORDER = mixed(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | _U(1)
_PERMUTATIONS = (mixed(np.arange(101, 101 + PLACES, dtype=np.uint64)) & _U(0xFFFFFFFF)).astype(np.uint32) | np.uint32(1)
_PLACE_NUMBERS = mixed(np.arange(1001, 1001 + PLACES, dtype=np.uint64))

SKETCH = "doc_id long, text_key long, n_shingles long, cls binary, signature binary, roots array<long>"


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Each text's set, as a sorted array of 64-bit hashes."""
    data, ends = buffers(pc.ascii_lower(texts))
    solid = ~_SPACE[data]
    before = np.concatenate([[False], solid[:-1]])
    after = np.concatenate([solid[1:], [False]])
    inner = ends[1:-1][ends[1:-1] < len(data)]
    before[inner[inner > 0]] = False
    after[inner[inner > 0] - 1] = False
    starts, stops = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    words = Stretches(data).hashes(starts, stops)
    first = np.searchsorted(starts, ends)
    runs = words * _ORDER[0]
    for k in range(1, SHINGLE):
        runs[: max(0, len(words) - k)] += words[k:] * _ORDER[k]
    runs = mixed(runs)
    for a, b in zip(first[:-1], first[1:], strict=True):
        n = b - a
        if n >= SHINGLE:
            yield np.unique(runs[a : b - SHINGLE + 1])
        elif n:
            yield mixed(np.sum(words[a:b] * _ORDER[:n], keepdims=True) + _U(n))
        else:
            yield np.empty(0, dtype=np.uint64)


def class_of(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def minwise(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the token of least hash, and 8 bits of it."""
    short = (tokens >> _U(32)).astype(np.uint32)
    best, least = None, None
    for at in range(0, len(tokens), 2048):
        part = short[at : at + 2048, None] * _PERMUTATIONS[None, :]
        here = part.argmin(axis=0)
        value = part[here, np.arange(PLACES)]
        if best is None:
            best, least = here, value
        else:
            nearer = value < least
            best, least = np.where(nearer, here + at, best), np.where(nearer, value, least)
    token = tokens[best]
    return token, (mixed(token + _PLACE_NUMBERS) >> _U(56)).astype(np.uint8)


def _coin(share: float) -> np.uint64:
    return _U(min((1 << 64) - 1, int(share * 2.0**64)))


def sketches(docs: DataFrame, similarity: float) -> DataFrame:
    """One row per document: its class, signature and the nodes that it reaches in the first level."""
    coin = _coin(1 / (similarity * PLACES))
    trees = mixed(np.arange(1, TREES + 1, dtype=np.uint64) * _U(0xA24BAED4963EE407))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                rows = []
                for tokens in shingle_sets(part.column("text")):
                    if not len(tokens):
                        rows.append((0, None, None, None))
                        continue
                    token, signature = minwise(tokens)
                    paths = mixed(trees[:, None] ^ mixed(token + _PLACE_NUMBERS)[None, :])
                    roots = mixed(paths[paths < coin])
                    rows.append((len(tokens), class_of(tokens), signature.tobytes(), roots.view(np.int64).tolist()))
                sizes, classes, signatures, roots = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.array(signatures, pa.binary()), pa.array(roots, pa.list_(pa.int64()))],
                    names=["doc_id", "text_key", "n_shingles", "cls", "signature", "roots"],
                )

    return docs.mapInArrow(run, SKETCH)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(sizes):
        upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BYTES_AT_ONCE)))
        yield batch.slice(at, upto - at)
        at = upto


def _branch(members: DataFrame, similarity: float) -> DataFrame:
    """The children that each member of a large node goes to."""
    coin = _coin(1 / (similarity * PLACES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column("node").to_numpy().view(np.uint64)
            places = np.frombuffer(b"".join(batch.column("signature").to_pylist()), dtype=np.uint8).reshape(-1, PLACES)
            paths = mixed(mixed(node + _U(0x5851F42D4C957F2D))[:, None] ^ mixed(places + _PLACE_NUMBERS[None, :]))
            row, place = np.nonzero(paths < coin)
            yield pa.RecordBatch.from_arrays([pa.array(mixed(paths[row, place]).view(np.int64)), batch.column("cls").take(pa.array(row))], names=["node", "cls"])

    return members.select("node", "cls", "signature").mapInArrow(run, "node long, cls binary").distinct()


Linked = Callable[[list, np.ndarray, np.ndarray], np.ndarray]


def compare(rows: DataFrame, key: str, payload: str, linked: Linked) -> DataFrame:
    """Edges ``a, b`` between classes: for each group and pair of blocks, stars that connect what
    is connected by the pairs for which ``linked`` holds."""

    def work(group: pa.Table) -> pa.RecordBatch:
        classes, (left, right) = group.column("cls").to_pylist(), pairs_of(group)
        first, second = [], []
        if len(left):
            good = linked(group.column(payload).to_pylist(), left, right)
            for x, root in enumerate(stars(len(classes), left[good], right[good])):
                if x != root:
                    first.append(classes[root])
                    second.append(classes[x])
        return pa.RecordBatch.from_arrays([pa.array(first, pa.binary()), pa.array(second, pa.binary())], names=["a", "b"])

    return each_group(rows.select(key, "i", "j", "own", "cls", payload), [key], "cls", work, "a binary, b binary").distinct()


def connect(members: DataFrame, key: str, payloads: DataFrame, payload: str, linked: Linked, largest: int, n: int) -> DataFrame:
    """Edges that connect what is connected by ``linked`` pairs within groups (``key, cls, size``), of
    which there are ``n`` rows and the largest has ``largest``.

    A group of more than ``ROWS`` is compared with its first block first. Rows that are then connected
    need no comparison among themselves, so only rows of different components go on: a family of near
    copies takes work in proportion to its size, as one block links with nearly all of it."""
    edges = compare(blocked(members.filter(F.col("size") <= ROWS)).join(payloads, "cls"), key, payload, linked)
    if largest <= ROWS:
        return edges
    crowded = members.filter(F.col("size") > ROWS)
    first = written(compare(with_first_block(crowded).join(payloads, "cls"), key, payload, linked), "first", n)
    labels = components(first).withColumnsRenamed({"node": "cls"})
    labelled = crowded.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    rest = compare(between_labels(labelled, key).join(payloads, "cls"), key, payload, linked)
    return edges.unionByName(first).unionByName(rest)


def least_agreement(similarity: float) -> float:
    """Share of signature places that candidates agree in at least."""
    return max(0.0, similarity - SIFT * float(np.sqrt(similarity * (1 - similarity) / PLACES)))


def signatures_agree(least: float) -> Linked:
    need = int(np.ceil(least * PLACES))

    def linked(values: list[bytes], left: np.ndarray, right: np.ndarray) -> np.ndarray:
        places = np.frombuffer(b"".join(values), dtype=np.uint8).reshape(-1, PLACES)
        out = np.empty(len(left), dtype=bool)
        for at in range(0, len(left), PAIRS_AT_ONCE):
            part = slice(at, at + PAIRS_AT_ONCE)
            out[part] = np.count_nonzero(places[left[part]] == places[right[part]], axis=1) >= need
        return out

    return linked


def sets_similar(similarity: Fraction) -> Linked:
    """Exact: intersection / union >= similarity, by counting the tokens that sets share."""

    def linked(values: list[bytes], left: np.ndarray, right: np.ndarray) -> np.ndarray:
        sets = [np.frombuffer(v, dtype=np.uint64) for v in values]
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        n = len(sets)
        tokens, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
        _, place, count = np.unique(tokens, return_inverse=True, return_counts=True)
        several = count > 1
        number = np.cumsum(several) - 1
        kept = several[place]
        column, row = number[place[kept]], owner[kept]
        shared = np.zeros((n, n), dtype=np.int64)
        width, step = int(several.sum()), max(1024, (1 << 22) // n)
        order = np.argsort(column, kind="stable")
        column, row = column[order], row[order]
        for at in range(0, width, step):
            a, b = np.searchsorted(column, (at, at + step))
            part = np.zeros((n, min(step, width - at)), dtype=np.float32)
            part[row[a:b], column[a:b] - at] = 1
            shared += (part @ part.T).astype(np.int64)
        both = shared[left, right]
        return both * similarity.denominator >= similarity.numerator * (sizes[left] + sizes[right] - both)

    return linked


def _sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``cls, tokens`` of the classes in ``wanted`` (``cls, text_key``), from the texts themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                sets = list(shingle_sets(part.column("text")))
                yield pa.RecordBatch.from_arrays([pa.array([class_of(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "tokens"])

    texts = docs.join(wanted.select("text_key").distinct(), "text_key", "left_semi").select("text")
    found = texts.mapInArrow(run, "cls binary, tokens binary")
    return found.groupBy("cls").agg(F.first("tokens").alias("tokens"))


def _linked(docs: DataFrame, similarity: Fraction, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches of all documents, their classes, and of linked classes ``cls, label`` the group's."""
    floor = float(similarity)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.withColumn("text_key", F.xxhash64("text"))
    rows = written(sketches(texts, floor), "sketches")
    classes = written(
        rows.filter("cls is not null").groupBy("cls").agg(
            F.min("doc_id").alias("first_id"), F.min("text_key").alias("text_key"),
            F.first("signature").alias("signature"), F.first("roots").alias("roots"), F.count(F.lit(1)).alias("copies"),
        ),
        "classes",
    )
    signatures = classes.select("cls", "signature")
    members, rows_ = classes.select(F.explode("roots").alias("node"), "cls"), None
    compared, most = [], 0
    for level in range(DEPTH + 1):
        sizes = written(members.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "sizes", rows_)
        crowded = members.join(sizes, "node")
        all_, rows_, largest = (n or 0 for n in sizes.agg(F.sum("size"), F.sum(F.when(F.col("size") > ROWS, F.col("size"))), F.max("size")).first())
        most += all_
        compared.append(crowded if level == DEPTH else crowded.filter(F.col("size") <= ROWS))
        if level == DEPTH or not rows_:
            break
        members = written(_branch(crowded.filter(F.col("size") > ROWS).join(signatures, "cls"), floor), "members", 2 * rows_)
    nodes = compared[0]
    for more in compared[1:]:
        nodes = nodes.unionByName(more)
    agree = signatures_agree(least_agreement(floor))
    candidates = written(connect(nodes, "node", signatures, "signature", agree, largest if rows_ and level == DEPTH else 0, most).distinct(), "candidates", most)
    groups = written(components(candidates).withColumnsRenamed({"node": "cls"}), "groups", 2 * candidates.count())
    n = groups.count()
    sizes = written(groups.groupBy("label").agg(F.count(F.lit(1)).alias("size")), "group_sizes", n)
    largest = sizes.agg(F.max("size")).first()[0] or 0
    sets = written(_sets_of(texts, groups.join(classes, "cls").select("cls", "text_key")), "sets")
    grouped = groups.join(sizes, "label").select(F.xxhash64("label").alias("group"), "cls", "size")
    links = written(connect(grouped, "group", sets, "tokens", sets_similar(similarity), largest, n).distinct(), "links", n)
    return rows, classes, components(links).withColumnsRenamed({"node": "cls"})


def near_duplicates(docs: DataFrame, similarity: Fraction = Fraction(4, 5), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document; see the module's text."""
    rows, classes, linked = _linked(docs, similarity, id_col, text_col)
    ids = classes.select("cls", "first_id", "copies")
    named = linked.join(ids, "cls")
    least = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    one_class = ids.filter("copies > 1").join(linked, "cls", "left_anti").select("cls", F.col("first_id").alias("component_id"))
    component = written(named.join(least, "label").select("cls", "component_id").unionByName(one_class), "component")
    found = rows.select("doc_id", "n_shingles", "cls").join(component, "cls", "left")
    component_id = F.coalesce("component_id", "doc_id").alias("component_id")
    return found.select("doc_id", "n_shingles", component_id, F.col("doc_id").eqNullSafe(F.coalesce("component_id", "doc_id")).alias("kept"))


def keep_one(docs: DataFrame, similarity: Fraction = Fraction(4, 5), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, with its columns, and all without words: the one of least id
    (null last), among rows of that id the one of least class and text, and of equal rows one."""
    rows, _, linked = _linked(docs, similarity, id_col, text_col)
    texts = rows.groupBy("doc_id", "cls", "text_key").agg(F.count(F.lit(1)).alias("n")).join(linked, "cls", "left")
    order = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "cls", "text_key", "n")
    least = texts.filter("cls is not null").groupBy(F.coalesce("label", "cls").alias("label")).agg(F.min(order).alias("r")).select("r.*")
    chosen = written(least.unionByName(texts.filter("cls is null").withColumns({"no_id": F.isnull("doc_id"), "n": F.lit(1).cast("long")}).select(least.columns)), "chosen")
    # rows of one id and one text are equal but for further columns: those of one of them stay
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"), whole)

    def of(ids: DataFrame) -> DataFrame:
        ids = ids.select(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key"))
        return keyed.join(ids, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_key") == F.col("kept_key")), "left_semi")

    repeated = of(chosen.filter("n > 1")).groupBy("doc_id", "text_key").agg(F.first("whole").alias("whole"))
    return of(chosen.filter("n = 1")).select("whole.*").unionByName(repeated.select("whole.*"))
