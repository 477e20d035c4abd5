"""Toxicity of documents by compression distance.

Each window of a few words is compressed with two zstandard dictionaries; a window that the toxic
dictionary makes shorter than the ordinary one speaks for label 1. Boosted trees over how many of a
document's windows reach each threshold of that difference turn it into a probability.

Only the ordinary dictionary is trained by zstandard. Most of a toxic text is ordinary, words are
spelled in many ways, and two dictionaries trained apart differ by more than a toxic word saves (the
README has figures). The toxic dictionary is therefore the ordinary one followed by a list of words: the
beginnings, with their commonest continuations, of words that occur in many more toxic than ordinary
documents of the training sample. Sizes then differ only where such words occur. The trees stand in for
single calibrated thresholds.

Training sees a bounded sample of labelled rows outside the held-out fold, and of each the whole
text, as scoring does: tasks count the beginnings of words, draw windows for the dictionary by hash
and measure the features; only those come to the driver. Each half of the sample is measured with
dictionaries of the other half to fit the trees. Null text counts as empty and gets a score;
without labels of both kinds every document gets the sample's rate (0.5 without any). Rows, null
and repeated ids and further columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.llm import boosting
from fleetmart.llm.labelled import features_of, held_out, training_rows, unused_column, with_score
from fleetmart.llm.shared import process_cache, written

#: Labelled rows that a model is fitted on, at most.
POSITIVES, NEGATIVES = 4_000, 6_000
WINDOW = 32
DICTIONARY_BYTES = 32 << 10
#: Windows of the least hash, from anywhere in a text, that the ordinary dictionary is trained on.
DRAWN = 40
#: Words of the toxic dictionary: lengths of beginnings in bytes, with the space before; toxic
#: documents that must have one; by how many standard deviations they must exceed the number to
#: expect, and by which factor (log) the share among ordinary ones; number of words; how a beginning is continued, and in how many ways.
BEGINNINGS, LEAST_DOCS, LEAST_DEVIATION, LEAST_LOG_RATIO, MOST_PHRASES = range(4, 9), 4, 7.0, 1.8, 200
CONTINUED, MOST_CONTINUED, LONGEST = 3, 16, 16
#: Continuations of one marking word that are told apart, the most frequent first.
MOST_CONTEXTS = 5_000
#: Rows whose beginnings are counted at once.
COUNTED_AT_ONCE = 100
STEPS = 14
WIDTH = 2 * STEPS + 5


class Model(NamedTuple):
    ordinary: bytes
    toxic: bytes
    trees: boosting.Trees


def plain(text: str) -> bytes:
    """Lower case, with one space between words and at both ends."""
    return b" " + b" ".join(text.lower().encode("utf-8", "replace").split()) + b" "


def windows(data: bytes, size: int = WINDOW) -> list[bytes]:
    """The whole text in parts of about ``size`` bytes that overlap in the space between words."""
    out = []
    at, end = 0, len(data) - 1
    while at < end:
        cut = data.find(b" ", at + size)
        cut = end if cut < 0 else min(cut, at + 4 * size)
        out.append(data[at : cut + 1])
        at = cut
    return out or [data]


def _beginnings(data: bytes, n: int) -> np.ndarray:
    """The distinct first ``n`` bytes of words, the space before included, as numbers."""
    b = np.frombuffer(data, dtype=np.uint8)
    at = np.flatnonzero(b[: max(0, len(b) - n + 1)] == 32)
    if not len(at):
        return np.empty(0, dtype=np.uint64)
    parts = b[at[:, None] + np.arange(n)]
    whole = ~(parts[:, 1 : n - 1] == 32).any(axis=1)
    number = np.zeros(len(at), dtype=np.uint64)
    for k in range(n):
        number = number << np.uint64(8) | parts[:, k].astype(np.uint64)
    return np.unique(number[whole])


def family(data: bytes) -> int:
    """Least hash of three words in a row: copies have the same, whose words would otherwise seem
    frequent."""
    words = data.split()
    return min((zlib.crc32(b" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))), default=0)


def drawn_windows(data: bytes, seed: int) -> list[bytes]:
    """Windows for the ordinary dictionary: those of least hash of the whole text."""
    parts = [w for w in windows(data, 64) if len(w) >= 8]
    return heapq.nsmallest(DRAWN, parts, key=lambda w: (zlib.crc32(w, seed & 0xFFFFFFFF), w))


def _described(sample: DataFrame) -> pa.Table:
    """Of each row its family and, of an ordinary one, the windows drawn for the dictionary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [plain(t) for t in batch.column("text").to_pylist()]
            drawn = [[] if y else drawn_windows(d, key) for d, y, key in zip(texts, batch.column("y").to_pylist(), batch.column("key").to_pylist(), strict=True)]
            columns = [batch.column(c) for c in ("doc_id", "key", "y")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([family(d) for d in texts], pa.int64()), pa.array(drawn, pa.list_(pa.binary()))], names=["doc_id", "key", "y", "family", "windows"])

    return sample.mapInArrow(run, "doc_id long, key long, y int, family long, windows array<binary>").toArrow()


def _marks(sample: DataFrame, toxic: int, ordinary: int) -> list[bytes]:
    """Beginnings of words that mark toxic documents: the shortest that qualify. ``toxic`` and
    ``ordinary``: how many rows the sample has of each."""
    if not toxic or not ordinary:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, COUNTED_AT_ONCE):
                part = batch.slice(at, COUNTED_AT_ONCE)
                texts, y = [plain(t) for t in part.column("text").to_pylist()], part.column("y").to_pylist()
                for n in BEGINNINGS:
                    for label in set(y):
                        marks, counts = np.unique(np.concatenate([_beginnings(d, n) for d, own in zip(texts, y, strict=True) if own == label]), return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(marks), n), pa.int64()), pa.array(marks.view(np.int64)), *(pa.array(counts * (label == k), pa.int64()) for k in (1, 0))],
                            names=["n", "mark", "n1", "n0"],
                        )

    counted = sample.mapInArrow(run, "n long, mark long, n1 long, n0 long").groupBy("n", "mark").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    n1, n0 = F.col("n1"), F.col("n0")
    ratio = F.log((n1 + 0.1) / (toxic + 0.2)) - F.log((n0 + 0.3) / (ordinary + 0.6))
    expected = (n1 + n0) * (toxic / (toxic + ordinary))
    found = counted.filter((n1 >= LEAST_DOCS) & (ratio > LEAST_LOG_RATIO) & (n1 - expected > LEAST_DEVIATION * F.sqrt(expected)))
    chosen: list[bytes] = []
    for r in sorted(found.select("n", "mark").collect()):
        word = r.mark.to_bytes(8, "big")[8 - r.n :]
        if not any(word.startswith(c) for c in chosen):
            chosen.append(word)
    return chosen


def _contexts(sample: DataFrame, words: list[bytes]) -> dict[bytes, Counter[bytes]]:
    """For each of the words, how often it occurs in toxic rows with which continuation: at most
    two bytes beyond the next space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met: Counter[tuple[bytes, bytes]] = Counter()
            for data in map(plain, batch.column("text").to_pylist()):
                for word in words:
                    at = data.find(word)
                    while at >= 0:
                        upto = min(at + LONGEST + CONTINUED, data.find(b" ", at + 1) + CONTINUED)
                        met[word, data[at : max(upto, at + len(word))]] += 1
                        at = data.find(word, at + 1)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in met], pa.binary()), pa.array([k[1] for k in met], pa.binary()), pa.array(list(met.values()), pa.int64())], names=["word", "context", "n"])

    out: dict[bytes, Counter[bytes]] = {word: Counter() for word in words}
    if words:
        counted = sample.filter("y = 1").mapInArrow(run, "word binary, context binary, n long").groupBy("word", "context").agg(F.sum("n").alias("n"))
        first = Window.partitionBy("word").orderBy(F.desc("n"), "context")
        for r in counted.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= MOST_CONTEXTS).collect():
            out[bytes(r.word)][bytes(r.context)] = r.n
    return out


def phrases(contexts: dict[bytes, Counter[bytes]]) -> list[bytes]:
    """The words, the most frequent last, continued as long as most of their occurrences continue
    alike."""
    found = []
    for word, met in contexts.items():
        n_found = sum(met.values())
        while not word.endswith(b" ") and len(word) < LONGEST:
            following: Counter[bytes] = Counter()
            for context, n in met.items():
                if context.startswith(word):
                    following[context[len(word) : len(word) + 1]] += n
            after, n = min(following.items(), key=lambda x: (-x[1], x[0]))
            if n < 0.6 * sum(following.values()) or not after:
                break
            word += after
        if not word.endswith(b" "):  # a short match saves little: add the commonest ways to go on
            longer: Counter[bytes] = Counter()
            for context, n in met.items():
                if context.startswith(word) and len(context) >= len(word) + CONTINUED:
                    longer[context[: len(word) + CONTINUED]] += n
            found += sorted(((n, w) for w, n in longer.items()), reverse=True)[:MOST_CONTINUED]
        found.append((n_found, word))
    return [word for _, word in sorted(found)[-MOST_PHRASES:]]


def ordinary_dictionary(samples: list[bytes]) -> bytes:
    samples = samples[:: max(1, len(samples) // 40_000)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=64, d=8, steps=1).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: take it as it is
        return b"".join(samples)[:DICTIONARY_BYTES] or b" " * 8


class Distance:
    """Sizes of windows under both dictionaries."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        how = zstandard.ZstdCompressionParameters.from_level(5, write_content_size=0, write_checksum=0, write_dict_id=0, min_match=4)
        self.sizes = []
        for content in (ordinary, toxic):
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=how)
            self.sizes.append(zstandard.ZstdCompressor(dict_data=held, compression_params=how).compress)

    def features(self, data: bytes) -> list[float]:
        """Of a plain text: windows that reach each difference, and their share."""
        parts = windows(data)
        plainly, own = self.sizes
        ordinary = np.fromiter((len(plainly(w)) for w in parts), dtype=np.int64, count=len(parts))
        toxic = np.fromiter((len(own(w)) for w in parts), dtype=np.int64, count=len(parts))
        gain = ordinary - toxic
        reach = np.array([(gain >= k).sum() for k in range(1, STEPS + 1)], dtype=np.float64)
        return [*np.log1p(reach), *(reach / len(parts)), float(gain.mean()), float(gain.max()), float(np.log1p(len(parts))), float(ordinary.sum() / len(data)), float(np.sort(gain)[-2:].sum())]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", *, positives: int = POSITIVES, negatives: int = NEGATIVES, id_col: str = "doc_id", text_col: str = "text") -> Model:
    rows = training_rows(docs, labels, label, positives=positives, negatives=negatives, id_col=id_col, text_col=text_col)
    sample = written(rows.select("doc_id", "y", "text", F.xxhash64("text").alias("key")).dropDuplicates(["doc_id", "key"]), "toxicity_sample")
    got = _described(sample).to_pylist()
    got.sort(key=lambda r: (r["doc_id"], r["key"]))
    y = np.array([r["y"] for r in got], dtype=np.int64)
    if not len(y) or y.min() == y.max():
        return Model(b" " * 8, b" " * 8, boosting.constant((y.sum() + 0.5) / (len(y) + 1)))
    fold = np.zeros(len(y), dtype=np.int64)
    for k in (0, 1):
        fold[y == k] = np.arange((y == k).sum()) % 2

    def first_of_families(members: np.ndarray) -> np.ndarray:
        out, seen = np.zeros(len(y), dtype=bool), set()
        for i in members.tolist():
            if (y[i], got[i]["family"]) not in seen:
                seen.add((y[i], got[i]["family"]))
                out[i] = True
        return out

    sets = {name: np.flatnonzero(chosen) for name, chosen in (("in_0", fold == 0), ("in_1", fold == 1), ("in_all", fold >= 0))}
    firsts = {name: first_of_families(members) for name, members in sets.items()}
    dealt = pa.table({"doc_id": pa.array([r["doc_id"] for r in got], pa.int64()), "key": pa.array([r["key"] for r in got], pa.int64()), "fold": fold, **firsts})
    sample = sample.join(F.broadcast(sample.sparkSession.createDataFrame(dealt)), ["doc_id", "key"])

    def trained(name: str) -> tuple[bytes, bytes]:
        base = ordinary_dictionary([w for i in sets[name] for w in got[i]["windows"]])
        counted = y[firsts[name]]
        rows = sample.filter(name)
        words = _marks(rows, int(counted.sum()), int((1 - counted).sum()))
        return base, base + b"".join(phrases(_contexts(rows, words)))

    found = []
    for own, other in ((0, "in_1"), (1, "in_0")):
        pair = trained(other)
        found.append(features_of(sample.filter(F.col("fold") == own), lambda texts, pair=pair: _measured(*pair, texts), WIDTH))
    x, labels_ = (np.concatenate(parts) for parts in zip(*found, strict=True))
    return Model(*trained("in_all"), boosting.fit(x, labels_, depth=3, trees=80))


def _measured(ordinary: bytes, toxic: bytes, texts: list[str]) -> np.ndarray:
    own = process_cache(("distance", ordinary, toxic), lambda: Distance(ordinary, toxic))
    return np.array([own.features(plain(t)) for t in texts], dtype=np.float64).reshape(-1, WIDTH)


def _scored(model: Model, texts: list[str]) -> np.ndarray:
    return boosting.predict(model.trees, _measured(model.ordinary, model.toxic, texts))


def score(docs: DataFrame, model: Model, name: str = "score", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and the probability of label 1 in the new column ``name``."""
    return with_score(docs, lambda texts: _scored(model, texts), name, text_col)


def keep(docs: DataFrame, model: Model, threshold: float, text_col: str = "text") -> DataFrame:
    """The documents that score below ``threshold``, with their columns; all documents if the model
    has seen no labels of both kinds."""
    if not len(model.trees.feature):
        return docs
    name = unused_column(docs, "toxicity_score")
    return score(docs, model, name, text_col).filter(F.col(name) < threshold).drop(name)


def scores(docs: DataFrame, model: Model, threshold: float) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return score(rows, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
