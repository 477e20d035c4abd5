"""Repeated passages by bucket-pointer refinement of a sparse suffix array.

A byte is removed if a string of ``length`` bytes that covers it also starts anywhere else, in any
document; strings are judged on the input. Suffixes are put into buckets by their first q bytes
(q = ``GRAM``). Then buckets are refined: a suffix's bucket for twice as many bytes is found by sorting on
the pair of the bucket that it lies in and the bucket of the suffix that begins where the first bytes
end, and the numbers of the new buckets are written back and used by the next refinement in the same way,
for 2q, 4q, ... bytes up to ``length`` (the last pair overlaps). Suffixes alone in their bucket drop out.

A full suffix array would be many times the corpus. Only sampled suffixes are therefore sorted first: of
the ``length - q + 1`` q-grams in a string, the first of least hash. Equal strings sample the same
place, so every repeat has a sampled suffix in a bucket of two or more. The strings that share a
sample form an interval of starts [lo, hi].

1. Samples are grouped by bucket, and within it by the buckets at the later offsets that span the
   whole context [lo, hi + length). Alone in its bucket: none of its strings repeats. Context met
   twice: all of them do.
2. What is left lies at the ends of repeats. Their strings, and those of one sample of each context
   that shares a bucket with them, are refined one by one, q bytes first, as said above.

Q-grams are named by 64-bit hashes, all larger buckets by numbers that are given out by sorting. A wrong
match takes equal hashes of different grams at all offsets of a string at once, two for 200 bytes: with 10^12
strings the chance of one is about 10^24 / 2^128, below 10^-14. A sample's bucket and context are two
hashes of 64 bits too.

Documents travel in chunks of a few megabytes, a written table, and a chunk sends each distinct sample
or string once to each bucket, so a passage that very many documents share is aggregated before the
shuffle; samples of a q-gram that a chunk holds in ``HOT`` contexts or more are dealt out by context
instead of by q-gram. Verdicts and numbers return packed.

Texts are UTF-8 bytes (null: empty). Null and repeated ids are carried along, each row is a
document, an empty table gives an empty result. Long documents are worked through in segments.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.llm.hashing import Stretches, mixed
from fleetmart.llm.labelled import unused_column
from fleetmart.llm.shared import written
from fleetmart.llm.taskfiles import groups_of, pack, unpack

_U = np.uint64
GRAM = 128
CHUNK = 4 << 20
SEGMENT = 1 << 18
HOT = 8
#: What a document adds to its chunk besides its bytes, so that empty ones fill chunks too.
PER_DOCUMENT = 64
#: Bytes of text for each bucket of a round.
BUCKET = 16 << 20
NONE, ALL, SUBMIT, MARKER = 0, 1, 2, 128

SENT = "route int, bucket long, chunk_id long, payload binary"


class Samples(NamedTuple):
    """Sampled suffixes of a chunk: the starts [lo, hi] of their strings, q-gram and context."""

    lo: np.ndarray
    hi: np.ndarray
    gram: np.ndarray
    context: np.ndarray


def samples(data: np.ndarray, ends: np.ndarray, length: int) -> Samples:
    """Of documents in ``data``: document ``i`` lies from ``ends[i]`` to ``ends[i + 1]``, with one
    byte after it that isn't its own."""
    span = length - GRAM + 1
    parts: list[Samples] = []
    starts, stops = ends[:-1], ends[1:] - 1  # without the byte between documents
    for at in range(0, max(0, len(data) - length + 1), SEGMENT):
        piece = data[at : at + SEGMENT + length - 1]
        n = len(piece) - length + 1
        hashed = Stretches(piece)
        last = len(piece) - GRAM + 1
        gram = hashed.raw(slice(0, last), slice(GRAM, last + GRAM))
        key = (gram * _U(0xC2B2AE3D27D4EB4F)) & _U(0xFFFFFFFF00000000)
        key |= np.arange(last, dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        if width < span:
            key = np.minimum(key[: len(key) - (span - width)], key[span - width :])
        chosen = (key[:n] & _U(0xFFFFFFFF)).astype(np.int64)
        whole = np.zeros(n + 1, dtype=np.int32)  # starts of strings that end within their document
        a, b = np.clip(starts - at, 0, n), np.clip(stops - length + 1 - at, 0, n)
        some = b > a
        np.add.at(whole, a[some], 1)
        np.add.at(whole, b[some], -1)
        inside = np.cumsum(whole[:-1]) > 0
        edge = np.ones(n + 1, dtype=bool)
        edge[1:-1] = (chosen[1:] != chosen[:-1]) | (inside[1:] != inside[:-1])
        edge[np.clip(ends - at, 0, n)] = True
        cuts = np.flatnonzero(edge)
        lo, hi = cuts[:-1], cuts[1:] - 1
        good = inside[lo]
        lo, hi = lo[good], hi[good]
        place = chosen[lo]
        later = hi + length - GRAM
        context = np.zeros(len(lo), dtype=np.uint64)
        for k in range(-(-(2 * length - GRAM) // GRAM)):  # offsets that span the longest context
            context += mixed(gram[np.minimum(lo + k * GRAM, later)] + _U(k)) * _U(2 * k + 1)
        context += mixed(((place - lo) << 32 | (hi - lo)).astype(np.uint64)) * _U(7)
        parts.append(Samples(lo + at, hi + at, mixed(gram[place]), mixed(context)))
    if not parts:
        empty = np.empty(0, dtype=np.int64)
        return Samples(empty, empty, empty.view(np.uint64), empty.view(np.uint64))
    return Samples(*(np.concatenate(c) for c in zip(*parts, strict=True)))


class Classes(NamedTuple):
    """Distinct (q-gram, context) of a chunk, and how they are sent."""

    of_sample: np.ndarray
    first: np.ndarray  # a sample of each class
    sent: list[tuple[int, int, np.ndarray, bytes]]  # route, bucket, classes (-1: marker), payload


def classes(found: Samples, buckets: int) -> Classes:
    n = len(found.gram)
    order = np.lexsort((found.context, found.gram))
    gram, context = found.gram[order], found.context[order]
    new_gram = np.ones(n, dtype=bool)
    new_gram[1:] = gram[1:] != gram[:-1]
    new = new_gram.copy()
    new[1:] |= context[1:] != context[:-1]
    at = np.flatnonzero(new)
    number = np.cumsum(new) - 1
    of_sample = np.empty(n, dtype=np.int64)
    of_sample[order] = number
    weight = np.minimum(np.diff(np.append(at, n)), 2).astype(np.uint8)
    gram, context, new_gram = gram[at], context[at], new_gram[at]
    gram_number = np.cumsum(new_gram) - 1
    hot = np.bincount(gram_number)[gram_number] >= HOT if len(at) else np.zeros(0, dtype=bool)
    marked = np.flatnonzero(hot & new_gram)
    plain = np.flatnonzero(~hot)
    sent = []
    for route, members, key, weights, contexts in (
        (0, np.concatenate([plain, np.full(len(marked), -1)]), np.concatenate([gram[plain], gram[marked]]), np.concatenate([weight[plain], np.full(len(marked), MARKER | 2, np.uint8)]), np.concatenate([context[plain], np.zeros(len(marked), np.uint64)])),
        (1, np.flatnonzero(hot), context[hot], weight[hot], context[hot]),
    ):
        grams = key if route == 0 else gram[hot]
        target = (key % _U(buckets)).astype(np.int64)
        by = np.argsort(target, kind="stable")
        cuts = np.flatnonzero(np.diff(target[by])) + 1
        for part in np.split(by, cuts):
            if len(part):
                payload = grams[part].tobytes() + contexts[part].tobytes() + weights[part].tobytes()
                sent.append((route, int(target[part[0]]), members[part], payload))
    return Classes(of_sample, order[at], sent)


def judge_classes(route: int, payloads: list[bytes]) -> list[bytes]:
    """Round 1, for one bucket: the verdict on every class of every chunk."""
    sizes = [len(p) // 17 for p in payloads]
    gram = np.concatenate([np.frombuffer(p, _U, n) for p, n in zip(payloads, sizes, strict=True)])
    context = np.concatenate([np.frombuffer(p, _U, n, 8 * n) for p, n in zip(payloads, sizes, strict=True)])
    weight = np.concatenate([np.frombuffer(p, np.uint8, n, 16 * n) for p, n in zip(payloads, sizes, strict=True)])
    marker, weight = weight & MARKER > 0, (weight & 3).astype(np.int64)
    order = np.lexsort((context, gram))
    gram, context, weight, marker = gram[order], context[order], weight[order], marker[order]
    new_gram = np.ones(len(gram), dtype=bool)
    new_gram[1:] = gram[1:] != gram[:-1]
    new = new_gram.copy()
    new[1:] |= context[1:] != context[:-1]
    of_gram, of_class = np.cumsum(new_gram) - 1, np.cumsum(new) - 1
    in_class = np.bincount(of_class, weight)[of_class]
    in_gram = np.bincount(of_gram, weight)[of_gram]
    single = in_class < 2
    open_ = np.bincount(of_gram, single | marker)[of_gram] > 0
    repeated = in_gram >= 2
    if route == 1:
        open_[:] = repeated[:] = True
    verdict = np.where(~repeated, NONE, np.where(single, SUBMIT, np.where(open_ & new, ALL | SUBMIT, ALL))).astype(np.uint8)
    out = np.empty_like(verdict)
    out[order] = verdict
    return [p.tobytes() for p in np.split(out, np.cumsum(sizes)[:-1])]


def refined_sizes(length: int) -> list[int]:
    """For how many bytes strings are told apart, one after the other."""
    sizes = [GRAM]
    while sizes[-1] < length:
        sizes.append(min(length, 2 * sizes[-1]))
    return sizes


def judge_strings(bucket: int, buckets: int, payloads: list[bytes]) -> list[bytes]:
    """For one bucket of keys (pairs of numbers): the number of each string that occurs twice, 0 for others."""
    parts = [np.frombuffer(zstandard.decompress(p), dtype=np.uint8) for p in payloads]
    sizes = [len(p) // 17 for p in parts]
    first, second = (np.concatenate([np.ascontiguousarray(p[8 * n * k : 8 * n * (k + 1)].reshape(8, n).T).view(_U).reshape(-1) for p, n in zip(parts, sizes, strict=True)]) for k in (0, 1))
    weight = np.concatenate([p[16 * n :] for p, n in zip(parts, sizes, strict=True)])
    order = np.lexsort((second, first))
    first, second = first[order], second[order]
    new = np.ones(len(first), dtype=bool)
    new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    of = np.cumsum(new) - 1
    repeated = np.bincount(of, weight[order]) >= 2
    number = np.where(repeated, np.cumsum(repeated) * buckets + bucket, 0)
    out = np.empty(len(of), dtype=np.int64)
    out[order] = number[of]
    return [pack(p) for p in np.split(out, np.cumsum(sizes)[:-1])]


def _answers(sent: DataFrame, judge: Callable[[int, int, list[bytes]], list[bytes]]) -> DataFrame:
    """``chunk_id, verdicts``: what every bucket says about what a chunk sent to it."""

    def run(rows: pa.Table) -> pa.Table:
        verdicts = judge(rows.column("route")[0].as_py(), rows.column("bucket")[0].as_py(), rows.column("payload").to_pylist())
        return pa.table({"route": rows.column("route"), "bucket": rows.column("bucket"), "chunk_id": rows.column("chunk_id"), "verdict": pa.array(verdicts, pa.binary())})

    answered = sent.groupBy("route", "bucket").applyInArrow(run, "route int, bucket long, chunk_id long, verdict binary")
    return answered.groupBy("chunk_id").agg(F.collect_list(F.struct("route", "bucket", "verdict")).alias("verdicts"))


class Chunk:
    """A chunk as read back, and what the rounds have said about it."""

    def __init__(self, text: bytes, ends: list[int], length: int, buckets: int):
        self.raw = zstandard.ZstdDecompressor().decompress(text)
        self.data, self.ends, self.length, self.buckets = np.frombuffer(self.raw, dtype=np.uint8), np.array(ends, dtype=np.int64), length, buckets
        self.samples = samples(self.data, self.ends, length)
        self.classes = classes(self.samples, buckets)

    def judged(self, verdicts: list[dict] | None) -> None:
        said = {(v["route"], v["bucket"]): v["verdict"] for v in verdicts or []}
        verdict = np.zeros(len(self.classes.first), dtype=np.uint8)
        for route, bucket, members, _ in self.classes.sent:
            own = members >= 0
            verdict[members[own]] = np.frombuffer(said[route, bucket], dtype=np.uint8)[own]
        self.all = verdict[self.classes.of_sample] & ALL > 0
        submit = self.classes.first[verdict & SUBMIT > 0]
        lo, hi = self.samples.lo[submit], self.samples.hi[submit]
        sizes = hi - lo + 1
        ends = np.cumsum(sizes)
        places = np.sort(np.repeat(lo - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0))
        self.sizes = refined_sizes(self.length)
        self.places = [places]  # the starts whose strings are told apart at each size
        for size, shorter in zip(self.sizes[:0:-1], self.sizes[-2::-1], strict=True):
            self.places.insert(0, np.union1d(self.places[0], self.places[0] + (size - shorter)))
        self.numbers: list[np.ndarray] = []  # of each size so far: the bucket of each start, 0 if alone

    def keys(self) -> tuple[np.ndarray, list[tuple[int, np.ndarray]], np.ndarray, list[bytes]]:
        """Of the next size: for each start its distinct string (-1: alone already), and the distinct ones by
        bucket, with what is sent to each."""
        k = len(self.numbers)
        places = self.places[k]
        if k == 0:
            first, second = self._grams(places), np.zeros(len(places), dtype=_U)
            open_ = np.ones(len(places), dtype=bool)
        else:
            before = self.places[k - 1]
            first, second = (self.numbers[k - 1][np.searchsorted(before, places + by)].astype(_U) for by in (0, self.sizes[k] - self.sizes[k - 1]))
            open_ = (first > 0) & (second > 0)
        at = np.flatnonzero(open_)
        order = at[np.lexsort((second[at], first[at])) if k else np.argsort(first[at])]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (first[order[1:]] != first[order[:-1]]) | (second[order[1:]] != second[order[:-1]])
        of = np.full(len(places), -1, dtype=np.int64)
        of[order] = np.cumsum(new) - 1
        start = np.flatnonzero(new)
        first, second = first[order[start]], second[order[start]]
        weights = np.minimum(np.diff(np.append(start, len(order))), 2).astype(np.uint8)
        target = (mixed(first + second * _U(0x9E3779B97F4A7C15)) % _U(self.buckets)).astype(np.int64)
        groups = groups_of(target, self.buckets) if len(target) else []
        planes = lambda x: x.view(np.uint8).reshape(len(x), 8).T.tobytes()
        sent = [zstandard.compress(planes(first[own]) + planes(second[own]) + weights[own].tobytes(), 1) for _, own in groups]
        return of, groups, weights, sent

    def refine(self, verdicts: list[dict] | None) -> None:
        """Take the numbers of the next size."""
        of, groups, weights, _ = self.keys()
        said = {v["bucket"]: v["verdict"] for v in verdicts or []}
        number = np.zeros(len(weights) + 1, dtype=np.int64)  # the last: alone already
        for bucket, own in groups:
            number[own] = unpack(said[bucket])
        self.numbers.append(number[of])

    def _grams(self, places: np.ndarray) -> np.ndarray:
        """The q-grams that begin at these places, as numbers."""
        if not len(places):
            return np.empty(0, dtype=_U)
        cut = np.flatnonzero(np.diff(places) > GRAM) + 1
        runs = list(zip([0, *cut.tolist()], [*cut.tolist(), len(places)], strict=True))
        out, k = [], 0
        while k < len(runs):  # stretches of places that lie close, some hundred thousand bytes at a time
            upto, size = k, 0
            while upto < len(runs) and size < SEGMENT:
                size += int(places[runs[upto][1] - 1] - places[runs[upto][0]]) + GRAM
                upto += 1
            parts, at, base = [], [], 0
            for a, b in runs[k:upto]:
                parts.append(self.data[places[a] : places[b - 1] + GRAM])
                at.append(places[a:b] - places[a] + base)
                base += len(parts[-1])
            starts = np.concatenate(at)
            out.append(mixed(Stretches(np.concatenate(parts)).raw(starts, starts + GRAM)))
            k = upto
        return np.concatenate(out)

    def removed(self) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the maximal runs of covered bytes."""
        single = self.places[-1][self.numbers[-1] > 0]
        begin = np.concatenate([self.samples.lo[self.all], single])
        end = np.concatenate([self.samples.hi[self.all], single]) + self.length
        order = np.argsort(begin, kind="stable")
        begin, end = begin[order], np.maximum.accumulate(end[order]) if len(order) else end
        new = np.ones(len(begin), dtype=bool)
        new[1:] = begin[1:] > end[:-1]
        last = np.append(new[1:], True) if len(begin) else new
        return begin[new], end[last]


def _chunks(docs: DataFrame) -> DataFrame:
    """Documents in chunks of about ``CHUNK`` bytes: ``text`` (zstandard), ``ends``, ``rest`` (the
    other columns). A byte between documents keeps their runs apart."""
    rest = docs.schema["rest"].dataType
    schema = T.StructType([T.StructField("text", T.BinaryType()), T.StructField("ends", T.ArrayType(T.LongType())), T.StructField("rest", T.ArrayType(rest))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, others, size = [], [], 0

        def packed() -> pa.RecordBatch:
            ends = np.concatenate([[0], np.cumsum([len(t) + 1 for t in held])])
            struct = pa.concat_arrays(others)
            columns = [pa.array([zstandard.ZstdCompressor(level=3).compress(b"\0".join([*held, b""]))], pa.binary()), pa.array([ends.tolist()], pa.list_(pa.int64())), pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), struct)]
            return pa.RecordBatch.from_arrays(columns, names=["text", "ends", "rest"])

        for batch in batches:
            texts, other, at = batch.column("text").to_pylist(), batch.column("rest"), 0
            for i, text in enumerate(texts):
                held.append(text)
                size += len(text) + PER_DOCUMENT
                if size >= CHUNK:
                    others.append(other.slice(at, i + 1 - at))
                    yield packed()
                    held, others, size, at = [], [], 0, i + 1
            if at < len(texts):
                others.append(other.slice(at))
        if held:
            yield packed()

    return written(docs.mapInArrow(run, schema).withColumn("chunk_id", F.monotonically_increasing_id()), "chunks")


def _sent(chunks: DataFrame, length: int, buckets: int, rounds: int | None) -> DataFrame:
    """What chunks send: samples (``rounds`` None), or strings after so many rounds of refinement."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.select([c for c in batch.schema.names if c != "rest"]).to_pylist():
                chunk = Chunk(row["text"], row["ends"], length, buckets)
                if rounds is None:
                    out = [(route, bucket, payload) for route, bucket, _, payload in chunk.classes.sent]
                else:
                    chunk.judged(row["samples"])
                    for k in range(rounds):
                        chunk.refine(row[f"round_{k}"])
                    _, groups, _, payloads = chunk.keys()
                    out = [(0, bucket, payload) for (bucket, _), payload in zip(groups, payloads, strict=True)]
                routes, targets, payloads = zip(*out, strict=True) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(routes, pa.int32()), pa.array(targets, pa.int64()), pa.array([row["chunk_id"]] * len(out), pa.int64()), pa.array(payloads, pa.binary())], names=["route", "bucket", "chunk_id", "payload"])

    return chunks.mapInArrow(run, SENT)


def remove_repeats(docs: DataFrame, length: int = 200, text_col: str = "text", as_text: bool = False) -> DataFrame:
    """Column ``rest`` (a struct of all columns of ``docs`` but the text), ``n_bytes, n_removed,
    n_spans`` and ``kept``, the remaining bytes or their text, for every row."""
    if length <= GRAM:
        raise ValueError(f"length must be above {GRAM}")
    others = [F.col(c) for c in docs.columns if c != text_col]
    rest = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    chunks = _chunks(docs.select(F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"), rest.alias("rest")))
    total = chunks.agg(F.sum(F.element_at("ends", -1))).first()[0] or 0
    buckets = max(16, -(-total // BUCKET))
    bare = chunks.select("chunk_id", "text", "ends")
    said = written(_answers(_sent(bare, length, buckets, None), lambda route, _, payloads: judge_classes(route, payloads)), "samples").withColumnRenamed("verdicts", "samples")
    rounds = len(refined_sizes(length))
    for k in range(rounds):
        sent = _sent(bare.join(said, "chunk_id", "left"), length, buckets, k)
        numbers = written(_answers(sent, lambda _, bucket, payloads: judge_strings(bucket, buckets, payloads)), "numbers")
        said = said.join(numbers.withColumnRenamed("verdicts", f"round_{k}"), "chunk_id", "left")
    names = ["samples", *(f"round_{k}" for k in range(rounds))]
    kind = chunks.schema["rest"].dataType.elementType
    schema = T.StructType([T.StructField("rest", kind), *(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept", T.StringType() if as_text else T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rests = batch.column("rest")
            for k, row in enumerate(batch.select(["text", "ends", *names]).to_pylist()):
                chunk = Chunk(row["text"], row["ends"], length, buckets)
                chunk.judged(row["samples"])
                for name in names[1:]:
                    chunk.refine(row[name])
                begin, end = chunk.removed()
                kept, n_removed = [], []
                cuts = np.searchsorted(begin, chunk.ends)
                for a, b, x, y in zip(chunk.ends[:-1].tolist(), chunk.ends[1:].tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    at, parts = a, []
                    for s, t in zip(begin[x:y].tolist(), end[x:y].tolist(), strict=True):
                        parts.append(chunk.raw[at:s])
                        at = t
                    kept.append(b"".join([*parts, chunk.raw[at : b - 1]]))
                    n_removed.append(b - 1 - a - len(kept[-1]))
                sizes = np.diff(chunk.ends) - 1
                own = rests.slice(k, 1).flatten()
                column = pa.array([t.decode("utf-8", "ignore") for t in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
                yield pa.RecordBatch.from_arrays([own, pa.array(sizes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(np.diff(cuts), pa.int64()), column], names=["rest", "n_bytes", "n_removed", "n_spans", "kept"])

    return chunks.join(said, "chunk_id", "left").select("rest", "text", "ends", *names).mapInArrow(run, schema)


def cleaned(docs: DataFrame, length: int = 200, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """The documents with what remains of their texts, and its length in ``size_col`` if they have
    that column. Bytes of characters that a removal cut in two are dropped; null text stays null."""
    docs = docs.withColumn(text_col, F.col(text_col).cast("string"))
    empty = unused_column(docs, "no_text")
    found = remove_repeats(docs.withColumn(empty, F.col(text_col).isNull()), length, text_col, as_text=True)
    text = F.when(~F.col(f"rest.`{empty}`"), F.col("kept"))
    new = {text_col: text} | ({size_col: F.length(text).cast(docs.schema[size_col].dataType)} if size_col in docs.columns else {})
    return found.select(*(new.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns))
