"""Collocations: frequent phrases whose parts meet more often than their frequencies explain.

The texts of a language are cut into shards of about ``SHARD_WORDS`` words, between pieces. A shard
is indexed once over its word numbers: suffixes are sorted by their first ``LONGEST`` words, and the
word before each suffix (the transform, BWT) is kept in a file of the shard's own; it gives the row of the
suffix one word longer (last to first, LF). Words that are not frequent break phrases like punctuation does.

An interval of rows stands for a phrase. All intervals of a length are extended to the left at
once: the LF targets of an interval's rows that fall into the interval of another phrase are the
rows of a phrase one word longer, of which the first phrase is all but the first word and the
second all but the last. So each phrase is known by its two shorter ones and its count is the size
of its interval. Counts are summed over shards before the next length, and only frequent phrases
are extended: a phrase cannot be more frequent than its parts, so nothing is missed. Phrases are
told apart by the exact pair of their parts, never by a hash.

Scale: a shard sends each distinct phrase of frequent parts once, however often it holds it, as steps
in packed arrays, one row to each bucket of phrases; buckets add up and answer with the frequent ones
only. Indexes lie in files and are never shuffled. Nothing is collected; the best of a language are
chosen in two steps, salted first.

Null texts: empty. Null ``lang``: ``und``. Texts without words add nothing. Equal scores are
ordered by count and phrase. Rows with equal or null ids are documents like others. An empty
table gives an empty result; further columns are left out. Memory follows the shard, which only a
piece of more than ``SHARD_WORDS`` words without a break makes longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.llm.hashing import Stretches, buffers, mixed
from fleetmart.llm.shared import written
from fleetmart.llm.taskfiles import batch_of, each_piece, fresh_folder, from_steps, groups_of, load, nulls, pack, packed, save, steps_of, tasks_for, unpack
from fleetmart.llm.wordstream import WordStream, byte_classes, numbered, rows_of
from fleetmart.sinks.writers import remove

#: Words in the longest phrase.
LONGEST = 5
#: Words of a shard.
SHARD_WORDS = 3_000_000
#: Distinct words of a bucket, and words of all texts for each bucket of phrases, before they are added up.
BUCKET_WORDS, BUCKET_TOKENS = 2_000_000, 3_000_000
#: Parts of a language whose best phrases are chosen apart first.
SALTS = 64
#: What parts words, and what parts pieces.
_SPACES, _BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"


def _shards(docs: DataFrame, folder: str, shard_words: int) -> DataFrame:
    """``shard, lang, file, n, words``: a file per shard with its tokens (numbers of words from 1, 0 for a
    break), its distinct words and their counts."""
    schema = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("file", pa.string()), ("n", pa.int64()), ("words", pa.int64())])
    classes = byte_classes(_SPACES, _BREAKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, turn = TaskContext.get().partitionId(), 0
        streams: dict[str, WordStream] = {}
        held: dict[str, list[tuple[pa.Array, np.ndarray]]] = {}
        sizes: dict[str, int] = {}

        def shard(lang: str, words: list[pa.Array], breaks: np.ndarray) -> pa.RecordBatch:
            nonlocal turn
            ids, data, ends = numbered(words)
            counts = np.bincount(ids, minlength=len(ends) - 1)
            order = np.argsort(-counts, kind="stable")  # small numbers pack better
            rank = np.empty(len(order), dtype=np.int32)
            rank[order] = np.arange(1, len(order) + 1, dtype=np.int32)
            data, ends = buffers(_binary(data, ends).take(pa.array(order)))
            broken = breaks > 0
            tokens = np.zeros(len(ids) + int(broken.sum()) + 1, dtype=np.int32)
            tokens[np.arange(len(ids)) + np.cumsum(broken)] = rank[ids]
            name = save(folder, tokens=packed(tokens), letters=data, ends=ends, counts=counts[order])
            number, turn = (part << 32) + turn, turn + 1
            return pa.RecordBatch.from_pylist([{"shard": number, "lang": lang, "file": name, "n": len(ids), "words": len(counts)}], schema)

        def take(lang: str, chunks, last: bool = False) -> Iterator[pa.RecordBatch]:
            own = held.setdefault(lang, [])
            for words, breaks in chunks:
                own.append((words, breaks))
                sizes[lang] = sizes.get(lang, 0) + len(words)
                if sizes[lang] >= shard_words and (breaks > 0).any():
                    cut = int(np.flatnonzero(breaks > 0)[-1])  # the last piece may go on
                    own[-1] = (words[:cut], breaks[:cut])
                    rest = (words[cut:], breaks[cut:])
                    if sizes[lang] > len(rest[0]):
                        yield shard(lang, [w for w, _ in own], np.concatenate([b for _, b in own]))
                        held[lang] = own = [rest]
                    else:
                        own[-1] = (words, breaks)
                    sizes[lang] = sum(len(w) for w, _ in own)
            if last and sizes.get(lang):
                yield shard(lang, [w for w, _ in own], np.concatenate([b for _, b in own]))

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), rows_of(batch.column("text")), strict=True):
                if lang not in streams:
                    streams[lang] = WordStream(classes)
                yield from take(lang, streams[lang].feed(text))
        for lang, stream in streams.items():
            yield from take(lang, stream.close(), last=True)

    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "shard long, lang string, file string, n long, words long")


#: Rows to shards (``place`` their bucket; ``at``, ``size``, ``gids`` packed) and, with ``shard`` -1, frequent phrases.
_ANSWERS = "shard long, place long, at binary, size binary, gids binary, gid long, front long, back long, a long, lang string, word string"


def _answer(shard: int, place: int, at: np.ndarray, size: np.ndarray, gids: np.ndarray) -> pa.RecordBatch:
    none, text = nulls(1, pa.int64()), nulls(1, pa.string())
    return batch_of(shard=[shard], place=[place], at=[pack(at)], size=[pack(size)], gids=[pack(gids)], gid=none, front=none, back=none, a=none, lang=text, word=text)


def _phrases(gid: np.ndarray, a: np.ndarray, *, front=None, back=None, lang: str | None = None, words: pa.Array | None = None) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(gid), 50_000):
        part = slice(at, at + 50_000)
        n = len(gid[part])
        blob = nulls(n, pa.binary())
        numbers = [nulls(n, pa.int64()) if x is None else pa.array(x[part], pa.int64()) for x in (front, back)]
        yield batch_of(
            shard=pa.array(np.full(n, -1)), place=pa.array(np.full(n, -1)), at=blob, size=blob, gids=blob, gid=gid[part], front=numbers[0], back=numbers[1], a=a[part],
            lang=pa.array([lang] * n, pa.string()), word=nulls(n, pa.string()) if words is None else words[part].cast(pa.binary()).cast(pa.string()),
        )


def _binary(letters: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(np.ascontiguousarray(ends)), pa.py_buffer(np.ascontiguousarray(letters))])


def _bucket_of(letters: np.ndarray, ends: np.ndarray, buckets: int) -> np.ndarray:
    return (Stretches(letters).hashes(ends[:-1], ends[1:]) % np.uint64(buckets)).astype(np.int64)


def _words(shards: DataFrame, folder: str, tasks: int, buckets: int, least: int) -> DataFrame:
    """The frequent words of each language, and of each shard which of its words they are (``at``)."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, lang, file in zip(*(batch.column(c).to_pylist() for c in ("shard", "lang", "file")), strict=True):
                letters, ends, counts = load(folder, file, "letters", "ends", "counts")
                words = _binary(letters, ends)
                for bucket, own in groups_of(_bucket_of(letters, ends, buckets), buckets):
                    data, places = buffers(words.take(pa.array(own)))
                    yield batch_of(bucket=[bucket], shard=[shard], lang=[lang], at=[pack(own)], letters=[zstandard.compress(data.tobytes(), 3)], lengths=[pack(np.diff(places))], counts=[pack(counts[own])])

    def merge(piece: pa.Table) -> Iterator[pa.RecordBatch]:
        bucket, rank = piece.column("bucket")[0].as_py(), 0
        langs = piece.column("lang").to_pylist()
        for lang in dict.fromkeys(langs):
            rows = [r for r, own in zip(range(piece.num_rows), langs, strict=True) if own == lang]
            part = piece.take(rows)
            counts = [unpack(c) for c in part.column("counts").to_pylist()]
            ends = np.concatenate([[0], np.cumsum(np.concatenate([unpack(x) for x in part.column("lengths").to_pylist()]))])
            letters = np.frombuffer(b"".join(zstandard.decompress(x) for x in part.column("letters").to_pylist()), dtype=np.uint8)
            number, data, places = numbered([_binary(letters, ends)])
            total = np.zeros(len(places) - 1, dtype=np.int64)
            np.add.at(total, number, np.concatenate(counts))
            frequent = np.flatnonzero(total >= least)
            gid = np.zeros(len(total), dtype=np.int64)
            gid[frequent] = (rank + np.arange(len(frequent))) * buckets + bucket + 1
            rank += len(frequent)
            yield from _phrases(gid[frequent], total[frequent], lang=lang, words=_binary(data, places).take(pa.array(frequent)))
            start = 0
            for shard, at, own in zip(part.column("shard").to_pylist(), part.column("at").to_pylist(), counts, strict=True):
                mine = gid[number[start : start + len(own)]]
                start += len(own)
                yield _answer(shard, bucket, unpack(at)[mine > 0], own[mine > 0], mine[mine > 0])

    asked = shards.repartition(tasks, "shard").mapInArrow(ask, "bucket long, shard long, lang string, at binary, letters binary, lengths binary, counts binary")
    return each_piece(asked, "bucket", "shard", tasks_for(4 * buckets), merge, _ANSWERS)


def transformed(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the suffixes of ``tokens`` sorted by their first ``LONGEST`` tokens the token before each,
    and the first row of each token. ``tokens`` begins with 0."""
    ids = tokens.astype(np.int64)
    n, top = len(ids), int(ids.max(initial=0)) + 1

    def later(ranks: np.ndarray, by: int) -> np.ndarray:
        return np.concatenate([ranks[by:], np.zeros(min(by, n), dtype=np.int64)])

    ranks, length = ids, 1
    while 2 * length <= LONGEST:
        ranks = np.unique(ranks * (int(ranks.max()) + 1) + later(ranks, length), return_inverse=True)[1]
        length *= 2
    order = np.argsort(ranks * top + later(ids, length) if length < LONGEST else ranks, kind="stable")
    return tokens[order - 1], np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=top))])


def last_to_first(before: np.ndarray) -> np.ndarray:
    """For each row the row of the suffix that begins one token earlier. Among suffixes that agree in
    their first ``LONGEST`` tokens the order is open, which no interval depends on."""
    target = np.empty(len(before), dtype=np.int32)
    target[np.argsort(before, kind="stable")] = np.arange(len(before), dtype=np.int32)
    return target


def extend(target: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """All phrases one word longer than those of the intervals (``lo``, ``n``), whose two parts are
    among them: first row, size, interval of all but the last word, of all but the first."""
    owner = np.repeat(np.arange(len(lo)), n)
    rows = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    cover = np.full(len(target), -1, dtype=np.int32)
    cover[rows] = owner
    rows = target[rows]
    front = cover[rows]
    rows, front, owner = rows[front >= 0], front[front >= 0], owner[front >= 0]
    if not len(rows):
        return (np.empty(0, dtype=np.int64),) * 4
    key = owner * len(lo) + front
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(first, len(key)))
    return np.minimum.reduceat(rows[order], first).astype(np.int64), size, key[first] % len(lo), key[first] // len(lo)


def _told(piece: pa.Table) -> tuple[int, str, list[np.ndarray]]:
    """Number and file of a shard, and what the buckets answered."""
    rows = piece.slice(1)
    got = [np.concatenate([unpack(x) for x in rows.column(c).to_pylist()] or [np.empty(0, dtype=np.int64)]) for c in ("at", "size", "gids")]
    return piece.column("shard")[0].as_py(), piece.column("file")[0].as_py(), got


def _to_shards(files: DataFrame, answers: DataFrame) -> DataFrame:
    """The rows of each shard: its file first, then answers."""
    blank = [F.lit(None).cast("binary").alias(c) for c in ("at", "size", "gids")]
    heads = files.select("shard", F.lit(-1).cast("long").alias("place"), "file", *blank)
    told = answers.filter("shard >= 0").select("shard", "place", F.lit(None).cast("string").alias("file"), "at", "size", "gids")
    return heads.unionByName(told)


def _indexed(shards: DataFrame, words: DataFrame, tokens_in: str, folder: str, tasks: int) -> DataFrame:
    """``shard, file``: a file per shard with its index and the intervals of its frequent words."""

    def index(piece: pa.Table) -> Iterator[pa.RecordBatch]:
        shard, file, (at, _, gids) = _told(piece)
        tokens, counts = load(tokens_in, file, "tokens", "counts")
        order = np.argsort(gids)  # so that rows are in the order of phrases' numbers
        at, gids = at[order], gids[order]
        kept = np.zeros(len(counts) + 1, dtype=np.int32)
        kept[at + 1] = np.arange(1, len(at) + 1)
        tokens = kept[unpack(tokens, np.int32)]
        tokens = np.concatenate([np.zeros(1, dtype=np.int32), tokens])
        tokens = tokens[(tokens != 0) | np.concatenate([[True], tokens[:-1] != 0])]
        before, first = transformed(tokens)
        ends = np.zeros(len(at) + 2, dtype=np.int64)
        ends[: len(first)] = first
        ends[len(first) :] = first[-1]
        name = save(folder, before=packed(before), lo=ends[1:-1], n=np.diff(ends)[1:], gid=gids)
        yield batch_of(shard=[shard], file=[name])

    return each_piece(_to_shards(shards, words), "shard", "place", tasks, index, "shard long, file string")


_FOUND = "bucket long, shard long, front binary, back binary, n binary, at binary"


def _found(shard: int, target: np.ndarray, lo: np.ndarray, n: np.ndarray, gid: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """The phrases one word longer, to their buckets."""
    first, size, front, back = extend(target, lo, n)
    front, back = gid[front], gid[back]
    order = np.lexsort((back, front))
    first, size, front, back = first[order], size[order], front[order], back[order]
    spread = mixed(front.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + back.astype(np.uint64))
    for bucket, own in groups_of((spread % np.uint64(buckets)).astype(np.int64), buckets):
        df, db = steps_of(front[own], back[own])
        yield batch_of(bucket=[bucket], shard=[shard], front=[pack(df)], back=[pack(db)], n=[pack(size[own])], at=[pack(np.diff(first[own], prepend=0))])


def _pairs(indexes: DataFrame, folder: str, tasks: int, buckets: int) -> DataFrame:
    """Phrases of two frequent words in each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, file in zip(batch.column("shard").to_pylist(), batch.column("file").to_pylist(), strict=True):
                before, *words = load(folder, file, "before", "lo", "n", "gid")
                yield from _found(shard, last_to_first(unpack(before, np.int32)), *words, buckets)

    return indexes.repartition(tasks, "shard").mapInArrow(run, _FOUND)


def _longer(indexes: DataFrame, answers: DataFrame, folder: str, tasks: int, buckets: int) -> DataFrame:
    """Phrases one word longer than the frequent ones of each shard."""

    def run(piece: pa.Table) -> Iterator[pa.RecordBatch]:
        shard, file, (lo, n, gid) = _told(piece)
        if len(lo):
            (before,) = load(folder, file, "before")
            yield from _found(shard, last_to_first(unpack(before, np.int32)), lo, n, gid, buckets)

    return each_piece(_to_shards(indexes, answers), "shard", "place", tasks, run, _FOUND)


def _frequent(found: DataFrame, buckets: int, least: int) -> DataFrame:
    """The phrases that are frequent over all shards, and for each shard its own of them."""

    def merge(piece: pa.Table) -> Iterator[pa.RecordBatch]:
        bucket = piece.column("bucket")[0].as_py()
        asked = [from_steps(unpack(f), unpack(b)) for f, b in zip(piece.column("front").to_pylist(), piece.column("back").to_pylist(), strict=True)]
        front, back = (np.concatenate(x) for x in zip(*asked, strict=True))
        sizes = [unpack(x) for x in piece.column("n").to_pylist()]
        order = np.lexsort((back, front))
        front, back = front[order], back[order]
        new = np.concatenate([[True], (front[1:] != front[:-1]) | (back[1:] != back[:-1])])
        start = np.flatnonzero(new)
        total = np.add.reduceat(np.concatenate(sizes)[order], start)
        frequent = total >= least
        gid = np.where(frequent, np.cumsum(frequent) * buckets + bucket, 0)
        yield from _phrases(gid[frequent], total[frequent], front=front[start][frequent], back=back[start][frequent])
        of = np.empty(len(order), dtype=np.int64)
        of[order] = gid[np.cumsum(new) - 1]
        done = 0
        for shard, at, own in zip(piece.column("shard").to_pylist(), piece.column("at").to_pylist(), sizes, strict=True):
            mine = of[done : done + len(own)]
            done += len(own)
            if mine.any():
                yield _answer(shard, bucket, np.cumsum(unpack(at))[mine > 0], own[mine > 0], mine[mine > 0])

    return each_piece(found, "bucket", "shard", tasks_for(4 * buckets), merge, _ANSWERS)


def phrases(
    docs: DataFrame, *, least: int = 100, shard_words: int = SHARD_WORDS, bucket_words: int = BUCKET_WORDS, bucket_tokens: int = BUCKET_TOKENS
) -> tuple[DataFrame, list[DataFrame]]:
    """Words of each language (``lang, n``), and the frequent phrases of 1, 2, ... words: number
    ``gid``, ``lang``, ``words``, frequency ``a``, frequencies of the first 1, 2, ... words
    (``fronts``) and of the last (``backs``), and the numbers ``front``, ``back`` of the phrases without
    their last and first word."""
    spark = docs.sparkSession
    tokens, folder = fresh_folder(spark, "tokens"), fresh_folder(spark, "phrases")
    shards = written(_shards(docs, tokens, shard_words), "shards")
    size = shards.agg(F.count(F.lit(1)).alias("shards"), F.sum("n").alias("n"), F.sum("words").alias("words")).first()
    tasks, buckets = tasks_for(size["shards"]), max(1, -(-(size["n"] or 0) // bucket_tokens))
    level = written(_words(shards, tokens, tasks, max(1, -(-(size["words"] or 0) // bucket_words)), least), "words")
    known = level.filter("shard < 0").select("gid", "lang", F.array("word").alias("words"), "a", F.array("a").alias("fronts"), F.array("a").alias("backs"), "front", "back")
    found = [known]
    indexes = written(_indexed(shards, level, tokens, folder, tasks_for(3 * tasks)), "indexes")
    remove(spark, tokens)
    for length in range(2, LONGEST + 1):
        rows = _pairs(indexes, folder, tasks, buckets) if length == 2 else _longer(indexes, level, folder, tasks_for(3 * tasks), buckets)
        level = written(_frequent(rows, buckets, least), "level")
        front, back = (known.select(F.col("gid").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("lang", "words", "fronts", "backs")]) for side in ("front", "back"))
        grown = level.filter("shard < 0").select("gid", "front", "back", "a").join(front, "front").join(back, "back")
        known = written(
            grown.select("gid", F.col("front_lang").alias("lang"), F.concat("front_words", F.slice("back_words", -1, 1)).alias("words"), "a",
                         F.concat("front_fronts", F.array("a")).alias("fronts"), F.concat("back_backs", F.array("a")).alias("backs"), "front", "back"),
            "grams",
        )
        found.append(known)
    return shards.groupBy("lang").agg(F.sum("n").alias("n")), found


#: The lowest-scoring cut of a phrase, in exact arithmetic.
_CUT = """array_min(transform(sequence(1, size(words) - 1), k -> struct(
    cast((cast(1000 as decimal(4,0)) * cast(cast(a as decimal(15,0)) * cast(n as decimal(19,0)) as decimal(34,0)))
        div (cast(fronts[k - 1] as decimal(18,0)) * cast(backs[size(words) - k - 1] as decimal(18,0))) as bigint) as score,
    k as k, fronts[k - 1] as l, backs[size(words) - k - 1] as r)))"""


def collocations(docs: DataFrame, *, least: int = 100, most: int = 2000, **sizes: int) -> DataFrame:
    """The ``most`` highest-scoring phrases of each language, without those that lie in a longer one
    just as frequent: ``lang, rank, phrase, a, l, r, n, score`` and ``cut``, the words before the
    lowest-scoring cut. ``sizes`` are those of :func:`phrases`."""
    totals, found = phrases(docs, least=least, **sizes)
    kept = []
    for shorter, longer in zip(found[1:], [*found[2:], None], strict=True):
        if longer is not None:
            # a phrase inside a longer one lies in one a word longer that is at least as frequent
            around = longer.select(F.col("front").alias("gid"), "a").unionByName(longer.select(F.col("back").alias("gid"), "a"))
            around = around.groupBy("gid").agg(F.max("a").alias("around"))
            shorter = shorter.join(around, "gid", "left").filter("around is null or around < a")
        kept.append(shorter.select("gid", "lang", "words", "a", "fronts", "backs"))
    rows = kept[0]
    for more in kept[1:]:
        rows = rows.unionByName(more)
    scored = rows.join(totals, "lang").withColumn("c", F.expr(_CUT))
    scored = scored.select("lang", F.array_join("words", " ").alias("phrase"), "a", "c.l", "c.r", "n", "c.score", F.col("c.k").alias("cut"), F.pmod(F.xxhash64("gid"), F.lit(SALTS)).alias("salt"))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).filter(F.col("rank") <= most)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).filter(F.col("rank") <= most)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut")
