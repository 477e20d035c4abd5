"""Scores of texts by a hierarchical Pitman-Yor model over words.

Every word of the training texts is a context with a restaurant of its own; the restaurants share
one parent, the restaurant of all words, above which all words are equally likely, one more
standing for any unknown word. Customers are the tokens after the context's word, dishes are words,
and each table of a restaurant is a customer of the parent. Seating is sampled by Gibbs sweeps: the
customers of each dish in each restaurant leave one after the other and sit down again, given all
tables of the dish, the other tables of the restaurant and the parent's probabilities as the sweep before left them
(so all dishes are drawn at once, in parallel); then the parent's customers, of whom some have gone or
come, do the same. More than ``FEW`` customers of a dish leave in random blocks that hold every one of them once;
a block sits down in sequence, by the ratio of Metropolis and Hastings, so that the seating has the same distribution
as if they went one by one. The first seating is drawn in sequence. Predictive probabilities are averaged over the sweeps after
``burn_in``; discounts are estimated from the numbers of dishes with one and two customers, strengths are
parameters.

At scale, documents lie in shards, words in homes, and dishes of restaurants (cells) in buckets;
each is a file of its own, and only packed arrays travel: the distinct words of a shard to their
homes and their numbers back, the distinct (context, word) pairs of a shard to their buckets and their
probabilities back, and in each sweep sums of tables by context and word. Pairs are dealt out by
context, and those of a frequent context over several buckets by word too, so no restaurant lies in one
task; of a frequent pair each shard sends one row. Seating a dish takes time with its tables and the
logarithm of its customers, in each block. What is gathered grows with the training texts; nothing is cut off.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end; the context of the first
is an end. Null text: empty, one token. Null ``doc_id``: a training text. Equal ids: each row is a
document. Ties and repeated rows need no rule. An empty table gives an empty result. Without training
texts every word is unknown and all scores are 0. Further columns are left out. A document longer than a
shard goes over several, its scores are added up. The draws depend on the numbers of words, which
depend on the number of shards: scores of differently split tables differ by sampling noise.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.hashing import Stretches, buffers, mixed
from fleetmart.llm.shared import written
from fleetmart.llm.taskfiles import batch_of, each_piece, fresh_folder, from_steps, groups_of, load, pack, packed, save, steps_of, tasks_for, unpack
from fleetmart.llm.wordstream import WordStream, byte_classes, numbered, rows_of

#: Tokens of a shard; distinct words of a home and tokens of a bucket before they are merged.
SHARD_TOKENS, HOME_WORDS, BUCKET_TOKENS = 2_000_000, 1_000_000, 3_000_000
#: Occurrences of a context's word for which its pairs take another bucket.
SPLIT = 500_000
#: Discount where the counts do not tell one.
DISCOUNT = 0.75
#: Customers of one dish in one restaurant who move one by one; more move in blocks.
FEW = 8
_SPACES = b" \t\n\x0b\x0c\r"
#: The end of a text among the words: a byte that no word holds.
_END = b" "
_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


class _Draws:
    """Uniform numbers above 0 and below 1 for rows, each from the seed of its row."""

    def __init__(self, seed: np.ndarray):
        self.state = seed.copy()

    def of(self, rows) -> np.ndarray:
        self.state[rows] += _GOLD
        return (mixed(self.state[rows]) >> _U(11)).astype(np.float64) * 2.0**-53 + 2.0**-54


def _openings(c: np.ndarray, base: np.ndarray, slope: np.ndarray, d: float, draws: _Draws, seated: np.ndarray, t: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Dishes whose next customer to open a table has been found, and how many sit before that one: see :func:`opened`.
    Those of a dish come in their order."""
    t = t.copy()
    at = np.flatnonzero(c > seated)
    j, n = seated[at], c[at]
    while len(at):
        tables = t[at]
        weight, less = base[at] + slope[at] * tables, d * tables
        bound = weight / (weight + j - less)
        with np.errstate(divide="ignore"):
            steps = np.floor(np.log(draws.of(at)) / np.log1p(-bound))
        window = np.minimum(2 * j, n)
        landed = j + np.minimum(steps, 2e18).astype(np.int64)
        inside = landed < window
        opens = inside & (draws.of(at) * bound <= weight / (weight + landed - less))
        t[at[opens]] += 1
        yield at[opens], landed[opens]
        j = np.where(inside, landed + 1, window)
        on = j < n
        at, j, n = at[on], j[on], n[on]


def opened(c: np.ndarray, base: np.ndarray, slope: np.ndarray, d: float, draws: _Draws, seated: np.ndarray | None = None, t: np.ndarray | None = None) -> np.ndarray:
    """Tables of ``c`` customers of one dish when seated in sequence: with ``t`` tables and ``j``
    seated, the next opens one with weight ``base + slope * t`` against ``j - d * t``. The first
    ``seated`` sit at ``t`` tables already.

    Customers who sit down at open tables are skipped: between ``j`` and ``2j`` the chance of a table is
    at most that at ``j``, so candidates come in geometric steps and are accepted by the ratio."""
    one = (c > 0).astype(np.int64)
    seated, t = (one, one) if seated is None else (np.maximum(seated, one), np.maximum(t, one))
    t = t.copy()
    for at, _ in _openings(c, base, slope, d, draws, seated, t):
        t[at] += 1
    return t


def shared_out(c: np.ndarray, t: np.ndarray, d: float, draws: _Draws) -> np.ndarray:
    """Sizes of the ``t`` tables of each dish, first table first, for ``c`` customers: a start for
    :func:`moved`, drawn from the front to the back by beta-like shares."""
    sizes = np.ones(int(t.sum()), dtype=np.int64)
    first = np.cumsum(t) - t
    left, k = c - t, np.zeros(len(c), dtype=np.int64)
    at = np.flatnonzero(t > 0)
    while len(at):
        last = k[at] == t[at] - 1
        share = draws.of(at) ** ((1 - d) * (t[at] - k[at] - 1) + 1e-9)  # the later tables' part
        own = np.where(last, left[at], left[at] - np.floor(left[at] * share).astype(np.int64))
        sizes[first[at] + k[at]] += own
        left[at] -= own
        k[at] += 1
        at = at[~last]
    return sizes


def resized(sizes: np.ndarray, c: np.ndarray, t: np.ndarray, to: np.ndarray, base: np.ndarray, slope: np.ndarray, d: float, draws: _Draws) -> tuple[np.ndarray, np.ndarray]:
    """Tables after customers have left or come, so that ``to`` remain: those who leave are chosen at
    random, those who come open tables in sequence or join the table of a random one."""
    leaving = np.flatnonzero(to < c)
    first = np.cumsum(t) - t
    if len(leaving):
        table = _ranges(first[leaving], t[leaving])
        customer = np.repeat(table, sizes[table])
        of = np.repeat(np.arange(len(leaving)), c[leaving])
        start = np.cumsum(c[leaving]) - c[leaving]
        order = np.argsort(of + mixed(draws.state[leaving[of]] + np.arange(len(of)).astype(_U) * _GOLD).astype(np.float64) * 2.0**-65)
        gone = customer[order[_ranges(start, (c - to)[leaving])]]
        sizes = sizes - np.bincount(gone, minlength=len(sizes))
        t = np.add.reduceat(np.append(sizes > 0, False).astype(np.int64), first) * (t > 0) if len(t) else t
        sizes = sizes[sizes > 0]
    now = np.minimum(c, to)
    more = opened(to, base, slope, d, draws, now, t)
    new = more - t
    coming = np.flatnonzero((to > now) & (now > 0))
    join = (to - now - new)[coming]
    at = np.repeat(coming, join)
    before = np.concatenate([[0], np.cumsum(sizes)])
    whole = np.cumsum(now) - now
    draw = mixed(draws.state[at] + np.arange(len(at)).astype(_U) * _GOLD) >> _U(11)
    who = whole[at] + (draw.astype(np.float64) * 2.0**-53 * now[at]).astype(np.int64)
    sizes = sizes + np.bincount(np.searchsorted(before, who, side="right") - 1, minlength=len(sizes))
    fresh = (to > 0) & (now == 0)
    if fresh.any():
        sizes = np.insert(sizes, np.repeat((np.cumsum(t))[fresh], more[fresh]), shared_out(to[fresh], more[fresh], d, _Draws(draws.state[fresh])))
        t = np.where(fresh, more, t)
        new = more - t
    sizes = np.insert(sizes, np.repeat(np.cumsum(t), new), 1)
    return sizes, more


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All numbers of the ranges of ``n`` numbers from ``start`` on."""
    return np.arange(int(n.sum())) + np.repeat(start - np.cumsum(n) + n, n)


def _one_by_one(sizes: np.ndarray, c: np.ndarray, t: np.ndarray, base: np.ndarray, slope: np.ndarray, d: float, draws: _Draws) -> tuple[np.ndarray, np.ndarray]:
    """:func:`moved` for at most ``FEW`` customers of each dish: as many moves as customers, each of a random one."""
    t = t.copy()
    for step in range(FEW):
        at = np.flatnonzero(c > max(step, 1))
        if not len(at):
            break
        first = np.cumsum(t) - t
        before = np.concatenate([[0], np.cumsum(sizes)])
        many = t[at] > 1

        def table_of(rows: np.ndarray, customer: np.ndarray) -> np.ndarray:
            found = first[rows]
            some = t[rows] > 1
            found[some] = np.searchsorted(before, before[found[some]] + customer[some], side="right") - 1
            return found

        who = (draws.of(at) * c[at]).astype(np.int64)
        old = table_of(at, who)
        sizes[old] -= 1
        empty = sizes[old] == 0
        others = t[at] - empty
        weight = base[at] + slope[at] * others
        new = draws.of(at) * (weight + c[at] - 1 - d * others) < weight
        ask = np.flatnonzero(~new & many)
        goal = old.copy()
        while len(ask):
            rows = at[ask]
            other = (draws.of(rows) * (c[rows] - 1)).astype(np.int64)
            other += other >= who[ask]
            table = table_of(rows, other)
            sits = draws.of(rows) * sizes[table] < sizes[table] - d
            goal[ask[sits]] = table[sits]
            ask = ask[~sits]
        sizes[goal[~new]] += 1
        sizes[old[new & empty]] = 1
        gone, come = old[empty & ~new], at[new & ~empty]
        if len(gone) or len(come):
            ends = (first + t)[come]
            keep = np.ones(len(sizes), dtype=bool)
            keep[gone] = False
            shift = np.concatenate([[0], np.cumsum(keep)])
            sizes = np.insert(sizes[keep], shift[ends], 1)
            t[at[empty & ~new]] -= 1
            t[come] += 1
    return sizes, t


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """For positive numbers, by Stirling's series."""
    x = x.copy()
    low = np.flatnonzero(x < 8)
    steps = np.zeros(len(low))
    for _ in range(8):
        steps += np.log(x[low])
        x[low] += 1
    z = 1 / (x * x)
    whole = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / x
    whole[low] -= steps
    return whole


def _path_weights(of: np.ndarray, j: np.ndarray, seated: np.ndarray, c: np.ndarray, t: np.ndarray, base: np.ndarray, slope: np.ndarray, d: float) -> np.ndarray:
    """The logarithms of all weights, of new and open tables, that customers ``seated`` to ``c`` of each dish meet, multiplied,
    where those of dish ``of`` with ``j`` before them open tables and ``t`` are open before. Sorted by both."""
    e = np.bincount(of, minlength=len(c))
    cell = np.repeat(np.arange(len(c)), e + 1)
    first = np.cumsum(e + 1) - e - 1
    begin, end = np.empty(len(cell), dtype=np.int64), np.empty(len(cell), dtype=np.int64)
    begin[first], end[first + e] = seated, c
    own = np.arange(len(of)) + of  # each opening ends one stretch of equal numbers of tables and begins the next
    end[own], begin[own + 1] = j + 1, j + 1
    tables = t[cell] + np.arange(len(cell)) - first[cell]
    less = base[cell] - (d - slope[cell]) * tables
    some = np.flatnonzero(end > begin)
    parts = np.zeros(len(cell))
    parts[some] = _log_gamma(less[some] + end[some]) - _log_gamma(less[some] + begin[some])
    return np.bincount(cell, weights=parts, minlength=len(c))


def _first_places(of: np.ndarray, sizes: np.ndarray, m: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Places of the first customers of tables of ``sizes`` in dishes ``of`` (ascending) in a random order of ``m`` customers of each
    dish, sorted by dish and place. Customers come at times of their own, distributed exponentially."""
    time = rng.exponential(size=len(of)) / sizes
    order = np.lexsort((time, of))
    time, sizes = time[order], sizes[order]
    e = np.bincount(of, minlength=len(m))
    first = np.cumsum(e) - e
    pool = m - np.bincount(of, weights=sizes, minlength=len(m)).astype(np.int64)  # may come at any time from now on
    now, place = np.zeros(len(m)), np.zeros(len(m), dtype=np.int64)
    found = np.empty(len(of), dtype=np.int64)
    at = np.flatnonzero(e)
    turn = 0
    while len(at):
        own = first[at] + turn
        come = rng.binomial(pool[at], -np.expm1(now[at] - time[own]))
        found[own] = place[at] + come
        place[at] += come + 1
        pool[at] += sizes[own] - 1 - come
        now[at] = time[own]
        turn += 1
        at = at[e[at] > turn]
    return found


def _joined(sizes: np.ndarray, t: np.ndarray, n: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Sizes after ``n`` customers have sat down in sequence at the ``t`` tables of each dish, none opened: halved again and again."""
    before = np.concatenate([[0], np.cumsum(sizes)])
    sizes = sizes.copy()
    some = np.flatnonzero(n)
    start, length, n = (np.cumsum(t) - t)[some], t[some], n[some]
    while len(start):
        one = length == 1
        sizes[start[one]] += n[one]
        start, length, n = start[~one], length[~one], n[~one]
        half = length // 2
        left = before[start + half] - before[start] - d * half
        right = before[start + length] - before[start + half] - d * (length - half)
        go = rng.binomial(n, rng.beta(left, right))
        start, length, n = np.concatenate([start, start + half]), np.concatenate([half, length - half]), np.concatenate([go, n - go])
        start, length, n = start[n > 0], length[n > 0], n[n > 0]
    return sizes


def _in_blocks(sizes: np.ndarray, c: np.ndarray, t: np.ndarray, base: np.ndarray, slope: np.ndarray, d: float, draws: _Draws, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`moved` by random ``blocks`` that hold each customer once. A block leaves and sits down again in a random
    sequence; the seating it had is drawn on the same way, and the new one taken by the ratio of the weights
    that both meet, which makes up for their sequences (so the block keeps its seats now and then)."""
    draws.of(slice(None))
    rng = np.random.default_rng(int(np.bitwise_xor.reduce(mixed(draws.state))))
    waiting = sizes.copy()  # customers whose block has not left yet
    for turn in range(blocks):
        cell = np.repeat(np.arange(len(c)), t)
        gone = rng.binomial(waiting, 1 / (blocks - turn))
        waiting = waiting - gone
        rest = sizes - gone
        m = np.bincount(cell, weights=gone, minlength=len(c)).astype(np.int64)
        seated, left = c - m, np.bincount(cell, weights=rest > 0, minlength=len(c)).astype(np.int64)
        # the seating as it was: who opened the tables that are empty now
        bare = np.flatnonzero(rest == 0)
        of = cell[bare]
        j = seated[of] + _first_places(of, sizes[bare], m, rng)
        had = _path_weights(of, j, seated, c, left, base, slope, d)
        # the new one: the first customer of a dish opens a table in any case
        none = np.flatnonzero(seated == 0)
        found = [(none, np.zeros(len(none), dtype=np.int64)), *_openings(c, base, slope, d, draws, np.maximum(seated, 1), np.maximum(left, 1))]
        of, j = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((j, of))
        of, j = of[order], j[order]
        takes = np.log(rng.random(len(c))) < _path_weights(of, j, seated, c, left, base, slope, d) - had
        takes &= m > 0
        taken = takes[of]
        of, j = of[taken], j[taken]
        e = np.bincount(of, minlength=len(c))
        # a table and those opened before share the customers after it whom later tables have not got
        fresh = np.empty(len(of), dtype=np.int64)
        last, after = np.cumsum(e) - 1, np.zeros(len(c), dtype=np.int64)
        at, k = np.flatnonzero(e), 0
        while len(at):
            own = last[at] - k
            others = j[own] - d * (left[at] + e[at] - 1 - k)
            n = c[at] - j[own] - 1 - after[at]
            share = np.ones(len(at))
            some = np.flatnonzero(j[own] > 0)
            share[some] = rng.beta(1 - d, others[some])
            fresh[own] = 1 + rng.binomial(n, share)
            after[at] += fresh[own]
            k += 1
            at = at[e[at] > k]
        kept = np.where(takes[cell], rest, sizes)
        stays = kept > 0
        kept, waiting = kept[stays], waiting[stays]
        t = np.where(takes, left, t)
        kept = _joined(kept, t, np.where(takes, m - after, 0), d, rng)
        ends = np.cumsum(t)[of]
        sizes, waiting = np.insert(kept, ends, fresh), np.insert(waiting, ends, 0)
        t = t + e
    return sizes, t


def moved(sizes: np.ndarray, c: np.ndarray, t: np.ndarray, base: np.ndarray, slope: np.ndarray, d: float, draws: _Draws) -> tuple[np.ndarray, np.ndarray]:
    """One Gibbs sweep: the customers of each dish leave and sit down again given all others, up to ``FEW`` one after the
    other, more in blocks. ``base + slope * t`` is the weight of a table beside ``t`` others. Sizes and numbers of
    tables after it.

    A block opens more tables, and so meets weights that differ more, the likelier a table is: there are more blocks then.
    What their number is taken from does not change with the seating."""
    blocks = np.where(c > FEW, 2 + np.cbrt(np.minimum(base * np.maximum(c, 1.0) ** slope, c)).astype(np.int64), 0)
    kinds = np.unique(blocks).tolist()
    parts, now = [], t.copy()
    for kind in kinds:
        own = np.flatnonzero(blocks == kind)
        mine = _Draws(draws.state[own])
        state = sizes[np.repeat(blocks == kind, t)], c[own], t[own], base[own], slope[own], d, mine
        part, now[own] = _in_blocks(*state, kind) if kind else _one_by_one(*state)
        parts.append(part)
        draws.state[own] = mine.state
    place = np.repeat(blocks, now)
    sizes = np.empty(int(now.sum()), dtype=np.int64)
    for kind, part in zip(kinds, parts, strict=True):
        sizes[place == kind] = part
    return sizes, now


# ---- shards -------------------------------------------------------------------------------------


def _shards(docs: DataFrame, folder: str, shard_tokens: int) -> DataFrame:
    """``shard, file, tokens, words``: a file per shard. Its tokens begin with the context of the first
    one to be scored."""
    classes = byte_classes(_SPACES, b"")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        stream = WordStream(classes)
        held: list[tuple[pa.Array, np.ndarray]] = []  # words, and the document of each
        ids: list[tuple[int | None, bool]] = []  # of documents from ``first`` on
        first, doc, size, turn, lead = 0, -1, 0, 0, _END

        def shard(docs_here: int, ends: int, words: pa.Array, of: np.ndarray) -> pa.RecordBatch:
            """Documents ``first`` up to ``first + docs_here``, of which ``ends`` end here."""
            nonlocal turn, lead
            number, letters, starts = numbered([words, pa.array([lead, _END], pa.large_binary())])
            leading, end, number = number[-2], number[-1], number[:-2]
            tokens = np.full(len(number) + ends + 1, end, dtype=np.int32)
            tokens[0] = leading
            tokens[1 + np.arange(len(number)) + (of - first)] = number
            lengths = np.bincount(of - first, minlength=docs_here)
            lengths[:ends] += 1
            train = np.repeat([not h for _, h in ids[:docs_here]], lengths)
            counts = np.bincount(tokens[1:][train], minlength=len(starts) - 1)
            order = np.argsort(-np.bincount(tokens, minlength=len(counts)), kind="stable")  # small numbers pack better
            rank = np.empty(len(order), dtype=np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            sorted_words = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(starts), pa.py_buffer(letters)]).take(pa.array(order))
            letters, starts = buffers(sorted_words)
            lead = words[-1].as_py() if len(words) and ends < docs_here else _END
            name = save(
                folder, tokens=packed(rank[tokens]), letters=letters, starts=starts, counts=counts[order], lengths=lengths,
                doc=np.array([i or 0 for i, _ in ids[:docs_here]], dtype=np.int64), known=np.array([i is not None for i, _ in ids[:docs_here]], dtype=np.uint8),
                held=np.array([h for _, h in ids[:docs_here]], dtype=np.uint8), row=(part << 36) + first + np.arange(docs_here),
            )
            turn += 1
            return pa.RecordBatch.from_pylist([{"shard": (part << 20) + turn, "file": name, "tokens": len(tokens), "words": len(counts)}])

        def take(chunks) -> Iterator[pa.RecordBatch]:
            nonlocal first, doc, size, held, ids
            for words, breaks in chunks:
                of = doc + np.cumsum(breaks)
                doc = int(of[-1])
                held.append((words, of))
                size += len(words)
                if size < shard_tokens:
                    continue
                whole, of = pa.concat_arrays([w for w, _ in held]), np.concatenate([o for _, o in held])
                if doc > first:  # the last document may go on
                    cut = int(np.searchsorted(of, doc))
                    yield shard(doc - first, doc - first, whole[:cut], of[:cut])
                    ids = ids[doc - first :]
                    held, first = [(whole[cut:], of[cut:])], doc
                else:
                    yield shard(1, 0, whole, of)
                    held = []
                size = sum(len(w) for w, _ in held)

        for batch in batches:
            known, out = batch.column("doc_id").to_pylist(), batch.column("held").to_pylist()
            for i, h, text in zip(known, out, rows_of(batch.column("text")), strict=True):
                ids.append((i, h))
                yield from take(stream.feed(text))
                if len(ids) >= shard_tokens:  # very many empty texts
                    yield from take(stream.close())
                    whole, of = pa.concat_arrays([w for w, _ in held] or [pa.array([], pa.large_binary())]), np.concatenate([o for _, o in held] or [np.empty(0, dtype=np.int64)])
                    yield shard(len(ids), len(ids), whole, of)
                    doc = first = first + len(ids)
                    held, ids, size, stream = [], [], 0, WordStream(classes)
                    doc -= 1
        yield from take(stream.close())
        if ids:
            whole, of = pa.concat_arrays([w for w, _ in held] or [pa.array([], pa.large_binary())]), np.concatenate([o for _, o in held] or [np.empty(0, dtype=np.int64)])
            yield shard(len(ids), len(ids), whole, of)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "shard long, file string, tokens long, words long")


def _homes_of(letters: np.ndarray, starts: np.ndarray, homes: int) -> np.ndarray:
    """The home of each word, by its bytes."""
    return (Stretches(letters).hashes(starts[:-1], starts[1:]) % _U(homes)).astype(np.int64)


def _counted(shards: DataFrame, folder: str, homes: int, tasks: int) -> DataFrame:
    """Words merged in their homes: rows to shards (``shard, place``: their home, ``a`` the numbers of their
    words, ``b`` counts in training texts) and one of each home (``shard`` -1, ``file``, ``n`` tokens, ``v`` words)."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, file in zip(batch.column("shard").to_pylist(), batch.column("file").to_pylist(), strict=True):
                letters, starts, counts = load(folder, file, "letters", "starts", "counts")
                home = _homes_of(letters, starts, homes)
                words = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(starts), pa.py_buffer(letters)])
                for h, own in groups_of(home, homes):
                    data, ends = buffers(words.take(pa.array(own)))
                    yield batch_of(home=[h], shard=[shard], a=[zstandard.compress(data.tobytes(), 3)], b=[pack(np.diff(ends))], c=[pack(counts[own])])

    def merge(piece: pa.Table) -> Iterator[pa.RecordBatch]:
        home = piece.column("home")[0].as_py()
        lengths = [unpack(b) for b in piece.column("b").to_pylist()]
        counts = [unpack(c) for c in piece.column("c").to_pylist()]
        letters = b"".join(zstandard.decompress(a) for a in piece.column("a").to_pylist())
        ends = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
        words = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(letters)])
        del letters
        number, _, distinct = numbered([words])
        total = np.zeros(len(distinct) - 1, dtype=np.int64)
        np.add.at(total, number, np.concatenate(counts))
        order = np.argsort(-total, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        known = int((total > 0).sum())
        gid = np.where(total > 0, rank * homes + home + 1, 0)
        at = 0
        for shard, own in zip(piece.column("shard").to_pylist(), counts, strict=True):
            mine = number[at : at + len(own)]
            at += len(own)
            yield batch_of(shard=[shard], place=[home], a=[pack(gid[mine])], b=[pack(total[mine])], file=pa.array([None], pa.string()), n=[0], v=[0])
        name = save(folder, counts=total[order][:known])
        yield batch_of(shard=[-1], place=[home], a=pa.array([None], pa.binary()), b=pa.array([None], pa.binary()), file=[name], n=[int(total.sum())], v=[known])

    asked = shards.repartition(tasks, "shard").mapInArrow(ask, "home long, shard long, a binary, b binary, c binary")
    return each_piece(asked, "home", "shard", tasks_for(4 * homes), merge, "shard long, place long, a binary, b binary, file string, n long, v long")


class _Pairs:
    """The distinct (context, word) pairs of a shard in the order of their buckets, numbers of both,
    and for each token its pair."""

    def __init__(self, folder: str, piece: pa.Table, homes: int, buckets: int, split: int):
        file, answers = None, []
        for name, place, a, b in zip(*(piece.column(c).to_pylist() for c in ("file", "place", "a", "b")), strict=True):
            if place < 0:
                file = name
            elif place < homes:
                answers.append((place, a, b))
        tokens, letters, starts, self.lengths, self.doc, self.known, self.held, self.row = load(
            folder, file, "tokens", "letters", "starts", "lengths", "doc", "known", "held", "row"
        )
        self.tokens = unpack(tokens, np.int32)
        home = _homes_of(letters, starts, homes)
        gid, self.counts = np.zeros(len(home), dtype=np.int64), np.zeros(len(home), dtype=np.int64)
        for (_, own), (_, a, b) in zip(groups_of(home, homes), answers, strict=True):
            gid[own], self.counts[own] = unpack(a), unpack(b)
        # numbers within the shard in the order of those of all, unknown words alike
        seen, local = np.unique(gid, return_inverse=True)
        if seen[0]:
            seen, local = np.concatenate([[0], seen]), local + 1
        c = np.zeros(len(seen), dtype=np.int64)
        c[local[gid > 0]] = self.counts[gid > 0]
        local = local[self.tokens]
        pairs, of = np.unique(local[:-1] * len(seen) + local[1:], return_inverse=True)
        train = np.repeat(self.held == 0, self.lengths)
        counts = np.bincount(of, weights=train, minlength=len(pairs)).astype(np.int64)
        u, w = pairs // len(seen), pairs % len(seen)
        parts = np.where(u > 0, 1 + c[u] // split, buckets)  # an unknown context has no restaurant
        u, w = seen[u], seen[w]
        part = mixed(w.astype(_U)) % parts.astype(_U)
        bucket = (mixed(u.astype(_U) * _GOLD + part) % _U(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.int64)
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(order), dtype=np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        self.of = rank[of]
        self.bucket, self.u, self.w, self.c = bucket[order], u[order], w[order], counts[order]


def _to_shards(shards: DataFrame, words: DataFrame, *more: DataFrame) -> DataFrame:
    """The rows of each shard: its file first, answers of homes, then ``more``."""
    columns = ["shard", "place", "file", "a", "b"]
    files = shards.select("shard", F.lit(-1).cast("long").alias("place"), "file", *[F.lit(None).cast("binary").alias(c) for c in "ab"])
    return reduce(DataFrame.unionByName, [files, words.filter("shard >= 0").select(columns), *more])


# ---- buckets of cells and homes of words --------------------------------------------------------


def _by_home(gid: np.ndarray, homes: int) -> list[tuple[int, np.ndarray]]:
    """Places of known words by home, in ascending order of both; homes without any among them."""
    home = np.where(gid > 0, (gid - 1) % homes, -1)
    order = np.argsort(home, kind="stable")
    edges = np.searchsorted(home[order], np.arange(homes + 1))
    return [(h, order[edges[h] : edges[h + 1]]) for h in range(homes)]


def _sums(bucket: int, u: np.ndarray, w: np.ndarray, cu: np.ndarray, cw: np.ndarray, t: np.ndarray, homes: int, numbers: bool) -> Iterator[pa.RecordBatch]:
    """Tables by context and by word to the homes, with the numbers of both if asked."""
    by_u = np.bincount(cu, weights=t, minlength=len(u)).astype(np.int64)
    by_w = np.bincount(cw, weights=t, minlength=len(w)).astype(np.int64)
    for (h, pu), (_, pw) in zip(_by_home(u, homes), _by_home(w, homes), strict=True):
        if len(pu) or len(pw):
            ids = [pack(np.diff((x - 1) // homes, prepend=0)) if numbers else None for x in (u[pu], w[pw])]
            yield batch_of(home=[h], bucket=[bucket], u=pa.array([ids[0]], pa.binary()), w=pa.array([ids[1]], pa.binary()), tu=[pack(by_u[pu])], tw=[pack(by_w[pw])],
                        file=pa.array([None], pa.string()), n=[0], once=[0], twice=[0])


_SUMS = "home long, bucket long, u binary, w binary, tu binary, tw binary, file string, n long, once long, twice long"


def _cells(requests: DataFrame, folder: str, homes: int, buckets: int) -> DataFrame:
    """Merged pairs: a file per bucket (``home`` -1) with its cells and which of them each shard asked for,
    and the tables of the first seating, one for each cell."""

    def merge(piece: pa.Table) -> Iterator[pa.RecordBatch]:
        bucket = piece.column("bucket")[0].as_py()
        asked = [(*from_steps(unpack(u), unpack(w)), unpack(c)) for u, w, c in zip(*(piece.column(k).to_pylist() for k in "uwc"), strict=True)]
        u, w, c = (np.concatenate(x) for x in zip(*asked, strict=True))
        width = int(w.max()) + 1
        order = np.argsort(u * width + w) if (int(u.max()) + 1) * width < 1 << 63 else np.lexsort((w, u))
        u, w = u[order], w[order]
        new = np.concatenate([[True], (u[1:] != u[:-1]) | (w[1:] != w[:-1])])
        of = np.empty(len(order), dtype=np.int32)
        of[order] = np.cumsum(new) - 1
        c = np.add.reduceat(c[order], np.flatnonzero(new))
        uu, cu = np.unique(u[new], return_inverse=True)
        ww, cw = np.unique(w[new], return_inverse=True)
        name = save(folder, u=uu, w=ww, cu=packed(cu.astype(np.int32)), cw=packed(cw.astype(np.int32)), c=packed(c), of=packed(of),
                    shard=piece.column("shard").to_numpy(), asked=np.array([len(x[2]) for x in asked], dtype=np.int64))
        none = pa.array([None], pa.binary())
        yield batch_of(home=[-1], bucket=[bucket], u=none, w=none, tu=none, tw=none, file=[name], n=[len(c)], once=[int((c == 1).sum())], twice=[int((c == 2).sum())])
        yield from _sums(bucket, uu, ww, cu, cw, (c > 0).astype(np.int64), homes, True)

    return each_piece(requests, "bucket", "shard", tasks_for(4 * buckets), merge, _SUMS)


def _answers(rows: DataFrame, folder: str, homes: int, round_: int, roots: DataFrame | None, root: dict) -> DataFrame:
    """The parent's restaurant, seated anew: rows to buckets with the tables of contexts (``tu``), their
    customers (``cu``), customers and tables of words in the parent (``nw``, ``tw``), and one of each home
    (``bucket`` -1) with its file and sums. Numbers of words come in the first round and are kept."""

    def seat(piece: pa.Table) -> Iterator[pa.RecordBatch]:
        home = piece.column("home")[0].as_py()
        columns = {c: piece.column(c).to_pylist() for c in ("bucket", "u", "w", "tu", "tw", "file", "index")}
        (counts,) = load(folder, columns["file"][0], "counts")
        index = columns["index"][0]
        places = {}
        if index is not None:
            kept = load(folder, index, "buckets", "nu", "nw", "u", "w", "customers", "t", "sizes")
            ub, wb = np.split(unpack(kept[3]), np.cumsum(kept[1])), np.split(unpack(kept[4]), np.cumsum(kept[2]))
            places = {b: (ub[i], wb[i]) for i, b in enumerate(kept[0].tolist())}
            seated, t, sizes = (unpack(x) for x in kept[5:])
        else:
            seated, t, sizes = np.zeros(len(counts), dtype=np.int64), np.zeros(len(counts), dtype=np.int64), np.empty(0, dtype=np.int64)
        tables, customers, asked = np.zeros(len(counts), dtype=np.int64), np.zeros(len(counts), dtype=np.int64), []
        for i in range(1, piece.num_rows):
            bucket = columns["bucket"][i]
            u, w = places[bucket] if index is not None else (np.cumsum(unpack(columns["u"][i])), np.cumsum(unpack(columns["w"][i])))
            tables[u] += unpack(columns["tu"][i])
            customers[w] += unpack(columns["tw"][i])
            asked.append((bucket, u, w))
        d, theta, flat = root["discount"], root["strength"], root["flat"]
        numbers = (np.arange(len(counts)) * homes + home + 1).astype(_U)
        draws = _Draws(mixed(numbers * _GOLD + _U(round_)))
        slope, before = np.full(len(counts), d * flat), int(t.sum())
        sizes, t = resized(sizes, seated, t, customers, (theta + d * (root["tables"] - t)) * flat, slope, d, draws)
        now = root["tables"] - before + int(t.sum()) if index is not None else root["tables"]
        sizes, t = moved(sizes, customers, t, (theta + d * (now - t)) * flat, slope, d, draws)
        names = dict(buckets=np.array([b for b, _, _ in asked], dtype=np.int64), nu=np.array([len(u) for _, u, _ in asked], dtype=np.int64),
                     nw=np.array([len(w) for _, _, w in asked], dtype=np.int64), customers=packed(customers), t=packed(t), sizes=packed(sizes))
        empty = [np.empty(0, dtype=np.int64)]
        name = save(folder, **names, u=packed(np.concatenate([u for _, u, _ in asked] or empty)), w=packed(np.concatenate([w for _, _, w in asked] or empty)))
        none = pa.array([None], pa.binary())
        yield batch_of(bucket=[-1], home=[home], tu=none, cu=none, nw=none, tw=none, file=[name], customers=[int(customers.sum())], tables=[int(t.sum())],
                    once=[int((customers == 1).sum())], twice=[int((customers == 2).sum())])
        for bucket, u, w in asked:
            yield batch_of(bucket=[bucket], home=[home], tu=[pack(tables[u])], cu=[pack(counts[u])], nw=[pack(customers[w])], tw=[pack(t[w])],
                        file=pa.array([None], pa.string()), customers=[0], tables=[0], once=[0], twice=[0])

    sums = rows.filter("home >= 0").select("home", "bucket", "u", "w", "tu", "tw", F.lit(None).cast("string").alias("file"), F.lit(None).cast("string").alias("index"))
    blank = [F.lit(None).cast("binary").alias(c) for c in ("u", "w", "tu", "tw")]
    files = roots.select("home", F.lit(-1).cast("long").alias("bucket"), *blank, "file", "index")
    schema = "bucket long, home long, tu binary, cu binary, nw binary, tw binary, file string, customers long, tables long, once long, twice long"
    return each_piece(sums.unionByName(files), "home", "bucket", tasks_for(4 * homes), seat, schema)


class _Bucket:
    """The cells of a bucket, and what homes answered about their contexts and words."""

    def __init__(self, folder: str, file: str, homes: int):
        self.u, self.w, cu, cw, c = load(folder, file, "u", "w", "cu", "cw", "c")
        self.cu, self.cw, self.c = unpack(cu, np.int32), unpack(cw, np.int32), unpack(c)
        self.pu = np.concatenate([p for _, p in _by_home(self.u, homes)])
        self.pw = np.concatenate([p for _, p in _by_home(self.w, homes)])

    def told(self, rows: list[dict], root: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tables and customers of contexts, and the parent's probabilities of words."""
        d, rest = root["discount"], (root["strength"] + root["discount"] * root["tables"]) * root["flat"]
        tables, customers = np.zeros(len(self.u)), np.zeros(len(self.u))
        p = np.zeros(len(self.w))
        for values, places, column in ((tables, self.pu, "tu"), (customers, self.pu, "cu")):
            values[places] = np.concatenate([unpack(r[column]) for r in rows] or [np.empty(0)])
        p[self.pw] = np.concatenate([unpack(r["nw"]) - d * unpack(r["tw"]) for r in rows] or [np.empty(0)])
        return tables, customers, (p + rest) / (root["strength"] + root["customers"])

    def tables(self, several: np.ndarray) -> np.ndarray:
        """Tables of all cells, given those of cells with several customers."""
        t = (self.c > 0).astype(np.int64)
        t[self.c > 1] = several
        return t

    def seeds(self, round_: int, cells: np.ndarray) -> np.ndarray:
        turn = mixed(np.array([round_], dtype=_U) * _GOLD)
        return mixed(mixed(self.u.astype(_U) * _GOLD)[self.cu[cells]] + self.w.astype(_U)[self.cw[cells]] + turn)


def _reseated(answers: DataFrame, files: DataFrame, folder: str, homes: int, buckets: int, round_: int, model: dict, root: dict) -> DataFrame:
    """One sweep over all cells: a file of tables per bucket (``home`` -1) and their sums."""

    def sweep(piece: pa.Table) -> Iterator[pa.RecordBatch]:
        head, *rows = piece.to_pylist()
        cells = _Bucket(folder, head["file"], homes)
        several = np.flatnonzero(cells.c > 1)  # a single customer has one table
        c, cu, pw = cells.c[several], cells.cu[several], cells.cw[several]
        t, sizes = (unpack(x) for x in load(folder, head["seats"], "t", "sizes")) if head["seats"] else (np.ones(len(c), dtype=np.int64), None)
        tables, _, p = cells.told(rows, root)
        d, p = model["discount"], p[pw]
        base, draws = (model["strength"] + d * (tables[cu] - t)) * p, _Draws(cells.seeds(round_, several))
        if sizes is None:
            t = opened(c, base, d * p, d, draws)
            sizes = shared_out(c, t, d, draws)
        sizes, t = moved(sizes, c, t, base, d * p, d, draws)
        none = pa.array([None], pa.binary())
        name = save(folder, t=packed(t), sizes=packed(sizes))
        yield batch_of(home=[-1], bucket=[head["bucket"]], u=none, w=none, tu=none, tw=none, file=[name], n=[0], once=[0], twice=[0])
        t = cells.tables(t)
        yield from _sums(head["bucket"], cells.u, cells.w, cells.cu, cells.cw, t, homes, False)

    return each_piece(_with_files(answers, files), "bucket", "home", tasks_for(4 * buckets), sweep, _SUMS)


def _with_files(answers: DataFrame, files: DataFrame) -> DataFrame:
    """The rows of each bucket: its files first, then answers by home."""
    columns = ["bucket", "home", "tu", "cu", "nw", "tw"]
    told = answers.filter("bucket >= 0").select(*columns, *[F.lit(None).cast("string").alias(c) for c in ("file", "seats")])
    heads = files.select("bucket", F.lit(-1).cast("long").alias("home"), *[F.lit(None).cast("binary").alias(c) for c in columns[2:]], "file", "seats")
    return heads.unionByName(told)


def _told(kept: list[tuple[DataFrame, DataFrame]], folder: str, homes: int, buckets: int, model: dict, roots: list[dict]) -> DataFrame:
    """Rows to shards (``shard, place, file, a, b``): ``a`` the logarithms of the pairs they asked for, by the mean
    probability over the kept sweeps."""

    def answer(piece: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = piece.to_pylist()
        cells, p = None, 0
        for s, root in enumerate(roots):
            head, *own = [r for r in rows if r["sweep"] == s]
            cells = cells or _Bucket(folder, head["file"], homes)
            tables, customers, parent = cells.told(own, root)
            t = cells.tables(unpack(load(folder, head["seats"], "t")[0]))
            d, theta = model["discount"], model["strength"]
            p = p + (cells.c - d * t + (theta + d * tables[cells.cu]) * parent[cells.cw]) / (theta + customers[cells.cu])
        logs = np.log10(p / len(roots)).astype(np.float32)
        of, shards, asked = load(folder, head["file"], "of", "shard", "asked")
        at = 0
        of = unpack(of, np.int32)
        for shard, n in zip(shards.tolist(), asked.tolist(), strict=True):
            yield batch_of(shard=[shard], place=[homes + head["bucket"]], file=pa.array([None], pa.string()), a=[pack(logs[of[at : at + n]])], b=pa.array([None], pa.binary()))
            at += n

    rounds = [_with_files(answers, files).withColumn("sweep", F.lit(s)) for s, (answers, files) in enumerate(kept)]
    rows = reduce(DataFrame.unionByName, rounds).withColumn("order", F.col("sweep") * F.lit(homes + 1) + F.col("home"))
    return each_piece(rows, "bucket", "order", tasks_for(4 * buckets), answer, "shard long, place long, file string, a binary, b binary")


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once and twice else DISCOUNT


def scores(
    docs: DataFrame, *, burn_in: int = 1, samples: int = 2, strength: float = 1.0, root_strength: float = 1.0,
    shard_tokens: int = SHARD_TOKENS, home_words: int = HOME_WORDS, bucket_tokens: int = BUCKET_TOKENS, split: int = SPLIT,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity``."""
    spark = docs.sparkSession
    folder = fresh_folder(spark, "pitman-yor")
    shards = written(_shards(docs, folder, shard_tokens), "shards")
    size = shards.agg(F.count(F.lit(1)).alias("shards"), F.sum("tokens").alias("tokens"), F.sum("words").alias("words")).first()
    tasks = tasks_for(size["shards"])
    homes, buckets = max(1, -(-(size["words"] or 0) // home_words)), max(1, -(-(size["tokens"] or 0) // bucket_tokens))
    words = written(_counted(shards, folder, homes, tasks), "words")
    total = words.filter("shard < 0").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n, v = total["n"] or 0, total["v"] or 0

    def ask(piece: pa.Table) -> Iterator[pa.RecordBatch]:
        pairs = _Pairs(folder, piece, homes, buckets, split)
        shard = piece.column("shard")[0].as_py()
        edges = np.searchsorted(pairs.bucket, np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(edges)).tolist():
            own = slice(edges[b], edges[b + 1])
            du, dw = steps_of(pairs.u[own], pairs.w[own])
            yield batch_of(bucket=[b], shard=[shard], u=[pack(du)], w=[pack(dw)], c=[pack(pairs.c[own])])

    requests = each_piece(_to_shards(shards, words), "shard", "place", tasks_for(3 * tasks), ask, "bucket long, shard long, u binary, w binary, c binary")
    sums = written(_cells(requests, folder, homes, buckets), "cells")
    files = sums.filter("home < 0").select("bucket", "file", F.lit(None).cast("string").alias("seats"))
    seen = sums.filter("home < 0").agg(F.sum("once").alias("once"), F.sum("twice").alias("twice")).first()
    model = {"discount": _discount(seen["once"] or 0, seen["twice"] or 0), "strength": strength}
    root = {"discount": DISCOUNT, "strength": root_strength, "flat": 1 / (v + 1), "tables": v}
    roots = words.filter("shard < 0").select(F.col("place").alias("home"), "file", F.lit(None).cast("string").alias("index"))
    kept: list[tuple[DataFrame, DataFrame, dict]] = []
    for sweep in range(burn_in + samples + 1):
        if sweep:
            rows = _reseated(answers, files, folder, homes, buckets, sweep, model, root)
            sums = written(rows, "tables")
            seats = sums.filter("home < 0").select("bucket", F.col("file").alias("seats"))
            files = files.drop("seats").join(seats, "bucket")
        answers = written(_answers(sums, folder, homes, sweep, roots, root), "answers")
        state = answers.filter("bucket < 0")
        roots = roots.drop("index").join(state.select("home", F.col("file").alias("index")), "home")
        got = state.agg(*[F.sum(c).alias(c) for c in ("customers", "tables", "once", "twice")]).first()
        root = root | {"customers": got["customers"] or 0, "tables": got["tables"] or 0}
        if not sweep:
            root["discount"] = _discount(got["once"] or 0, got["twice"] or 0)
        if sweep > burn_in:
            kept.append((answers, files, root))

    def score(piece: pa.Table) -> Iterator[pa.RecordBatch]:
        pairs = _Pairs(folder, piece, homes, buckets, split)
        told = [unpack(a, np.float32) for place, a in zip(piece.column("place").to_pylist(), piece.column("a").to_pylist(), strict=True) if place >= homes]
        logs = np.concatenate(told).astype(np.float64)[pairs.of]
        c = pairs.counts[pairs.tokens[1:]]
        base = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
        of = np.repeat(np.arange(len(pairs.lengths)), pairs.lengths)
        columns = [np.bincount(of, weights=x, minlength=len(pairs.lengths)) for x in (base, logs, c > 0)]
        doc = pa.array(pairs.doc, mask=pairs.known == 0)
        yield batch_of(row=pairs.row, doc_id=doc, held_out=pairs.held.astype(bool), n_tokens=pairs.lengths.astype(np.int64), n_known=columns[2].astype(np.int64), base_score=columns[0], score=columns[1])

    told = _told([(a, f) for a, f, _ in kept], folder, homes, buckets, model, [r for _, _, r in kept])
    rows = each_piece(
        _to_shards(shards, words, told), "shard", "place", tasks_for(3 * tasks), score, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    whole = rows.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"), *[F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base_score", "score")])
    return whole.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity")
    )
