"""Byte-level BPE by recursive DuckDB queries inside each partition.

A text is split by the vocabulary's pattern, and each distinct word is encoded once: its bytes
are rows (word, position, token) that a recursive query joins with the table of merges; every
step contracts each word's leftmost pair of least rank, until no pair of any word has a rank.
Decoding joins the ids of each document with the vocabulary and aggregates the bytes in order.

Words of over ``LONG_BYTES`` bytes are cut into pieces that the query encodes side by side. No merge
crosses the border of two tokens if encoding the bytes of these two alone gives them back; so the
neighbours at each cut are encoded too, and where they come out differently, the tokens around the cut
are encoded anew, ever more of them, until all neighbours hold. The time is in proportion to the word,
but for words whose tokens depend on far away bytes (a period that no token fits). Stretches that have
grown long take a second recursive query that contracts all occurrences of a word's least pair in one
step where no pair with the product ranks lower.

Null text counts as empty and has no ids. Null and repeated ``doc_id`` are carried along, an empty
table gives an empty result, further columns are left out. Decoding fails on ids outside the
vocabulary. A process keeps a bounded number of chunks and words, whatever the input's size.
"""

from __future__ import annotations

import base64
import os
import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.shared import id_and_text, process_cache

LONG_BYTES = 256
#: Bytes of the pieces that longer words are cut into.
PIECE_BYTES = 96
KEPT, KEPT_WORDS = 300_000, 700_000
#: Bytes of text that are encoded at once, at most one document more.
TEXT_AT_ONCE = 6 << 20
#: Runs that one group of the decoding query holds.
RUNS_JOINED = 512
#: Tokens that one query decodes, at most one document more.
DECODED_AT_ONCE = 1 << 20

MERGE_STEPS = """
with recursive step(w, p, t, np, nt, open) as (
  select w, p, t, np, nt, true from tokens
  union all
  (with ranked as (
     select w, p, t, np, nt, m from step left join merges on pair = t::bigint * 1048576 + nt where open),
   best as (
     select w, min(m::bigint * 17592186044416 + p::bigint * 4194304 + np) as k from ranked where m is not null group by w),
   cut as (
     select w, (k >> 22 & 4194303)::int as s, (k & 4194303)::int as q, (k >> 44)::int as m from best),
   contracted as (
     select c.w, s, q, c.m, r.np as np2, r.nt as nt2 from cut c join ranked r on r.w = c.w and r.p = c.q)
   select r.w, r.p, case when r.p = s then c.m else r.t end,
          case when r.p = s then np2 else r.np end,
          case when r.p = s then nt2 when r.np = s then c.m else r.nt end,
          c.w is not null
   from ranked r left join contracted c on c.w = r.w
   where c.w is null or r.p <> q))
select w, t from step where not open order by w, p
"""

LONG_MERGE_STEPS = """
with recursive step(w, p, t, open) as (
  select w, p, t, true from tokens
  union all
  (with paired as (
     select w, p, t, lead(p) over following as np, lead(t) over following as nt
     from step where open window following as (partition by w order by p)),
   ranked as (
     select w, p, np, t, m, safe from paired left join merges on pair = t::bigint * 1048576 + nt),
   least as (
     select w, min(m) as b from ranked group by w),
   hits as (
     select r.w, r.p, r.np, safe, lag(r.np) over (partition by r.w order by r.p) as before
     from ranked r join least l on l.w = r.w and l.b = r.m),
   runs as (
     select *, sum(case when before = p then 0 else 1 end) over (partition by w order by p) as run from hits),
   numbered as (
     select *, row_number() over (partition by w, run order by p) as k from runs),
   chosen as (
     select w, p, np from numbered where k % 2 = 1 and (safe or (run = 1 and k = 1)))
   select r.w, r.p, case when c.p is not null then l.b else r.t end, l.b is not null
   from ranked r join least l on l.w = r.w
   left join chosen c on c.w = r.w and c.p = r.p
   left join chosen d on d.w = r.w and d.np = r.p
   where d.w is null))
select w, t from step where not open order by w, p
"""

#: White space, as Python sees it (fixed values of Unicode).
SPACE = r"[\s\v\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Texts with a space at an end or next to white space.
UNEVEN_SPACE = f"^ | $|{SPACE} | {SPACE}"
_CUT = re.compile(r"(?<=\S) (?=\S)")



class ByteBpe:
    def __init__(self, rank_file: str, pattern: str):
        import duckdb
        import regex

        with open(rank_file, "rb") as lines:
            self.ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        # The pattern's white space is Unicode's, without the separators that Python adds.
        self.split = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        spill = os.path.join(tempfile.gettempdir(), "duckdb")
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": spill})
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self._load()
        self.words: dict[str, int] = {}
        self.word_ids = Runs()
        self._clear()

    def _load(self) -> None:
        rows = [(a, b, m) for word, m in self.ranks.items() for i in range(1, len(word)) if (a := self.ranks.get(word[:i])) is not None and (b := self.ranks.get(word[i:])) is not None]
        left, right, merged = (np.array(c, dtype=np.int64) for c in zip(*rows, strict=True))
        unsafe = np.unique(np.concatenate([left[merged < left], right[merged < right]]))
        table = pa.table({"pair": left * 1048576 + right, "m": merged.astype(np.int32), "safe": ~np.isin(merged, unsafe)})
        vocabulary = pa.table({"t": pa.array(self.ranks.values(), pa.int64()), "bytes": [word.hex() for word in self.ranks]})
        self.tokens = {m: word for word, m in self.ranks.items()}
        self.token_bytes = np.full(max(self.ranks.values()) + 1, -1, dtype=np.int64)
        for word, m in self.ranks.items():
            self.token_bytes[m] = len(word)
        for name, rows_ in (("merges", table), ("vocabulary", vocabulary)):
            self.db.register("loaded", rows_)
            self.db.execute(f"create table {name} as select * from loaded")
            self.db.unregister("loaded")

    def _clear(self) -> None:
        """Forget the chunks, and the words if there are too many."""
        self.chunks: dict[str, int] = {}
        self.chunk_ids = Runs()
        if len(self.words) > KEPT_WORDS:
            self.words, self.word_ids = {}, Runs()

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after another, and how many each word has."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        whole = np.array([self.ranks.get(w, -1) for w in words], dtype=np.int64)  # a word of the vocabulary is one token
        long = (whole < 0) & (sizes > LONG_BYTES)
        rest = np.flatnonzero((whole < 0) & ~long)
        found: list[tuple[np.ndarray, np.ndarray]] = [(np.flatnonzero(whole >= 0), whole[whole >= 0])]
        ids, counts = self._contracted([words[i] for i in rest])
        found.append((np.repeat(rest, counts), ids))
        chosen = np.flatnonzero(long).tolist()
        for i, ids in zip(chosen, self._stitched([words[i] for i in chosen]), strict=True):
            found.append((np.full(len(ids), i), ids))
        at = np.concatenate([w for w, _ in found])
        ids = np.concatenate([t for _, t in found]).astype(np.uint32)
        return ids[np.argsort(at, kind="stable")], np.bincount(at, minlength=len(words)).astype(np.int64)

    def _contracted(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same by the recursive queries alone."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, dtype=np.int64),) * 2]
        for steps, chosen in ((MERGE_STEPS, np.flatnonzero(sizes <= LONG_BYTES)), (LONG_MERGE_STEPS, np.flatnonzero(sizes > LONG_BYTES))):
            if not len(chosen):
                continue
            lengths = sizes[chosen]
            data = np.frombuffer(b"".join(words[i] for i in chosen), dtype=np.uint8)
            first = np.repeat(np.cumsum(lengths) - lengths, lengths)
            place, tokens = (np.arange(len(data)) - first).astype(np.int32), self.byte_ids[data]
            last = np.zeros(len(data), dtype=bool)
            last[np.cumsum(lengths) - 1] = True
            rows = pa.table({"w": np.repeat(chosen, lengths).astype(np.int32), "p": place, "t": tokens, "np": pa.array(place + 1, mask=last), "nt": pa.array(np.roll(tokens, -1), mask=last)})
            self.db.register("tokens", rows)
            done = self.db.sql(steps).to_arrow_table()
            self.db.unregister("tokens")
            found.append((done.column("w").to_numpy(), done.column("t").to_numpy()))
        at = np.concatenate([w for w, _ in found])
        ids = np.concatenate([t for _, t in found]).astype(np.uint32)
        return ids[np.argsort(at, kind="stable")], np.bincount(at, minlength=len(words)).astype(np.int64)

    def _encoded(self, parts: list[bytes]) -> list[list[int]]:
        distinct = list(dict.fromkeys(parts))
        ids, counts = self._contracted(distinct)
        runs = dict(zip(distinct, (x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])), strict=True)) if distinct else {}
        return [runs[p] for p in parts]

    def _stitched(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of long words: pieces side by side, mended where they meet."""
        out: list[np.ndarray | None] = [None] * len(words)
        cuts = [[w[a : a + PIECE_BYTES] for a in range(0, len(w), PIECE_BYTES)] for w in words]
        ids = iter(self._encoded([p for pieces in cuts for p in pieces]))
        open_ = {i: [next(ids) for _ in pieces] for i, pieces in enumerate(cuts)}
        holds: dict[tuple[int, int], bool] = {}
        reach = 2
        while open_:
            pairs = {i: [(a[-1], b[0]) for a, b in zip(s, s[1:], strict=False)] for i, s in open_.items()}
            new = list(dict.fromkeys(p for own in pairs.values() for p in own if p not in holds))
            for pair, ids in zip(new, self._encoded([self.tokens[a] + self.tokens[b] for a, b in new]), strict=True):
                holds[pair] = ids == list(pair)
            plans = {}
            for i, own in pairs.items():
                broken = {k for k, p in enumerate(own) if not holds[p]}
                if broken:
                    plans[i] = _around(open_[i], broken, reach)
                else:
                    out[i] = np.array([t for s in open_[i] for t in s], dtype=np.uint32)
            anew = iter(self._encoded([b"".join(self.tokens[t] for t in tokens) for plan in plans.values() for tokens, again in plan if again]))
            open_ = {i: [next(anew) if again else tokens for tokens, again in plan] for i, plan in plans.items()}
            reach *= 2
        return out

    def numbered(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts as numbers of chunks, whose ids are then at hand: text ``i`` has
        the numbers from ``ends[i]`` to ``ends[i + 1]``."""
        uneven = pc.match_substring_regex(texts, UNEVEN_SPACE)
        split = pc.split_pattern(pc.if_else(uneven, "", texts), " ")
        coded = split.flatten().dictionary_encode()
        ends = split.offsets.to_numpy() - split.offsets[0].as_py()
        keys, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        later = np.ones(len(at), dtype=bool)
        later[ends[:-1]] = False  # a text's first chunk has no space before it
        firsts = [" " + keys[k] for k in at[ends[:-1]]]
        odd = {i: chunks_of(texts[i].as_py()) for i in np.flatnonzero(uneven.to_numpy(zero_copy_only=False)).tolist()}
        used = np.unique(at[later]).tolist()
        needed = list(dict.fromkeys([*(keys[k] for k in used), *firsts, *(c for chunks in odd.values() for c in chunks)]))
        new = [c for c in needed if c not in self.chunks]
        if len(self.chunks) + len(new) > KEPT:
            self._clear()
            new = needed
        self._learn(new)
        numbers = np.array([self.chunks.get(k, -1) for k in keys], dtype=np.int64)[at]
        numbers[ends[:-1]] = [self.chunks[c] for c in firsts]
        if not odd:
            return numbers, ends
        runs = [np.array([self.chunks[c] for c in odd[i]], dtype=np.int64) if i in odd else numbers[ends[i] : ends[i + 1]] for i in range(len(texts))]
        return np.concatenate(runs), np.cumsum([0, *map(len, runs)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as arrays of unsigned 32-bit integers."""
        if not texts:
            return []
        ids, ends = self.ids_of(*self.numbered(pa.array(texts, pa.string())))
        return [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def ids_of(self, numbers: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = self.chunk_ids.gather(numbers)
        return ids, np.concatenate([[0], np.cumsum(sizes)])[ends]

    def _learn(self, new: list[str]) -> None:
        """Encode chunks that aren't known yet."""
        split = [self.split(c[1:] if c[0] == " " else " " + c) for c in new]
        words = list(dict.fromkeys(w for ws in split for w in ws if w not in self.words))
        self.word_ids.extend(*self.merged([w.encode() for w in words]))
        for w in words:
            self.words[w] = len(self.words)
        ids, sizes = self.word_ids.gather(np.array([self.words[w] for ws in split for w in ws], dtype=np.int64))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        last = np.cumsum([0, *(len(ws) for ws in split)])
        for c in new:
            self.chunks[c] = len(self.chunks)
        self.chunk_ids.extend(ids, np.diff(ends[last]))

    def decode(self, runs: list[np.ndarray]) -> list[bytes]:
        """The bytes of each run of ids."""
        out: list[bytes] = []
        at = 0
        while at < len(runs):
            upto, n = at, 0
            while upto < len(runs) and (n == 0 or n + len(runs[upto]) <= DECODED_AT_ONCE):
                n += len(runs[upto])
                upto += 1
            out += self._decoded(np.concatenate(runs[at:upto]), [len(r) for r in runs[at:upto]])
            at = upto
        return out

    def _decoded(self, ids: np.ndarray, sizes) -> list[bytes]:
        """The bytes of runs of ids, which are joined in stretches of ``RUNS_JOINED`` runs."""
        if len(ids) and (int(ids.max()) >= len(self.token_bytes) or (self.token_bytes[ids] < 0).any()):
            raise ValueError("an id is not in the vocabulary")
        stretch = np.repeat(np.arange(len(sizes)) // RUNS_JOINED, sizes)
        rows = pa.table({"g": stretch, "p": np.arange(len(ids)), "t": ids.astype(np.int64)})
        self.db.register("ids", rows)
        done = self.db.sql("select g, string_agg(bytes, '' order by p) as bytes from ids join vocabulary using (t) group by g order by g").to_arrow_table()
        self.db.unregister("ids")
        joined = bytes.fromhex("".join(done.column("bytes").to_pylist()))
        ends = np.concatenate([[0], np.cumsum(self.token_bytes[ids])])[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])].tolist()
        return [joined[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)]


def _around(stretches: list[list[int]], broken: set[int], reach: int) -> list[tuple[list[int], bool]]:
    """The stretches of a word with ``reach`` tokens on each side of a broken cut taken off and joined,
    and whether each is to be encoded anew."""
    plan: list[tuple[list[int], bool]] = []
    for k, tokens in enumerate(stretches):
        left, right = k - 1 in broken, k in broken
        if (left or right) and len(tokens) <= reach * (left + right):
            parts = [(tokens, True)]
        else:
            a, b = reach * left, len(tokens) - reach * right
            parts = [(tokens[:a], True)] * left + [(tokens[a:b], False)] + [(tokens[b:], True)] * right
        for n, part in enumerate(parts):
            if n == 0 and left:
                plan[-1] = (plan[-1][0] + part[0], True)  # what was taken off before the cut
            else:
                plan.append(part)
    return plan


class Runs:
    """Numbered runs of ids, one after another."""

    def __init__(self):
        self.flat = np.empty(0, dtype=np.uint32)
        self.starts = np.zeros(1, dtype=np.int64)

    def extend(self, ids: np.ndarray, counts: np.ndarray) -> None:
        self.flat = np.concatenate([self.flat, ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = self.starts[numbers]
        sizes = self.starts[numbers + 1] - starts
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)], sizes


def chunks_of(text: str) -> list[str]:
    """Parts that the pattern splits independently: a cut lies at each space between characters
    that aren't white space, as a word takes such a space as its own first character. The first
    part is given a space before it and the others are without theirs, so no two parts that split
    differently are equal."""
    chunks = _CUT.split(text)
    chunks[0] = " " + chunks[0]
    return chunks


def codec(rank_file: str, pattern: str) -> ByteBpe:
    return process_cache(("bytes", rank_file, pattern), lambda: ByteBpe(rank_file, pattern))


def _parts(column: pa.Array, most: int) -> Iterator[slice]:
    """Row ranges of a column of text or bytes with about ``most`` bytes each."""
    sizes = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(sizes):
        upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most)))
        yield slice(at, upto)
        at = upto


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit) of every document."""
    return round_trip(docs, rank_file, pattern, id_col, text_col).drop("decoded")


def decode(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``doc_id, decoded`` (bytes) of every row with ``doc_id, ids``; null ids decode to nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = codec(rank_file, pattern).decode
        for batch in batches:
            for part in _parts(batch.column("ids"), 4 << 20):
                decoded = back([np.frombuffer(p, dtype="<u4") for p in batch.column("ids")[part].to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[part], pa.array(decoded, pa.binary())], names=["doc_id", "decoded"])

    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("ids", F.lit(b"")).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, decoded binary")


def round_trip(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: ids of every whole text, and the bytes that they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(rank_file, pattern)
        for batch in batches:
            for part in _parts(batch.column("text"), TEXT_AT_ONCE):
                numbers, ends = own.numbered(batch.column("text")[part])
                ids, id_ends = own.ids_of(numbers, ends)
                packed = [ids[a:b].astype("<u4", copy=False).tobytes() for a, b in zip(id_ends[:-1], id_ends[1:], strict=True)]
                decoded = own.decode([np.frombuffer(p, dtype="<u4") for p in packed])
                columns = [batch.column("doc_id")[part], pa.array(np.diff(id_ends), pa.int64()), pa.array(packed, pa.binary()), pa.array(decoded, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "decoded"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")
