from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetmart.llm import collocations as C
from fleetmart.llm import wordstream
from tests.llm.conftest import COLUMNS


def words_of(text):
    """The words of each piece."""
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall("[^ \t]+", piece) for piece in re.split("[.,;:!?\n-\r]", text)]


def brute(rows, least, most=2000):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for ws in words_of(text):
            n[lang] += len(ws)
            for k in range(1, 6):
                for i in range(len(ws) - k + 1):
                    f[lang][tuple(ws[i : i + k])] += 1
    out = Counter()
    for lang, c in f.items():
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = {q[i : i + k] for q, a in candidates.items() for k in range(2, len(q)) for i in range(len(q) - k + 1) if a >= candidates[q[i : i + k]]}
        ranked = []
        for p, a in candidates.items():
            if p not in inside:
                score, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for i, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:most]):
            out[lang, i + 1, phrase.decode(), -a, left, right, n[lang], -score] += 1
    return out


def check(spark, rows, least, most=2000, partitions=3, **how):
    docs = spark.createDataFrame([(i, t, lang, *[None] * 11) for i, (lang, t) in enumerate(rows)], COLUMNS).repartition(partitions)
    got = C.collocations(docs, least=least, most=most, **how)
    assert Counter(tuple(r)[:8] for r in got.collect()) == brute(rows, least, most)


def texts(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "aBé日" for b in "xYz"]
    for _ in range(n):
        ws = [rng.choice(vocabulary[: rng.randrange(2, 12)]) for _ in range(rng.randrange(0, 60))]
        yield rng.choice([None, "en", "de", "und"]), "".join(w + rng.choice([" ", " ", "\t ", "  ", ". ", ",", "\n", "\x0b"]) for w in ws)


@pytest.mark.parametrize(("seed", "shard"), [(1, 40), (2, 300), (3, 10**6)])
def test_equals_brute_force(spark, seed, shard):
    check(spark, list(texts(seed, 250)), 4, shard_words=shard, bucket_words=20, bucket_tokens=500)


def test_ties_copies_and_few_results(spark):
    check(spark, [("en", "one two three four five six. one two"), ("en", "seven eight")] * 30 + list(texts(5, 60)), 3, most=7)


def test_phrases_that_overlap_themselves(spark):
    check(spark, [(None, "a a a a a a a a"), ("en", "b a b a b a b a b a b"), ("en", "A a")] * 4, 2, shard_words=5)


def test_odd_rows(spark, odd, empty):
    rows = [tuple(r) for r in odd.select("lang", "text").collect()]
    got = C.collocations(odd, least=2, shard_words=1000)
    assert Counter(tuple(r)[:8] for r in got.collect()) == brute(rows, 2)
    assert C.collocations(empty).count() == 0
    assert C.collocations(odd.filter("doc_id in (5, 6, 7)")).count() == 0


def test_products_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    big = 9 * 10**14
    row = spark.createDataFrame([(["x", "y"], big, 10 * big, [3 * big, big], [2 * big, big])], "words array<string>, a long, n long, fronts array<long>, backs array<long>")
    cut = row.select(F.expr(C._CUT).alias("c")).first()["c"]
    assert (cut.score, cut.k) == (1000 * big * 10 * big // (3 * big * 2 * big), 1)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), max_size=30), max_size=6))
def test_intervals_count_phrases(pieces):
    tokens = np.array([0] + [t for p in pieces for t in [*p, 0]], dtype=np.int32)
    before, first = C.transformed(tokens)
    target = C.last_to_first(before)
    lo, n = first[:-1][1:], np.diff(first)[1:]
    names = [(i + 1,) for i in range(len(lo))]
    for length in range(2, C.LONGEST + 1):
        lo, n, front, back = C.extend(target, lo, n)
        grown = [(*names[a], names[b][-1]) for a, b in zip(front.tolist(), back.tolist(), strict=True)]
        want = Counter(tuple(p[i : i + length]) for p in pieces for i in range(len(p) - length + 1))
        assert dict(zip(grown, n.tolist(), strict=True)) == want
        names = grown


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB .\n\té", max_size=30), max_size=8), st.integers(1, 9))
def test_word_stream_cuts_anywhere(rows, chunk):
    saved, wordstream.CHUNK = wordstream.CHUNK, chunk
    try:
        stream = wordstream.WordStream(wordstream.byte_classes(b" \t", b".\n"))
        chunks = [c for r in rows for c in stream.feed(memoryview(r.encode()))] + list(stream.close())
    finally:
        wordstream.CHUNK = saved
    pieces = []
    for words, breaks in chunks:
        for word, new in zip(words.to_pylist(), (breaks > 0).tolist(), strict=True):
            if new:
                pieces.append([])
            pieces[-1].append(word.decode())
    assert pieces == [p for r in rows for p in words_of(r) if p]
