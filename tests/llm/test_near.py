from __future__ import annotations

import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetmart.llm import chosenpath, forest, groups, repeats, simhash
from fleetmart.llm.components import components as connected
from fleetmart.llm.queries import QUERIES
from tests.llm.brute import components, grouped, near_pairs, sha256, shingles, without_repeats

SF = "/root/testdata/sf0.001"


def near_copies(n, copies, seed=1):
    """Texts in families of edited copies, one of them large."""
    rng = random.Random(seed)
    out = []
    for family in range(n):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(4, 120))]
        for _ in range(copies if family == 0 else rng.randrange(1, 5)):
            own = list(words)
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = f"e{rng.randrange(5000)}"
            out.append(" ".join(own))
    rng.shuffle(out)
    return out


def test_connected_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(500)]
    got = {r.node: r.label for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    links = [(a, b) for a, b in links if a != b]
    assert got == components({x for e in links for x in e}, links)
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def expected_near(rows, percent):
    """Facts of each row by (id, text), ids as the operator's text says."""
    pairs = list(near_pairs([t for _, t in rows], percent))
    label = components(range(len(rows)), pairs)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[label[i]] = min(least.get(label[i], doc_id), doc_id)
    out = []
    for i, (doc_id, text) in enumerate(rows):
        component = least.get(label[i])
        out.append((doc_id, len(shingles(text)), component, doc_id == component))
    return Counter(out)


def test_near_duplicate_query(spark, docs):
    got = Counter(tuple(r) for r in QUERIES["op10_chosen_path"](spark, SF).collect())
    assert got == expected_near([(r.doc_id, r.text) for r in docs.collect()], 85)


@pytest.mark.parametrize("percent", [80, 85])
def test_families_of_near_copies(spark, percent):
    rows = list(enumerate(near_copies(60, 400)))
    got = chosenpath.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), Fraction(percent, 100))
    assert Counter(tuple(r) for r in got.collect()) == expected_near(rows, percent)


def test_crowded_nodes_are_branched_and_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(chosenpath, "ROWS", 8)
    monkeypatch.setattr(groups, "ROWS", 8)
    rows = list(enumerate(near_copies(20, 60, seed=2)))
    got = chosenpath.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), Fraction(85, 100))
    assert Counter(tuple(r) for r in got.collect()) == expected_near(rows, 85)


def test_odd_near_duplicates(spark, odd, empty):
    got = Counter(tuple(r) for r in chosenpath.near_duplicates(odd).collect())
    assert got == expected_near([(r.doc_id, r.text) for r in odd.collect()], 80)
    kept = chosenpath.keep_one(odd)
    assert kept.columns == odd.columns
    wordy = [r for r in odd.collect() if (r.text or "").split()]
    assert sorted(r.text for r in kept.collect() if (r.text or "").split()) == sorted({r.text for r in wordy})
    assert [r.doc_id for r in kept.filter("text like 'the same row twice%'").collect()] == [12]
    assert kept.filter("text is null or trim(text) = ''").count() == odd.filter("text is null or trim(text) = ''").count()
    assert chosenpath.near_duplicates(empty).count() == 0 == chosenpath.keep_one(empty).count()


def test_one_of_equal_texts_stays(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(1, words, "a"), (1, words, "b"), (None, words, "c"), (2, words, "d"), (3, words.upper(), "e"), (4, words + " end", "f"), (None, None, "g"), (None, "", "h"), (5, "z", "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, cls string")
    kept = sorted(r.cls for r in chosenpath.keep_one(docs).collect())
    assert kept in (["a", "g", "h", "i"], ["b", "g", "h", "i"])
    no_ids = spark.createDataFrame([(None, words), (None, words), (None, words + " x")], "doc_id long, text string")
    assert chosenpath.keep_one(no_ids).count() == 1


def test_survivors_are_those_named_by_components(spark):
    rows = list(enumerate(near_copies(25, 30, seed=8)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    named = {r.doc_id for r in chosenpath.near_duplicates(docs).filter("kept").collect()}
    assert {r.doc_id for r in chosenpath.keep_one(docs).collect()} == named


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abAB É\t\n\x0b\x1c\xa0")), max_size=30), max_size=6))
def test_shingle_sets(texts):
    sets = list(chosenpath.shingle_sets(pa.array(texts, pa.string())))
    assert [len(s) for s in sets] == [len({tuple(map(ascii_lower, x)) for x in plain(t)}) for t in texts]
    flat = [{tuple(map(ascii_lower, x)) for x in plain(t)} for t in texts]
    for i, a in enumerate(flat):
        for j, b in enumerate(flat):
            assert len(np.intersect1d(sets[i], sets[j])) == len(a & b)


def ascii_lower(word):
    return word.encode().lower()


def plain(text):
    words = [w for w in text.translate({c: " " for c in range(9, 14)}).split(" ") if w]
    return [words[i : i + 5] for i in range(max(1, len(words) - 4))] if words else []


def test_repeats_query(spark, docs):
    rows = docs.collect()
    expected = {r.doc_id: (len(r.text.encode()), n, runs, sha256(kept)) for r, (n, runs, kept) in zip(rows, without_repeats([r.text for r in rows], 200), strict=True)}
    assert {r[0]: tuple(r)[1:] for r in QUERIES["op9_repeats"](spark, SF).collect()} == expected


@pytest.mark.parametrize("hot", [8, 2])
def test_repeated_passages(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "CHUNK", 5_000)
    monkeypatch.setattr(repeats, "SEGMENT", 700)
    monkeypatch.setattr(repeats, "BUCKET", 2_000)
    rng = random.Random(7)

    def noise(n):
        return "".join(rng.choice("abcdefgh é") for _ in range(n))

    passage, other = noise(420), noise(230)
    texts = [noise(rng.randrange(0, 300)) + passage[rng.randrange(0, 200) :] + noise(rng.randrange(0, 90)) for _ in range(60)]
    texts += [noise(150) + other + noise(50), other, other[:199], passage[10:210] + passage[10:210], "a" * 700, "ab" * 300, "a" * 200, "a" * 201, None, "", "x"]
    texts += [noise(199), passage, passage, "é" * 150]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.rest.doc_id: (r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(frame, 200).collect()}
    assert got == dict(enumerate(without_repeats(texts, 200)))


@pytest.mark.parametrize("length", [129, 256, 300, 520, 1100])
def test_passages_of_any_length(spark, length):
    rng = random.Random(length)
    passages = ["".join(rng.choice("abcd ") for _ in range(n)) for n in (100, 128, 200, length - 1, length, length + 1, 2 * length, 1500)]
    texts = []
    for _ in range(60):
        parts = [rng.choice([rng.choice(passages), rng.choice(passages)[rng.randrange(90) :], "".join(rng.choice("wxyz") for _ in range(rng.randrange(200)))]) for _ in range(rng.randrange(6))]
        texts.append("".join(parts))
    texts += ["ab" * 900, "a" * (length + 3), "", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.rest.doc_id: (r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(frame, length).collect()}
    assert [got[i] for i in range(len(texts))] == without_repeats(texts, length)


def test_sizes_double_up_to_the_length():
    assert [repeats.refined_sizes(n) for n in (129, 200, 256, 257, 1100)] == [[128, 129], [128, 200], [128, 256], [128, 256, 257], [128, 256, 512, 1024, 1100]]


def test_empty_texts_fill_chunks(spark):
    frame = spark.createDataFrame([(i, "") for i in range(70_000)], "doc_id long, text string").coalesce(1)
    chunks = repeats._chunks(frame.select(F.col("text").cast("binary").alias("text"), F.struct("doc_id").alias("rest")))
    assert chunks.count() > 1 and repeats.remove_repeats(frame).count() == 70_000


def test_odd_repeats(spark, odd, empty):
    rows = odd.collect()
    expected = Counter((r.doc_id, kept.decode("utf-8", "ignore") if r.text is not None else None) for r, (_, _, kept) in zip(rows, without_repeats([r.text for r in rows], 200), strict=True))
    cleaned = repeats.cleaned(odd)
    assert cleaned.schema.simpleString() == odd.schema.simpleString()
    got = cleaned.collect()
    assert Counter((r.doc_id, r.text) for r in got) == expected
    assert all(r.n_chars == (None if r.text is None else len(r.text)) and (r.score, r.rest) in {(0.5, "x"), (0.5, None)} for r in got)
    assert repeats.cleaned(empty).count() == 0
    with pytest.raises(ValueError):
        repeats.remove_repeats(odd, repeats.GRAM)


def check_simhash(rows, got, radius):
    order = sorted(rows, key=lambda r: (r.doc_id is None, -(r.doc_id or 0)))
    prints = {r.doc_id: r.fingerprint for r in got}
    by_id = {r.doc_id: r for r in got}
    for k, r in enumerate(order):
        text, after = r.text or "", order[(k + 1) % len(order)]
        third = len(text) // 3
        edited = text[: len(text) - third] + (after.text or "")[:third]
        own = by_id[r.doc_id]
        likeness = [1 - (int(own.fingerprint, 16) ^ int(x, 16)).bit_count() / 128 for x in (own.edited_fingerprint, prints[after.doc_id])]
        near = sum((int(own.fingerprint, 16) ^ int(x, 16)).bit_count() <= radius for x in prints.values()) - 1
        assert (own.n_chars, own.edited_sha256, own.near_edited, own.near_next, own.n_near) == (len(text), sha256(edited.encode()), *likeness, near)


def test_simhash_query(spark, docs, monkeypatch):
    monkeypatch.setattr(simhash, "SLICE", 30)
    rows, got = docs.collect(), QUERIES["op4_simhash"](spark, SF).collect()
    check_simhash(rows, got, 3)
    texts = grouped((r.text, p.fingerprint) for r in rows for p in got if p.doc_id == r.doc_id)
    assert all(len(set(p)) == 1 for p in texts.values())
    edited, after = (np.array([r[c] for r in got]) for c in ("near_edited", "near_next"))
    assert (edited > after).mean() > 0.95


def test_odd_simhash(spark, odd, empty):
    unique = odd.dropna(subset=["doc_id"]).dropDuplicates(["doc_id"]).cache()
    check_simhash(unique.collect(), simhash.compared(unique).collect(), 3)
    assert simhash.compared(odd).count() == odd.count()
    assert simhash.compared(empty).count() == 0
    one = unique.filter("doc_id = 9")
    check_simhash(one.collect(), simhash.compared(one).collect(), 3)


@pytest.mark.parametrize(("slice_", "most"), [(10, 4), (10, 4096), (7, 1), (2_000, 4096)])
def test_next_documents_of_crowded_ids(spark, monkeypatch, slice_, most):
    monkeypatch.setattr(simhash, "SLICE", slice_)
    monkeypatch.setattr(simhash, "MOST_SLICES", most)
    rows = [(5, f"text {i} of five") for i in range(200)] + [(None, f"no id {i}") for i in range(60)] + [(None, "one and the same")] * 90 + [(5, "copy of five")] * 70
    rows += [(i * i * i, f"own words {i}") for i in range(-20, 120)] + [(8, "twice")] * 2 + [(-(1 << 63), "least"), ((1 << 63) - 1, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    hashes = {r[0]: r[1] for r in frame.select(F.coalesce("text", F.lit("")).alias("t")).distinct().select("t", F.xxhash64("t")).collect()}
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), -hashes[r[1]]))
    want = Counter()
    for k, (i, text) in enumerate(order):
        after, third = order[(k + 1) % len(order)][1], len(text) // 3
        want[i, len(text), sha256((text[: len(text) - third] + after[:third]).encode())] += 1
    got = simhash.compared(frame).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    prints = {}
    for r in got:
        prints.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
    assert len(prints[None, 16]) == 1 and sum(r.near_next == 1.0 for r in got if (r.doc_id, r.n_chars) == (None, 16)) >= 89
    slices = simhash.with_next(frame).groupBy("slice").count().agg(F.max("count")).first()[0]
    assert most < 4096 or slices <= max(60, 4 * slice_) or slice_ == 2_000


def test_all_fingerprints_within_the_radius(spark):
    rng = random.Random(9)
    base = [rng.getrandbits(128) for _ in range(5)]
    prints = {b ^ sum(1 << k for k in rng.sample(range(128), rng.randrange(0, 7))) for b in base for _ in range(40)}
    signed = [tuple(x - (1 << 64) if x >> 63 else x for x in (p & (1 << 64) - 1, p >> 64)) for p in prints]
    frame = spark.createDataFrame(signed, "f1 long, f2 long")
    for radius, blocks in ((3, 6), (0, 2), (4, 6)):
        got = {((r.a1, r.a2), (r.b1, r.b2)) for r in simhash.links(frame, radius, blocks).collect()}
        expected = {(a, b) for a in signed for b in signed if a < b and sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(a, b, strict=True)) <= radius}
        assert got == expected


def vectors(seed, n):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        base = rng.standard_normal(16)
        for _ in range(rng.integers(1, 5) if k else 80):
            out.append(((base + rng.standard_normal(16) * rng.choice([0, 0.05, 0.2])) * rng.choice([1, 3])).astype(np.float32).tolist())
    return out


def check_vectors(rows, got):
    good = [i for i, (_, v, label) in enumerate(rows) if label is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = []
    for i in good:
        for j in good:
            if i < j and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.array(rows[k][1], dtype=np.float64) for k in (i, j))
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.98:
                    links.append((i, j))
    label, n = components(range(len(rows)), links), Counter(x for e in links for x in e)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (n[i], label[i], label[i] == i) for i in range(len(rows))}


@pytest.mark.parametrize("most", [256, 16])
def test_forest(spark, monkeypatch, most):
    monkeypatch.setattr(groups, "ROWS", most)
    monkeypatch.setattr(forest, "ROWS", most)
    rows = [(i, v, i % 2) for i, v in enumerate(vectors(3, 120))]
    odd = [(None, 1), ([], 1), ([0.0] * 16, 1), ([float("nan")] * 16, 1), ([None, *[1.0] * 15], 1), (rows[0][1], None), (rows[0][1][:8], 0), ([float("inf"), *[1.0] * 15], 0)]
    rows += [(len(rows) + k, v, label) for k, (v, label) in enumerate(odd)]
    frame = spark.createDataFrame([(*r, 1.0, "x") for r in rows], "vec_id long, embedding array<float>, label int, unit double, cls string").repartition(3)
    check_vectors([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], x) for i, v, x in rows], forest.near_duplicates(frame).collect())


def test_forest_without_rows_or_ids(spark):
    schema = "vec_id long, embedding array<double>, label int"
    assert forest.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    got = forest.near_duplicates(spark.createDataFrame([(None, [1.0, 0.0], 1), (7, [1.0, 0.0], 1), (7, [1e300, -1e300], 1), (None, [0.0, 1.0], 1)], schema)).collect()
    assert Counter(tuple(r) for r in got) == Counter([(None, 1, 7, False), (7, 1, 7, True), (7, 0, 7, True), (None, 0, None, True)])


def test_forest_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    check_vectors([(r.vec_id, r.embedding, r.label) for r in rows], QUERIES["op6_forest"](spark, SF).collect())


def planted_pairs(mean, n, width=64, cosine=0.98):
    """Unit vectors with the given mean cosine: each with a partner at ``cosine``."""
    rng = np.random.default_rng(12)
    centre = np.zeros(width)
    centre[0] = 1
    x = rng.standard_normal((n, width))
    x[:, 0] = 0
    x = math.sqrt(mean) * centre + math.sqrt(1 - mean) * x / np.linalg.norm(x, axis=1, keepdims=True)
    aside = rng.standard_normal((n, width))
    aside -= (aside * x).sum(axis=1, keepdims=True) * x
    y = cosine * x + math.sqrt(1 - cosine**2) * aside / np.linalg.norm(aside, axis=1, keepdims=True)
    return np.stack([x, y], axis=1).reshape(-1, width)


@pytest.mark.parametrize("mean", [0.7, 0.95])
def test_pairs_share_a_leaf_however_concentrated(spark, monkeypatch, mean):
    monkeypatch.setattr(forest, "ROWS", 8)
    units = planted_pairs(mean, 2_000)
    n = len(units)
    rows = pa.table({"cls": pa.array([k.to_bytes(4, "big") for k in range(n)], pa.binary()), "part": pa.array([1] * n, pa.int64()), "unit": pa.array(list(units), pa.list_(pa.float64()))})
    found = forest.leaves(spark.createDataFrame(rows), n, n, 0.98).select("tree", "node", "cls")
    pair = F.floor(F.conv(F.hex("cls"), 16, 10).cast("long") / 2)
    met = found.groupBy("tree", "node", pair.alias("pair")).agg(F.count(F.lit(1)).alias("n")).filter("n = 2").select("pair").distinct().count()
    assert n // 2 - met <= 1


@pytest.mark.parametrize("mean", [0.0, 0.8, 0.95])
def test_forest_of_concentrated_vectors(spark, mean):
    units = planted_pairs(mean, 1_500)
    units = (units[:, None] + np.random.default_rng(2).standard_normal((len(units), 1, units.shape[1])) * 0.001).reshape(-1, units.shape[1])
    got = forest.near_duplicates(spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(units)], "vec_id long, embedding array<double>, label int")).collect()
    unit = units / np.linalg.norm(units, axis=1, keepdims=True)
    links = unit @ unit.T >= 0.98
    label = components(range(len(units)), list(zip(*(x.tolist() for x in np.nonzero(np.triu(links, 1))), strict=True)))
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {i: (int(links[i].sum()) - 1, label[i]) for i in range(len(units))}


def test_near_copies_with_unlikely_signatures(spark):
    rng = random.Random(3)
    found = []
    while len(found) < 3:  # 92 of 108 shingles are shared, and the signatures agree in under 95 of 128 places
        words = [f"w{rng.randrange(10**6)}" for _ in range(104)]
        pair = [" ".join(words), " ".join(words[:96] + [f"e{rng.randrange(10**6)}" for _ in range(8)])]
        a, b = (chosenpath.minwise(s)[1] for s in chosenpath.shingle_sets(pa.array(pair)))
        if (a == b).sum() < 95:
            found += pair
    rows = list(enumerate(found))
    got = chosenpath.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), Fraction(85, 100))
    assert Counter(tuple(r) for r in got.collect()) == expected_near(rows, 85)


def test_work_on_a_family_of_near_copies_is_in_proportion(spark):
    """A large family is compared with one block of it, not with itself."""

    def pairs(n):
        members = spark.createDataFrame([(0, f"{i}".encode(), n) for i in range(n)], "group long, cls binary, size long")
        payloads = members.select("cls", F.col("cls").alias("p"))
        met = spark.sparkContext.accumulator(0)

        def linked(values, left, right):
            met.add(len(left))
            return np.ones(len(left), dtype=bool)

        edges = chosenpath.connect(members, "group", payloads, "p", linked, n, 2 * n).collect()
        label = components(range(n), [(int(r.a), int(r.b)) for r in edges])
        assert set(label.values()) == {0}
        return met.value

    assert pairs(8000) < 12 * pairs(1000)  # a block of 192 against all; all against all would be 64


@pytest.mark.parametrize("n", [300, 900])
def test_groups_of_several_components_are_found_whole(spark, monkeypatch, n):
    """Rows link if their numbers agree modulo 7, or are neighbours in one of the classes."""
    members = spark.createDataFrame([(g, f"{g},{i}".encode(), n) for g in range(2) for i in range(n)], "group long, cls binary, size long")

    def linked(values, left, right):
        number = np.array([int(v.split(b",")[1]) for v in values])
        return (number[left] % 7 == number[right] % 7) & (number[left] % 7 < 5) & (np.abs(number[left] - number[right]) < 60)

    edges = chosenpath.connect(members, "group", members.select("cls", F.col("cls").alias("p")), "p", linked, n, 2 * n).collect()
    key = lambda v: tuple(map(int, bytes(v).split(b",")))
    got = components([(g, i) for g in range(2) for i in range(n)], [(key(r.a), key(r.b)) for r in edges])
    want = components([(g, i) for g in range(2) for i in range(n)], [((g, i), (g, i + 7)) for g in range(2) for i in range(n - 7) if i % 7 < 5])
    assert got == want
