from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from fleetmart.llm import turntrie

COLUMNS = "conv_id long, turn long, role string, text string, k long, n1 long, depth string, part string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def md5(data):
    return hashlib.md5(data).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = md5((md5(role.encode()) + md5(text.encode())).encode())
            own[conv].append((turn is not None, turn or 0, tie, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (c % 100 if c >= 0 else -(-c % 100))
        whole[c] = tuple(own.get(first, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in sorted(whole.items()):
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
    out = Counter()
    for node, convs in members.items():
        ends = ",".join(str(c) for c in convs if whole[c] == node)
        parent = members[node[:-1]][0] if node else None
        out[convs[0], len(node), parent, len(convs), kids[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def check(spark, rows, partitions=4):
    table = spark.createDataFrame([(*r, 1, 2, "x", "y") for r in rows], COLUMNS).repartition(partitions)
    got = turntrie.prefix_trie(table)
    assert Counter(tuple(r) for r in got.select(NAMES).collect()) == brute(rows)
    return table, got


def chat(seed, convs, longest, texts, roles=("user", "assistant", None)):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        for t in range(rng.randrange(1, longest)):
            rows.append((c, rng.choice([t, t, t, None, 3]), rng.choice(roles), rng.choice(texts)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    few = ["", None, "hello", "Grüße 😀"]
    rows = chat(seed, range(100, 260), 14, few) + chat(seed + 9, range(-130, -90), 4, few) + [(None, 1, "user", "x"), (None, None, None, None)]
    rows += [(c, t, "user", f"turn {t}") for c in range(600, 640) for t in range(3 + c % 25)]
    check(spark, rows)


def test_many_copies_and_hot_openings(spark):
    rows = [(c, t, "user", "the same") for c in range(10_000, 13_000) for t in range(9)]
    rows += [(c, t, "user", "the same" if t < 8 else f"own {c}") for c in range(20_000, 21_000) for t in range(10)]
    check(spark, rows)


def test_long_conversation_is_cut_into_stretches(spark, monkeypatch):
    monkeypatch.setattr(turntrie, "STRETCH_BITS", 4)
    monkeypatch.setattr(turntrie, "PIECE_BITS", 2)
    rows = [(7, t, "user", f"turn {t % 3}") for t in range(700)] + [(8, t, "user", f"turn {t % 3}") for t in range(350)]
    rows += [(c, t, "user", "x") for c in range(50, 70) for t in range(200)]
    check(spark, rows, 8)


def test_repeated_and_equal_turns(spark):
    rows = [(5, 1, "user", "a")] * 40 + [(5, 1, "user", "b"), (5, None, "user", "b"), (6, 1, "user", "a")]
    check(spark, rows)


def test_turnless_conversations_end_in_the_root(spark):
    lent = {c for c in range(101, 160) if zlib.crc32(str(c).encode()) % 6}
    table, got = check(spark, [(c, 1, "user", "only") for c in sorted(lent)])
    assert got.count() == 1 and got.first()["depth"] == 0 and got.first()["n_leaves"] == 1


def test_texts_of_nodes(spark):
    table, got = check(spark, [(100, 1, "user", "a"), (100, 2, None, None), (200, 1, "user", "a")])
    said = {(r.conv_id, r.depth): (r.role, r.text) for r in turntrie.with_texts(got, table).collect()}
    assert said == {(100, 0): (None, None), (100, 1): ("user", "a"), (100, 2): ("", "")}


def test_empty_table(spark):
    got = turntrie.prefix_trie(spark.createDataFrame([], COLUMNS))
    assert got.columns[:8] == NAMES and got.count() == 0
