"""Plain versions of the operators, one document or pair at a time."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def near_pairs(texts, percent):
    """Indices of texts whose sets are similar."""
    sets = [shingles(t) for t in texts]
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                yield j, i


def without_repeats(texts, length):
    """For each text as bytes: removed bytes, runs, remaining bytes."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        covered = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        runs = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        out.append((sum(covered), runs, bytes(b for b, c in zip(d, covered, strict=True) if not c)))
    return out


def sha256(data):
    return hashlib.sha256(data).hexdigest()


def grouped(pairs):
    out = defaultdict(list)
    for k, v in pairs:
        out[k].append(v)
    return out
