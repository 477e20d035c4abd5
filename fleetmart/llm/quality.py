"""Quality of documents by boosted trees over statistics of their whole texts.

The features are shares of character classes, lengths of words and lines, and repetition; null
text counts as empty and scores as such. The model learns from a bounded sample of labelled rows
outside the held-out fold; without labels of both kinds every document gets the sample's rate
(0.5 without any). Rows, null and repeated ids and further columns pass through; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm import boosting
from fleetmart.llm.labelled import features_of, held_out, training_rows, unused_column, with_score
from fleetmart.llm.shared import process_cache

#: Labelled rows that a model is fitted on, at most.
POSITIVES, NEGATIVES = 8_000, 8_000

_CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r", b"\n", b".", b",;:", b"!", b"?", b"|", b"#$%&*@^~+=", b"'\"()[]{}", b"<>/\\_-", bytes(range(128, 256))]
_CLASS_OF = np.full(256, len(_CLASSES), dtype=np.int64)
for _k, _members in enumerate(_CLASSES):
    _CLASS_OF[list(_members)] = _k
WIDTH = len(_CLASSES) + 1 + 19


def statistics(text: str) -> list[float]:
    """The features of one text."""
    data = text.encode()
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    n = max(1, len(data))
    shares = np.bincount(_CLASS_OF, counts, len(_CLASSES) + 1) / n
    p = counts[counts > 0] / n
    words = text.split()
    m = max(1, len(words))
    seen = Counter(words)
    most = seen.most_common(3)
    sizes = np.array([len(w) for w in words] or [0])
    lines = text.split("\n")
    distinct_lines = len(set(lines))
    repeated = sum(map(str.__eq__, words[1:], words[:-1]))
    return [
        *shares,
        float(-(p * np.log2(p)).sum()),
        float(np.log1p(n)),
        float(np.log1p(len(words))),
        float(sizes.mean()),
        float(sizes.std()),
        float(sizes.max()),
        float((sizes <= 3).mean()),
        len(seen) / m,
        most[0][1] / m if most else 0.0,
        sum(c for _, c in most) / m,
        repeated / m,
        sum(map(str.isupper, words)) / m,
        sum(map(str.istitle, words)) / m,
        sum(map(str.isalpha, words)) / m,
        float(np.log1p(len(lines))),
        distinct_lines / len(lines),
        len(words) / len(lines),
        sum(x.rstrip().endswith((".", "!", "?")) for x in lines) / len(lines),
        float(len(data) - len(text)) / n,
    ]


def extract(texts: list[str]) -> np.ndarray:
    process_cache("statistics", dict)
    return np.array([statistics(t) for t in texts], dtype=np.float64).reshape(-1, WIDTH)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", *, positives: int = POSITIVES, negatives: int = NEGATIVES, id_col: str = "doc_id", text_col: str = "text") -> boosting.Trees:
    rows = training_rows(docs, labels, label, positives=positives, negatives=negatives, id_col=id_col, text_col=text_col)
    x, y = features_of(rows, extract, WIDTH)
    return boosting.fit(x, y) if len(y) else boosting.constant(0.5)


def score(docs: DataFrame, model: boosting.Trees, name: str = "score", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and the probability of label 1 in the new column ``name``."""
    return with_score(docs, lambda texts: boosting.predict(model, extract(texts)), name, text_col)


def keep(docs: DataFrame, model: boosting.Trees, threshold: float, text_col: str = "text") -> DataFrame:
    """The documents that score ``threshold`` or more, with their columns; all documents if the model
    has seen no labels of both kinds."""
    if not len(model.feature):
        return docs
    name = unused_column(docs, "quality_score")
    return score(docs, model, name, text_col).filter(F.col(name) >= threshold).drop(name)


def scores(docs: DataFrame, model: boosting.Trees, threshold: float) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return score(rows, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
