from __future__ import annotations

import zlib

import numpy as np
import pytest

from fleetmart.llm import boosting, quality, toxicity
from fleetmart.llm.labelled import held_out, training_rows
from fleetmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def ranking(y, score):
    """Probability that a row with label 1 scores above one with label 0."""
    above = score[y == 1][:, None] - score[y == 0][None, :]
    return (above > 0).mean() + (above == 0).mean() / 2


@pytest.mark.parametrize(("name", "label", "threshold", "least"), [("op7_quality", "quality", 0.3, 0.99), ("op5_toxicity", "toxic", 0.5, 0.9)])
def test_held_out_accuracy(spark, name, label, threshold, least):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = QUERIES[name](spark, SF).join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in rows)
    judged = [r for r in rows if r.held_out and r[label] is not None]
    y, score = (np.array([r[c] for r in judged], dtype=float) for c in (label, "score"))
    assert ranking(y, score) > least
    assert ((score >= threshold) == y).mean() > 0.93


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_scores(spark, odd, empty, module):
    labels = spark.createDataFrame([(8, 1, 1), (9, 0, 0), (10, 0, 0), (None, 1, 1), (11, None, None), (8, 0, 0)], "doc_id long, quality int, toxic int")
    model = module.fit(odd, labels)
    rows = module.scores(odd, model, 0.5).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (5, 6)}) == 1
    kept = module.keep(odd, model, 0.5)
    assert kept.columns == odd.columns
    assert kept.count() == sum(r.predicted == (module is quality) for r in rows)
    assert module.scores(empty, model, 0.5).count() == 0
    for docs, none in ((odd, labels.limit(0)), (empty, labels)):
        assert {r.score for r in module.scores(odd, module.fit(docs, none), 0.5).collect()} == {0.5}
    with_clash = odd.withColumnsRenamed({"score": "quality_score", "kept": "Toxicity_Score"})
    assert module.keep(with_clash, model, 0.0 if module is quality else 1.1).columns == with_clash.columns


def test_training_rows_are_bounded_and_not_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = training_rows(docs, labels, "toxic", positives=10, negatives=25)
    assert {(r.y, r["count"]) for r in rows.groupBy("y").count().collect()} == {(1, 10), (0, 25)}
    assert rows.filter(held_out(rows["doc_id"])).count() == 0


def test_boosted_trees():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 6))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    model = boosting.fit(x[:2000], y[:2000])
    assert ((boosting.predict(model, x[2000:]) > 0.5) == y[2000:]).mean() > 0.97
    assert np.array_equal(boosting.fit(x[:2000], y[:2000]).threshold, model.threshold)
    margin = np.full(50, model.prior)  # each row walked down by itself
    for k in range(50):
        for feature, threshold, value in zip(model.feature, model.threshold, model.value, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if x[k, feature[node]] > threshold[node] else 1)
            margin[k] += value[node - len(feature)]
    assert np.allclose(boosting.predict(model, x[:50]), 1 / (1 + np.exp(-margin)))
    assert boosting.predict(boosting.fit(x, np.ones(3000)), x).min() > 0.99
    assert len(boosting.predict(model, x[:0])) == 0


def test_windows_hold_the_whole_text():
    for text in ("", "one", "a " * 100, "x" * 1000 + " y", "words of several sizes " * 30):
        data = toxicity.plain(text)
        parts = toxicity.windows(data)
        assert parts[0] + b"".join(p[1:] for p in parts[1:]) == data


def test_toxic_passages_behind_a_long_beginning_are_learned(spark):
    rng = np.random.default_rng(6)
    words = np.array([f"{a}{b}{c}" for a in "bdfgklm" for b in ("ane", "oru", "ilo", "emu") for c in ("st", "rd", "nk", "l", "mp")])
    marks = np.array(["vrxaq", "zzuqo", "qwyxe", "xujjo"])

    def text(toxic):
        passage = " ".join(rng.choice(marks, 12)) if toxic else ""
        return " ".join(rng.choice(words, 3_600)) + f" {passage} " + " ".join(rng.choice(words, 40))

    rows = [(i, text(i % 2), i % 2) for i in range(560)]
    assert min(t.find(m) for _, t, y in rows if y for m in marks if m in t) > 20_000
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4).cache()
    model = toxicity.fit(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
    got = {r.doc_id: r for r in toxicity.scores(frame, model, 0.5).collect()}
    judged = [(y, got[i].score) for i, _, y in rows if got[i].held_out]
    assert len(judged) > 50 and all((score >= 0.5) == y for y, score in judged)


def test_dictionary_windows_are_drawn_from_the_whole_text():
    data = toxicity.plain(" ".join(f"word{i}" for i in range(5_000)))
    parts = toxicity.windows(data, 64)
    places = sorted(parts.index(w) / len(parts) for w in toxicity.drawn_windows(data, 3))
    assert len(places) == toxicity.DRAWN and places[0] < 0.2 and places[-1] > 0.8


@pytest.mark.parametrize("toxic", [None, 0, 1])
def test_all_documents_are_kept_without_labels_of_both_kinds(spark, odd, toxic):
    labels = spark.createDataFrame([(9, toxic), (10, toxic)], "doc_id long, toxic int")
    assert toxicity.keep(odd, toxicity.fit(odd, labels), 0.5).count() == odd.count()


@pytest.mark.parametrize("module", [quality, toxicity])
@pytest.mark.parametrize("label", [0, 1])
def test_labels_of_one_kind_reject_nothing(spark, module, label):
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(20)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", f"{label} as quality", f"{label} as toxic")
    assert module.keep(docs, module.fit(docs, labels), 0.3 if module is quality else 0.5).count() == 20


def test_sample_is_bounded_in_rows(spark):
    from fleetmart.llm.labelled import training_rows

    docs = spark.createDataFrame([(2, f"text {i}") for i in range(500)] + [(i, "x") for i in range(100, 140)], "doc_id long, text string")
    labels = spark.createDataFrame([(2, 1)] + [(i, i % 2) for i in range(100, 140)], "doc_id long, quality int")
    rows = training_rows(docs, labels, "quality", positives=10, negatives=10).collect()
    assert len(rows) <= 20 and len({r.doc_id for r in rows}) == len(rows)
