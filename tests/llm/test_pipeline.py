from __future__ import annotations

import os
import shutil
import subprocess
import sys
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from fleetmart.llm import boosting, packing, quality, toxicity
from tests.llm.brute import components, near_pairs, without_repeats

SF = "/root/testdata/sf0.001"
HERE = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def by_hand(spark, docs, labels):
    """Pieces that the stages must give for rows of (doc_id, text), one document at a time."""
    columns = "doc_id long, text string"
    model = quality.fit(spark.createDataFrame(docs, columns), labels)
    docs = [d for d in docs if boosting.predict(model, quality.extract([d[1] or ""]))[0] >= 0.3]
    model = toxicity.fit(spark.createDataFrame(docs, columns), labels)
    own = toxicity.Distance(model.ordinary, model.toxic)
    docs = [d for d in docs if boosting.predict(model.trees, np.array([own.features(toxicity.plain(d[1] or ""))]))[0] < 0.5]
    label = components(range(len(docs)), list(near_pairs([t for _, t in docs], 80)))
    least = {c: min(docs[i][0] for i in label if label[i] == c) for c in label.values()}
    docs = [d for i, d in enumerate(docs) if d[0] == least[label[i]]]
    texts = [kept.decode("utf-8", "ignore") for _, _, kept in without_repeats([t for _, t in docs], 200)]
    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode
    out = Counter()
    for (doc_id, _), text in zip(docs, texts, strict=True):
        ids, start = [*encode(text, add_special_tokens=False).ids, 1], 0
        for length in packing.binary_lengths(len(ids), 2048):
            out[doc_id, start, length, np.array(ids[start : start + length], dtype="<u4").tobytes()] += 1
            start += length
    return out


def pieces(frame):
    return Counter((r.doc_id, r.start, r.length, bytes(r.ids)) for r in frame.collect())


def test_run_equals_the_stages_by_hand(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    expected = by_hand(spark, [(r.doc_id, r.text) for r in docs.collect()], labels)
    assert pieces(corpus_pipeline.run(spark, SF)) == expected


def test_stages_keep_the_columns(spark, odd, tmp_path):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "toxicity", "near_duplicates", "repeats", "packing"]
    for start in (odd, odd.limit(0)):
        frame = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            path = str(tmp_path / f"{name}-{start is odd}")
            stage(spark, frame, SF).write.parquet(path)
            frame = spark.read.parquet(path)
            assert frame.columns == odd.columns
        last = corpus_pipeline.STAGES[-1][1](spark, frame, SF)
        assert {r.doc_id for r in last.collect()} == {r.doc_id for r in frame.collect()}


def test_the_rest_works_without_these_modules(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(HERE, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", ".hypothesis", "llm", "corpus_pipeline.py"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and len(q) > 40; assert set(e.oracle_sql()) <= set(q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
