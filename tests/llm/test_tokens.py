from __future__ import annotations

import base64
import io
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetmart.llm import bitplanes, bytebpe, packing, wordbpe
from fleetmart.llm.queries import QUERIES
from tests.llm.brute import grouped, sha256

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = Tokenizer.from_file(WORDS)
SF = "/root/testdata/sf0.001"
ODD_TEXT = st.text(st.sampled_from(list(" \n\t\x0b\x1c\x85\xa0'stremvdlSTÉßñ½²1290.,!<|>#日😀İΣσJeE\u030c\u0301\u2003")), max_size=60)


def whole(text, end):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(ODD_TEXT | st.text(max_size=40))
def test_words_encode_as_the_library_does(text):
    assert wordbpe.encoder(WORDS).encode(text).tolist() == whole(text, 0)[:-1]


def test_special_tokens_in_a_text():
    for text in ("a<|endoftext|>B <|startoftext|>", "<|ENDOFTEXT|> C", "X " * 50 + "<|endoftext|>"):
        assert wordbpe.encoder(WORDS).encode(text).tolist() == whole(text, 0)[:-1]


def test_a_full_table_starts_anew(monkeypatch):
    monkeypatch.setattr(wordbpe, "KEPT_WORDS", 50)
    own = wordbpe.WordEncoder(WORDS)
    texts = [" ".join(f"w{i * j}" for i in range(30)) for j in range(20)]
    ids, ends = own.encode_array(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [whole(t, 0)[:-1] for t in texts]
    for text in texts:
        assert own.encode(text).tolist() == whole(text, 0)[:-1]
        assert len(own.words) <= 50


def test_a_full_table_keeps_what_is_met_again(monkeypatch):
    monkeypatch.setattr(wordbpe, "KEPT_WORDS", 50)
    monkeypatch.setattr(wordbpe, "KEPT_PARTS", 40)
    own = wordbpe.WordEncoder(WORDS)
    for j in range(20):
        texts = [f"it's common, Ünïcödé <|endoftext|> x{j}y{i} word{chr(97 + i)}{chr(97 + j)}, {chr(97 + i) * (j + 60)}" for i in range(8)]
        ids, ends = own.encode_array(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [whole(t, 0)[:-1] for t in texts]
        assert len(own.words) <= 50 and len(own.parts) <= 40 and max(map(len, own.words)) <= 64
        assert len(own.words) == len(own.again) == len(own.starts) - 1 and own.starts[-1] == len(own.flat)
        assert j == 0 or {"it's", "common,", "Ünïcödé"} <= own.words.keys()


def check_pieces(pieces, texts):
    """Pieces of every document are powers of two in a row that hold each id once."""
    by_doc = grouped((r["doc_id"], r) for r in pieces)
    assert len({r["sequence_id"] for r in pieces}) == len(pieces)
    assert all(r["offset"] == 0 and r["length"] & (r["length"] - 1) == 0 and r["length"] <= 2048 for r in pieces)
    for doc_id, bodies in grouped(texts).items():
        expected = []
        for text in bodies:
            ids = whole(text, 1)
            expected += [(len(ids), len(x), crc(x)) for x in np.split(ids, np.cumsum(packing.binary_lengths(len(ids), 2048))[:-1])]
        assert sorted(expected) == sorted((r["doc_tokens"], r["length"], zlib.crc32(r["ids"])) for r in by_doc.pop(doc_id))
    assert not by_doc


def test_packing(spark, docs, odd, empty):
    for frame in (docs, odd):
        check_pieces([r.asDict() for r in packing.pack(frame, WORDS).collect()], [(r.doc_id, r.text) for r in frame.collect()])
    assert packing.pack(empty, WORDS).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, WORDS, longest=1000)


def test_a_packing_task_sends_a_few_megabytes_at_once(spark, monkeypatch):
    class Rows:
        def mapInArrow(self, cut, schema):
            self.cut = cut
            return self

        def withColumn(self, *column):
            return self

    monkeypatch.setattr(packing, "id_and_text", lambda *_: Rows())
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["a b c d " * 400_000, "e f"]})
    out = list(packing.pack(None, WORDS).cut(iter([batch])))
    assert max(b.nbytes for b in out) < 3 << 20
    rows = [r for b in out for r in b.to_pylist()]
    assert b"".join(r["ids"] for r in rows if r["doc_id"] == 1) == np.array(whole("a b c d", 0)[:-1] * 400_000 + [1], dtype="<u4").tobytes()
    assert [r["doc_tokens"] for r in rows if r["doc_id"] == 2][0] == len(whole("e f", 1))


@given(st.integers(1, 100_000), st.integers(0, 14))
def test_binary_lengths(total, power):
    longest = 1 << power
    lengths = packing.binary_lengths(total, longest)
    assert sum(lengths) == total and lengths == sorted(lengths, reverse=True) and max(lengths) <= longest
    assert len([n for n in lengths if n < longest]) == len({n for n in lengths if n < longest})


def test_buckets_hold_equal_lengths(spark, docs, tmp_path):
    pieces = packing.pack(docs, WORDS)
    packing.write_buckets(pieces, str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.filter("bucket <> length or octet_length(ids) <> 4 * length").count() == 0
    assert back.count() == pieces.count()


def test_packing_query(spark, docs):
    rows = QUERIES["op1_packing"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for doc_id, pieces in grouped((r.doc_id, r) for r in rows).items():
        ids = whole(texts.pop(doc_id), 1)
        at = 0
        for p in sorted(pieces, key=lambda r: r.start):
            assert (p.start, p.ids_crc32, p.doc_tokens) == (at, crc(ids[at : at + p.length]), len(ids))
            at += p.length
        assert at == len(ids)
    assert not texts


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("block", [8, 1000])
def test_planes_round_trip(kind, block):
    rng = np.random.default_rng(3)
    ids = [rng.integers(0, 1 << 32, n, dtype=np.uint32) for n in (5, 0, 2000, 1, 8)]
    out = io.BytesIO()
    writer = bitplanes.PlaneWriter(out, block, kind)
    for doc_id, x in zip((None, 3, 3, 9, 1 << 62), ids, strict=True):
        writer.add(doc_id, x)
    writer.close()
    back = list(bitplanes.read_planes(io.BytesIO(out.getvalue())))
    assert [d for d, _, _ in back] == [None, 3, 3, 9, 1 << 62]
    assert [s for _, s, _ in back] == [0, 5, 5, 2005, 2006]
    assert all(np.array_equal(x, y) for x, (_, _, y) in zip(ids, back, strict=True))


def test_id_files(spark, docs, odd, empty, tmp_path):
    for n, frame in enumerate((docs, odd)):
        manifest = bitplanes.write_ids(frame, WORDS, str(tmp_path / str(n)), block=500, kind="bit" if n else "byte")
        rows = sorted(bitplanes.read_ids(manifest).collect(), key=lambda r: r.start)
        expected = sorted((r.doc_id is not None, r.doc_id or 0) for r in frame.collect())
        assert [(r.doc_id is not None, r.doc_id or 0) for r in rows] == expected
        assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1].tolist()]
        texts = grouped((r.doc_id, crc(whole(r.text, 2))) for r in frame.collect())
        for doc_id, found in grouped((r.doc_id, zlib.crc32(r.ids)) for r in rows).items():
            assert sorted(found) == sorted(texts[doc_id])
    assert bitplanes.read_ids(bitplanes.write_ids(empty, WORDS, str(tmp_path / "none"))).count() == 0


def test_rows_of_one_id_go_over_several_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(7, "one text")] * 600 + [(None, f"t {i}") for i in range(300)] + [(i, "x") for i in range(20)]
        manifest = bitplanes.write_ids(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), WORDS, str(tmp_path / "hot"))
        files = manifest.collect()
        assert sum(r.first_doc == 7 or r.last_doc == 7 for r in files) > 2 and sum(r.first_doc is None for r in files) > 1
        got = sorted(bitplanes.read_ids(manifest).collect(), key=lambda r: r.start)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.doc_id is None for r in got] == [True] * 300 + [False] * 620
    assert [r.doc_id for r in got[300:]] == sorted(r.doc_id for r in got[300:])
    starts = np.cumsum([0, *(r.n_tokens for r in got)])
    assert [r.start for r in got] == starts[:-1].tolist()


def test_id_file_query(spark, docs):
    before = 0
    rows = {r.doc_id: r for r in QUERIES["op2_bit_planes"](spark, SF).collect()}
    for r in sorted(docs.collect()):
        ids = whole(r.text, 2)
        assert (rows[r.doc_id].start, rows[r.doc_id].n_tokens, rows[r.doc_id].ids_crc32) == (before, len(ids), crc(ids))
        before += len(ids)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTES, "rb"))}  # noqa: SIM115
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.lists(ODD_TEXT | st.text(max_size=40), max_size=5))
def test_byte_bpe_as_the_library(library, texts):
    own = bytebpe.codec(BYTES, public_tokenizers.PATTERN)
    ids = own.encode(texts)
    assert [x.tolist() for x in ids] == [library.encode_ordinary(t) for t in texts]
    assert own.decode(ids) == [t.encode() for t in texts]


def test_long_words(library):
    rng = np.random.default_rng(5)
    texts = ["a" * 5000, "ab" * 700 + "a", " " * 900 + "x", "\n" * 400, "é" * 400, "".join(rng.choice(list("abcdefgh"), 1500)), "=" * 1001]
    own = bytebpe.codec(BYTES, public_tokenizers.PATTERN)
    assert [x.tolist() for x in own.encode(texts)] == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "ab", "aáé", "the quick", "0123456789abcdef", "=-"])
def test_words_of_100_000_letters(library, letters):
    rng = np.random.default_rng(len(letters))
    texts = ["".join(rng.choice(list(letters.replace(" ", "")), n)) for n in (100_000, 3_001, 257)]
    own = bytebpe.ByteBpe(BYTES, public_tokenizers.PATTERN)
    start = time.process_time()
    ids = own.encode(texts)
    assert time.process_time() - start < 30
    assert [x.tolist() for x in ids] == [library.encode_ordinary(t) for t in texts]
    assert own.decode(ids) == [t.encode() for t in texts]


@pytest.mark.parametrize("period", ["a", "ab", "abc", "aab", "xyzzy", "=", "= ", "é", "ha", "123"])
def test_long_periods(library, period):
    own = bytebpe.codec(BYTES, public_tokenizers.PATTERN)
    texts = [(period * 1500)[:n].replace(" ", "") for n in (300, 1001, 1500)]
    assert [x.tolist() for x in own.encode(texts)] == [library.encode_ordinary(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from(list("abcdeinorst")), min_size=257, max_size=700))
def test_cuts_of_long_words_do_not_show(library, word):
    assert bytebpe.codec(BYTES, public_tokenizers.PATTERN).encode([word])[0].tolist() == library.encode_ordinary(word)


def test_decoding_reads_the_ids_of_documents(spark, monkeypatch):
    """Ids that are wrong decode to other bytes."""
    own = bytebpe.ByteBpe(BYTES, public_tokenizers.PATTERN)
    ids = own.encode(["some words"])[0]
    assert own.decode([ids, ids[::-1]])[1] != b"some words"


def test_byte_bpe_frames(spark, docs, odd, empty, library):
    for frame in (docs, odd):
        encoded = bytebpe.encode(frame, BYTES, public_tokenizers.PATTERN)
        rows = grouped((r.doc_id, (r.n_tokens, bytes(r.ids))) for r in encoded.collect())
        back = grouped((r.doc_id, bytes(r.decoded)) for r in bytebpe.decode(encoded, BYTES, public_tokenizers.PATTERN).collect())
        for doc_id, texts in grouped((r.doc_id, r.text or "") for r in frame.collect()).items():
            ids = [library.encode_ordinary(t) for t in texts]
            assert sorted(rows[doc_id]) == sorted((len(x), np.array(x, dtype="<u4").tobytes()) for x in ids)
            assert sorted(back[doc_id]) == sorted(t.encode() for t in texts)
    assert bytebpe.round_trip(empty, BYTES, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(Exception, match="not in the vocabulary"):
        bytebpe.codec(BYTES, public_tokenizers.PATTERN).decode([np.array([1, 60_000], dtype=np.uint32)])


def test_byte_bpe_query(spark, docs, library):
    rows = {r.doc_id: r for r in QUERIES["op3_byte_bpe"](spark, SF).collect()}
    for r in docs.collect():
        ids = library.encode_ordinary(r.text)
        got = rows[r.doc_id]
        assert (got.n_tokens, got.ids_sha256, got.decoded_sha256) == (len(ids), sha256(np.array(ids, dtype="<u4").tobytes()), sha256(r.text.encode()))
