from __future__ import annotations

import base64
import hashlib
import io
import random
import struct
from collections import Counter

import pytest
import zstandard

from fleetmart.llm import warc
from fleetmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DATE = "2026-01-01T00:00:00Z"


def expected(rows, least=0):
    """By (page_id, html): what the archive must tell, ids being unique or null."""
    first = {}
    for page_id, html in rows:
        payload = (html or "").encode()
        if page_id is not None and len(payload) >= least:
            first[payload] = min(first.get(payload, page_id), page_id)
    out = []
    for page_id, html in rows:
        payload = (html or "").encode()
        target = first.get(payload) if len(payload) >= least else None
        revisit = target is not None and target != page_id
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page_id, len(payload), digest, "revisit" if revisit else "response", target if revisit else None))
    return Counter(out)


def test_query(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert Counter(tuple(r) for r in QUERIES["op8_warc"](spark, SF).collect()) == expected([(p.page_id, p.html) for p in pages])


@pytest.mark.parametrize("least", [0, 5])
def test_odd_pages(spark, tmp_path, least):
    rows = [(None, "u", "same payload"), (3, None, "same payload"), (1, "a\r\nb", "same payload"), (2, "u", None), (4, "u", ""), (5, "u", "abc"), (6, "u", "abc"), (7, "u", "é" * 70_000), (None, None, "x\r\n\r\ny"), (8, "u", "x\r\n\r\ny")]
    frame = spark.createDataFrame([(*r, "e", 1) for r in rows], "page_id long, url string, html string, digest string, first_page int").repartition(2)
    manifest = warc.write_archives(frame, str(tmp_path / "w"), DATE, min_payload=least)
    assert Counter(tuple(r) for r in warc.read_archives(manifest).collect()) == expected([(r[0], r[2]) for r in rows], least)
    none = warc.write_archives(frame.limit(0), str(tmp_path / "none"), DATE)
    assert warc.read_archives(none).count() == 0


def test_repeated_rows_of_a_response_are_responses(spark, tmp_path):
    rows = [(1, "u", "same")] * 3 + [(2, "u", "same")] * 2 + [(1, "u", "other"), (None, "u", "other"), (None, "u", "alone"), (None, "u", "alone")]
    manifest = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), str(tmp_path / "w"), DATE)
    got = Counter(tuple(r) for r in warc.read_archives(manifest).collect())
    assert got == expected([(r[0], r[2]) for r in rows])
    assert Counter(r[3] for r in got.elements()) == {"response": 6, "revisit": 3}


def test_file_layout():
    rng = random.Random(1)
    words = [f"<p>word{i}</p>" for i in range(300)]
    bodies = ["".join(rng.choices(words, k=150)).encode() for _ in range(200)]
    out = io.BytesIO()
    writer = warc.ArchiveWriter(out, 4096, 100_000, 3)
    for k, body in enumerate(bodies):
        writer.add(warc.record(k, "http://x/", body, None, DATE))
    writer.close()
    data = out.getvalue()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and 0 < size <= 4096
    assert zstandard.ZstdCompressionDict(data[8 : 8 + size]).dict_id() != 0
    back = [warc.parsed(r) for r in warc.records(io.BytesIO(data))]
    assert [payload for _, payload in back] == bodies
    assert [headers["WARC-Record-ID"] for headers, _ in back] == [f"<urn:x-page:{k}>" for k in range(200)]
    alone = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size])).decompress(data[8 + size :])
    assert alone == warc.record(0, "http://x/", bodies[0], None, DATE)  # a frame holds one record
    assert len(data) < sum(len(zstandard.compress(warc.record(k, "http://x/", b, None, DATE))) for k, b in enumerate(bodies))
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(data[:-5])))
    with pytest.raises(ValueError):
        warc.parsed(warc.record(1, None, b"abc", None, DATE).replace(b"abc", b"abd"))


def test_few_records_go_without_a_dictionary():
    out = io.BytesIO()
    writer = warc.ArchiveWriter(out, 4096, 100_000, 3)
    writer.add(warc.record(None, None, b"", 4, DATE))
    writer.close()
    (data,) = warc.records(io.BytesIO(out.getvalue()))
    headers, payload = warc.parsed(data)
    assert (headers["WARC-Type"], headers["WARC-Refers-To"], payload) == ("revisit", "<urn:x-page:4>", b"")
