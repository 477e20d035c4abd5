"""Archives of pages: WARC 1.1 records, each a zstandard frame of its own, compressed with a
dictionary that is trained on the file's first records and lies in a leading skippable frame.

Payload is the html in UTF-8 (null: empty). Of pages with equal payloads of at least
``min_payload`` bytes the one with the smallest ``page_id`` is a response and the others are
revisits that refer to it; smaller payloads are all responses. A page without id comes after
those with one: it is a revisit if its payload has a page with an id, else a response. Rows that
repeat the response's id and payload are responses too. Null urls leave out the target header,
line breaks in urls become spaces. An empty table gives no file and an empty result; further
columns of the input are left out.

The first page of each repeated payload is found on digests alone; a payload that a third of all
pages share is a join key which adaptive execution splits. Tasks write files under names of their
own and report them in the manifest, a written table, so files of lost attempts are never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.shared import filesystem, hadoop_uri, spread, unused_name, written

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

MANIFEST = "path string, n_records long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
CHUNK = 1 << 18


def with_first_page(pages: DataFrame, min_payload: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Columns ``page_id, url, html, first_page``: the last is null but for revisits."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("html"),
    ).withColumn("digest", F.sha1("html"))
    repeated = (
        rows.filter(F.octet_length("html") >= min_payload)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and first_page is not null")
        .drop("n")
    )
    joined = rows.join(written(repeated, "repeated"), "digest", "left")
    return joined.select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("first_page")), F.col("first_page")).alias("first_page"))


def record(page_id: int | None, url: str | None, payload: bytes, first_page: int | None, date: str) -> bytes:
    """One record; a revisit has no payload, but its headers tell the payload's size and digest."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = HTTP_HEAD if first_page is not None else HTTP_HEAD + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first_page is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url))
    if first_page is not None:
        head += [f"WARC-Refers-To: <urn:x-page:{first_page}>", f"WARC-Profile: {REVISIT}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record; fails on a payload that isn't what its digest says."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    if headers["WARC-Type"] == "response":
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if headers["WARC-Payload-Digest"] != f"sha1:{digest}":
            raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    return headers, payload


class ArchiveWriter:
    """Holds records until they suffice to train the dictionary, then writes each as it comes."""

    def __init__(self, out, dictionary_bytes: int, training_bytes: int, level: int):
        self.out, self.dictionary_bytes, self.training_bytes, self.level = out, dictionary_bytes, training_bytes, level
        self.held: list[bytes] = []
        self.n_held = self.n_records = 0
        self.packer = None

    def add(self, data: bytes) -> None:
        self.n_records += 1
        if self.packer is not None:
            self.out.write(self.packer.compress(data))
            return
        self.held.append(data)
        self.n_held += len(data)
        if self.n_held >= self.training_bytes:
            self._start()

    def _start(self) -> None:
        # A few very long records would fill the samples: each gives its share at most.
        share = max(1024, 2 * self.training_bytes // max(1, len(self.held)))
        samples = [s for r in self.held for s in [r[i : i + 4096] for i in range(0, min(len(r), share), 4096)] if len(s) >= 8]
        dictionary = None
        try:
            dictionary = zstandard.train_dictionary(min(self.dictionary_bytes, max(256, self.n_held // 8)), samples, d=8, k=256, steps=1)
        except zstandard.ZstdError:  # too little text to train on
            self.packer = zstandard.ZstdCompressor(level=self.level)
        if dictionary is not None:
            raw = dictionary.as_bytes()
            self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw)
            dictionary.precompute_compress(level=self.level)
            self.packer = zstandard.ZstdCompressor(level=self.level, dict_data=dictionary)
        for data in self.held:
            self.out.write(self.packer.compress(data))
        self.held = []

    def close(self) -> None:
        if self.packer is None:
            self._start()


def records(file) -> Iterator[bytes]:
    """The records of an archive (a binary stream), one frame at a time."""
    head = file.read(8)
    unpacker = zstandard.ZstdDecompressor()
    if len(head) == 8 and struct.unpack("<II", head)[0] == DICTIONARY_FRAME:
        raw = file.read(struct.unpack("<II", head)[1])
        unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
        head = b""
    rest = head
    while rest or (rest := file.read(CHUNK)):
        frame = unpacker.decompressobj()
        parts = [frame.decompress(rest)]
        while not frame.eof:
            more = file.read(CHUNK)
            if not more:
                raise ValueError("the archive ends within a record")
            parts.append(frame.decompress(more))
        rest = frame.unused_data
        yield b"".join(parts)


def write_archives(pages: DataFrame, folder: str, date: str, *, min_payload: int = 0, dictionary_bytes: int = 32 << 10, training_bytes: int = 1 << 20, level: int = 3, **columns: str) -> DataFrame:
    """Write all pages below ``folder`` and return the manifest: ``path, n_records`` per file.
    ``training_bytes`` bounds what a file's dictionary is trained on; all records are written.
    ``columns``: names as ``with_first_page`` takes them."""
    spark = pages.sparkSession
    folder = hadoop_uri(spark, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, path = None, unused_name(folder, ".warc.zst")
        for batch in batches:
            for page_id, url, html, first_page in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "first_page")), strict=True):
                if writer is None:
                    place, inner = filesystem(folder)
                    place.create_dir(inner, recursive=True)
                    writer = ArchiveWriter(place.open_output_stream(filesystem(path)[1]), dictionary_bytes, training_bytes, level)
                writer.add(record(page_id, url, html, first_page, date))
        if writer is not None:
            writer.close()
            writer.out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "n_records": pa.array([writer.n_records], pa.int64())})

    manifest = f"{folder.rstrip('/')}/manifest"
    with_first_page(pages, min_payload, **columns).mapInArrow(write, MANIFEST).write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def _page(urn: str | None) -> int | None:
    number = urn.removeprefix("<urn:x-page:").removesuffix(">") if urn else ""
    return int(number) if number else None


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row per record of all archives, as its headers and its checked payload tell."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                place, inner = filesystem(path)
                with place.open_input_stream(inner) as file:
                    rows: list[tuple] = []
                    for data in records(file):
                        headers, _ = parsed(data)
                        rows.append((_page(headers["WARC-Record-ID"]), int(headers["X-Payload-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"], _page(headers.get("WARC-Refers-To"))))
                        if len(rows) >= 20_000:
                            yield _rows(rows)
                            rows = []
                    yield _rows(rows)

    return spread(manifest.select("path")).mapInArrow(read, RECORDS)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
