"""Token ids in files of shuffled planes.

Ids are cut into blocks of a fixed number of ids. A block is transposed into 4 byte planes or 32
bit planes, each plane is one zstandard frame, and an index at the end of the file holds the
frames' sizes and the documents' lengths:

    magic | frames of block 0 | frames of block 1 | ... | index (zstandard) | index size, 8 bytes | magic

Documents lie in ascending order of ``doc_id`` (null first) within and across files. Null text
counts as empty; each document ends with ``end_id``. Rows with equal ids are documents of their
own, in no set order among themselves, and however many they are, they are dealt out over files like
others. An empty table gives no file and an empty result.

A task writes a file under a name of its own and reports it as a row. The rows of finished tasks
form the manifest, a written table, so files of lost attempts are never read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.llm.shared import filesystem, hadoop_uri, id_and_text, spread, unused_name
from fleetmart.llm.wordbpe import encoder
from fleetmart.sinks.scratch import scratch_path

MAGIC = b"IDPLANE1"
PLANES = {"byte": 4, "bit": 32}
MANIFEST = "path string, first_doc long, last_doc long, n_docs long, n_ids long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids binary"


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of a block of unsigned 32-bit ids, the lowest first."""
    rows = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [np.ascontiguousarray(rows[:, k]).tobytes() for k in range(4)]
    bits = np.unpackbits(rows, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    columns = [np.frombuffer(p, dtype=np.uint8) for p in planes]
    if kind == "bit":
        bits = np.stack([np.unpackbits(c, count=n, bitorder="little") for c in columns], axis=1)
        return np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()
    return np.ascontiguousarray(np.stack(columns, axis=1)).view("<u4").ravel()


class PlaneWriter:
    """Writes one file to a binary stream; holds at most one block of ids."""

    def __init__(self, out, block: int = 1 << 16, kind: str = "byte", level: int = 3):
        self.out, self.block, self.kind = out, block, kind
        self.packer = zstandard.ZstdCompressor(level=level)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0
        self.frames: list[int] = []
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        self.out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.block:
            joined = np.concatenate(self.waiting)
            whole = len(joined) // self.block * self.block
            for at in range(0, whole, self.block):
                self._write(joined[at : at + self.block])
            self.waiting, self.n_waiting = [joined[whole:]], len(joined) - whole

    def _write(self, ids: np.ndarray) -> None:
        for plane in to_planes(ids, self.kind):
            frame = self.packer.compress(plane)
            self.frames.append(len(frame))
            self.out.write(frame)

    def close(self) -> None:
        if self.n_waiting:
            self._write(np.concatenate(self.waiting))
        index = struct.pack("<QQQQ", self.block, PLANES[self.kind], len(self.frames), len(self.lengths))
        index += np.array(self.frames, dtype="<u4").tobytes() + np.array(self.lengths, dtype="<u8").tobytes()
        index += np.array([d or 0 for d in self.doc_ids], dtype="<i8").tobytes()
        index += np.array([d is None for d in self.doc_ids], dtype=np.uint8).tobytes()
        packed = self.packer.compress(index)
        self.out.write(packed + struct.pack("<Q", len(packed)) + MAGIC)


def read_planes(file) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """Documents of one file (a seekable stream) with the number of ids before each."""
    size = file.seek(0, 2)
    file.seek(size - 16)
    packed, magic = struct.unpack("<Q8s", file.read(16))
    if magic != MAGIC:
        raise ValueError("not a file of id planes")
    file.seek(size - 16 - packed)
    index = zstandard.ZstdDecompressor().decompress(file.read(packed))
    block, planes, n_frames, n_docs = struct.unpack_from("<QQQQ", index)
    at = 32
    frames = np.frombuffer(index, "<u4", n_frames, at).reshape(-1, planes)
    at += 4 * n_frames
    lengths = np.frombuffer(index, "<u8", n_docs, at).astype(np.int64)
    at += 8 * n_docs
    doc_ids = np.frombuffer(index, "<i8", n_docs, at)
    nulls = np.frombuffer(index, np.uint8, n_docs, at + 8 * n_docs)
    total = int(lengths.sum())
    kind = "byte" if planes == 4 else "bit"
    unpacker = zstandard.ZstdDecompressor()
    file.seek(len(MAGIC))
    held, n_held, b = [], 0, 0
    start = 0
    for doc_id, null, length in zip(doc_ids.tolist(), nulls.tolist(), lengths.tolist(), strict=True):
        while n_held < length:
            n = min(block, total - b * block)
            held.append(from_planes([unpacker.decompress(file.read(int(s))) for s in frames[b]], n, kind))
            n_held, b = n_held + n, b + 1
        joined = np.concatenate(held) if len(held) != 1 else held[0]
        yield (None if null else doc_id), start, joined[:length]
        held, n_held, start = [joined[length:]], n_held - length, start + length


def write_ids(docs: DataFrame, vocabulary: str, folder: str, *, end_id: int = 2, block: int = 1 << 16, kind: str = "byte", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode all documents into files below ``folder`` (any that pyarrow opens) and return the
    manifest: one row per file, ``path, first_doc, last_doc, n_docs, n_ids``. Texts are dealt out by
    ranges of ``doc_id`` before they are encoded, so the shuffle carries texts and no ids. The manifest
    is written by as few tasks as its size asks for, not by each task that has encoded."""
    spark = docs.sparkSession
    folder = hadoop_uri(spark, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, writer, n_ids, path = encoder(vocabulary), None, 0, unused_name(folder, ".planes")
        for batch in batches:
            for doc_id, ids in own.documents(batch, end_id):
                if writer is None:
                    place, inner = filesystem(folder)
                    place.create_dir(inner, recursive=True)
                    writer = PlaneWriter(place.open_output_stream(filesystem(path)[1]), block, kind)
                writer.add(doc_id, ids)
                n_ids += len(ids)
        if writer is not None:
            writer.close()
            writer.out.close()
            row = {"path": path, "first_doc": writer.doc_ids[0], "last_doc": writer.doc_ids[-1], "n_docs": len(writer.lengths), "n_ids": n_ids}
            yield pa.RecordBatch.from_pylist([row], schema=pa.schema([("path", pa.string()), *((c, pa.int64()) for c in list(row)[1:])]))

    # rows of one id, and equal rows, go over several ranges
    numbered = id_and_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    ordered = numbered.repartitionByRange("doc_id", "row").drop("row").sortWithinPartitions("doc_id")
    manifest = f"{folder.rstrip('/')}/manifest"
    ordered.mapInArrow(write, MANIFEST).hint("rebalance").write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def read_ids(manifest: DataFrame) -> DataFrame:
    """All documents of the files: ``doc_id, start`` (ids of all documents before it), ``n_tokens,
    ids`` (little-endian unsigned 32-bit). The sum over files runs on one row per file."""
    order = [F.col(c).asc_nulls_first() for c in ("first_doc", "last_doc")]
    before = F.sum("n_ids").over(Window.orderBy(*order, "path").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("path", F.coalesce(before, F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                place, inner = filesystem(path)
                with place.open_input_file(inner) as file:
                    rows: list[tuple] = []
                    held = 0
                    for doc_id, start, ids in read_planes(file):
                        rows.append((doc_id, base + start, len(ids), ids.astype("<u4").tobytes()))
                        held += len(ids)
                        if held >= 1 << 20:
                            yield _documents(rows)
                            rows, held = [], 0
                    yield _documents(rows)

    return spread(files).mapInArrow(read, DOCUMENTS)


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "start", "n_tokens", "ids"])


def fresh_folder(docs: DataFrame) -> str:
    return scratch_path(docs.sparkSession, "planes")
