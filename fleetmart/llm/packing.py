"""Packing by power-of-two decomposition: each document is cut into pieces whose lengths are
powers of two, a piece is a sequence of its own, and sequences of equal length share a bucket.
Hence no sequence crosses documents and none is padded.

A document's ids are those of its whole text followed by ``end_id``. Null text counts as empty
and yields one piece, the end id. Null, repeated and extreme ``doc_id`` are carried along: each
input row is a document of its own. An empty table gives an empty table; further columns of the
input are left out. Nothing is shuffled: a task cuts the documents of its own split.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.shared import id_and_text
from fleetmart.llm.wordbpe import encoder

#: Bytes of ids that go back to Spark at once, at most one piece more, and rows.
BYTES_OUT, ROWS_OUT = 2 << 20, 20_000

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long"


def binary_lengths(total: int, longest: int) -> list[int]:
    """Powers of two that add up to ``total``, none above ``longest``, in descending order."""
    rest = total % longest
    bits = [1 << b for b in range(longest.bit_length() - 2, -1, -1) if rest >> b & 1]
    return [longest] * (total // longest) + bits


def pack(docs: DataFrame, vocabulary: str, *, longest: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, ids`` (little-endian unsigned 32-bit),
    ``doc_tokens, sequence_id, offset``. ``longest`` must be a power of two. ``sequence_id`` is
    unique; its sequence consists of this one piece, so ``offset`` is 0 and ``length`` is both
    the sequence's length and its bucket."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for doc_id, ids in own.documents(batch, end_id):
                ids, start = ids.astype("<u4", copy=False), 0
                for length in binary_lengths(len(ids), longest):
                    out.append((doc_id, start, length, ids[start : start + length].tobytes(), len(ids)))
                    start += length
                    held += 4 * length
                    if held >= BYTES_OUT or len(out) >= ROWS_OUT:
                        yield _batch(out)
                        out, held = [], 0
            yield _batch(out)

    pieces = id_and_text(docs, id_col, text_col).mapInArrow(cut, PIECES)
    return pieces.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
    columns = zip(*rows, strict=True) if rows else ([],) * 5
    names = ("doc_id", "start", "length", "ids", "doc_tokens")
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=list(names))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder ``length=...`` per bucket, so a training job draws batches of equal lengths."""
    pieces.withColumn("bucket", F.col("length")).write.partitionBy("bucket").parquet(path)
