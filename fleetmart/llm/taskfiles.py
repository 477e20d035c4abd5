"""Arrays that a task leaves in a file of its own for later tasks.

What later stages need by the piece (a shard's tokens, an index) is written once below the shared
folder and opened by whichever task works on that piece, instead of being sent through every
shuffle. A file is named by the attempt that wrote it and becomes known by the row which that
attempt returns, so files of lost or repeated attempts are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from fleetmart.llm.shared import filesystem, hadoop_uri, unused_name
from fleetmart.sinks.scratch import scratch_path

#: Tasks that a list of files is dealt out to at most.
MOST_TASKS = 20_000


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder that exists, as tasks open it."""
    path = scratch_path(spark, name)
    spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(
        spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    )
    return hadoop_uri(spark, path)


def save(folder: str, **arrays: np.ndarray) -> str:
    """Write arrays of one dimension; returns the file's name."""
    fs, path = filesystem(folder)
    name = unused_name(path, ".arrow")
    columns = [pa.LargeListArray.from_arrays(pa.array([0, len(a)], pa.int64()), pa.array(a)) for a in arrays.values()]
    batch = pa.RecordBatch.from_arrays(columns, names=list(arrays))
    with fs.open_output_stream(name) as out, pa.ipc.new_file(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as file:
        file.write_batch(batch)
    return name.rsplit("/", 1)[1]


def load(folder: str, name: str, *columns: str) -> list[np.ndarray]:
    """These arrays of a file."""
    fs, path = filesystem(folder)
    with fs.open_input_file(f"{path.rstrip('/')}/{name}") as source:
        schema = pa.ipc.open_file(source).schema
        places = sorted(schema.get_field_index(c) for c in columns)
        batch = pa.ipc.open_file(source, options=pa.ipc.IpcReadOptions(included_fields=places)).get_batch(0)
    return [batch.column(c).values.to_numpy() for c in columns]


def tasks_for(pieces: int) -> int:
    return max(1, min(pieces, MOST_TASKS))


def each_piece(rows: DataFrame, key: str, order: str, tasks: int, work: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``work`` on the rows of every value of ``key``, ordered by ``order``. A piece's rows must be
    bounded; a task holds one piece and an Arrow batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            ids = batch.column(key).to_numpy()
            cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if held and held[0].column(key)[0].as_py() != ids[a]:
                    yield from work(pa.Table.from_batches(held).combine_chunks())
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield from work(pa.Table.from_batches(held).combine_chunks())

    return rows.repartition(tasks, key).sortWithinPartitions(key, order).mapInArrow(run, schema)


def pack(values: np.ndarray) -> bytes:
    """Numbers as planes of their bytes, compressed."""
    values = np.ascontiguousarray(values)
    return zstandard.compress(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes(), 3)


def unpack(data: bytes, kind=np.int64) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), dtype=np.uint8)
    size = np.dtype(kind).itemsize
    return np.array(raw.reshape(size, -1).T, order="C").view(kind).reshape(-1)


def packed(values: np.ndarray) -> np.ndarray:
    """Packed numbers as an array that a file takes."""
    return np.frombuffer(pack(values), dtype=np.uint8)


def steps_of(u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted pairs as steps: of the first, and of the second where the first stays."""
    du, dw = np.diff(u, prepend=0), np.diff(w, prepend=0)
    return du, np.where(du != 0, w, dw)


def from_steps(du: np.ndarray, dw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    new = du != 0
    new[:1] = True
    run = np.cumsum(dw)
    start = np.flatnonzero(new)
    return np.cumsum(du), run - np.repeat(run[start] - dw[start], np.diff(np.append(start, len(du))))


def groups_of(number: np.ndarray, most: int) -> list[tuple[int, np.ndarray]]:
    """The places of each of the numbers below ``most`` that occurs, in order."""
    order = np.argsort(number, kind="stable")
    edges = np.searchsorted(number[order], np.arange(most + 1))
    return [(i, order[edges[i] : edges[i + 1]]) for i in np.flatnonzero(np.diff(edges)).tolist()]


def batch_of(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})


def nulls(n: int, kind: pa.DataType) -> pa.Array:
    return pa.nulls(n, kind)
