"""Words of a stream of texts as bytes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from fleetmart.llm.hashing import buffers

#: Bytes looked at together, unless a single word is longer.
CHUNK = 4 << 20
#: Fixed value: a byte that no UTF-8 text holds ends each text.
END = 0xFF


def byte_classes(spaces: bytes, breaks: bytes) -> np.ndarray:
    """0 for bytes of words, 1 for those between words, 2 for those between pieces."""
    classes = np.zeros(256, dtype=np.uint8)
    classes[END] = 2
    classes[list(spaces)] = 1
    classes[list(breaks)] = 2
    return classes


_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


class WordStream:
    """Texts go in one after the other, each followed by a break; chunks of words come out.

    A chunk is a binary Arrow array of words with A-Z lower-cased, and for each word the number of
    breaks between the word before it and itself. Texts are cut between words only.
    """

    def __init__(self, classes: np.ndarray):
        self.classes, self.parts, self.size, self.breaks = classes, [], 0, 1

    def feed(self, text: memoryview) -> Iterator[tuple[pa.Array, np.ndarray]]:
        for at in range(0, len(text), CHUNK):
            self.parts.append(bytes(text[at : at + CHUNK]))  # a view would keep its whole batch
            self.size += len(self.parts[-1])
            if self.size >= CHUNK:
                yield from self._cut(False)
        self.parts.append(bytes([END]))
        self.size += 1

    def close(self) -> Iterator[tuple[pa.Array, np.ndarray]]:
        yield from self._cut(True)

    def _cut(self, last: bool) -> Iterator[tuple[pa.Array, np.ndarray]]:
        data = np.frombuffer(b"".join(self.parts), dtype=np.uint8)
        kind = self.classes[data]
        end = len(data)
        if not last:
            back = np.flatnonzero(kind[::-1][:65536]) if len(kind) > 65536 else np.empty(0, dtype=np.int64)
            back = back if len(back) else np.flatnonzero(kind[::-1])
            if not len(back):
                self.parts = [data.tobytes()]
                return
            end = len(data) - int(back[0])
        self.parts, self.size = [data[end:].tobytes()], len(data) - end
        kind = kind[:end]
        inside = kind == 0
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        starts = np.flatnonzero(starts)
        seen = np.cumsum(kind == 2, dtype=np.int64)
        total = int(seen[-1]) if end else 0
        if not len(starts):
            self.breaks += total
            return
        at = seen[starts]
        before = np.diff(at, prepend=-self.breaks)
        self.breaks = total - int(at[-1])
        lengths = np.add.reduceat(inside, starts, dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        kept = _lower[data[:end][inside]]
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
        yield words, before


def rows_of(column: pa.Array) -> Iterator[memoryview]:
    """The bytes of each value of a text column without nulls."""
    data, ends = buffers(column)
    view = memoryview(data)
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        yield view[a:b]


def numbered(chunks: list[pa.Array]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each word, and the distinct words: their bytes on end and where each begins."""
    whole = pa.concat_arrays(chunks).dictionary_encode()
    distinct = whole.dictionary
    data, ends = buffers(distinct)
    return whole.indices.to_numpy(), data, ends
