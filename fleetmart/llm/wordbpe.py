"""Ids of a word-level BPE tokenizer, with the merges of each distinct word looked up once.

The vocabulary drops white space and marks word ends, hence a text's ids are those of its
white-space separated words in a row. A batch of texts is split and its distinct words are found
by Arrow; their ids are kept in a bounded table of a worker process, from which words met once
go when it is full. Words of ASCII and Latin-1 letters go straight to the library's BPE model, all
others through its whole normalizer and splitter.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from fleetmart.llm.shared import process_cache

#: Words kept per worker process before those met in one batch only are given up.
KEPT_WORDS = 200_000
#: Pieces of words (letters, digits, signs) kept per worker process before they are started anew.
KEPT_PARTS = 60_000
#: Longer words (in bytes) are encoded but not kept.
KEPT_BYTES = 64
#: Text that is encoded at once, at most one document more.
BYTES_AT_ONCE = 2 << 20
#: Characters on which NFC is the identity and lower case is one character for one.
PLAIN = "\x21-\x7eÀ-ÖØ-öø-ÿ"
LETTERS = "a-zß-öø-ÿ"
#: The contractions that the vocabulary's splitter cuts off (fixed values).
SUFFIXES = "'s|'t|'re|'ve|'m|'ll|'d"


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        plain = [chr(c) for c in range(0x21, 0x100) if re.match(f"[{PLAIN}]", chr(c))]
        self.bytes_as_letters = {ord(c): split(c)[0][0] for c in plain}
        self.plain = re.compile(f"[{PLAIN}]{{0,{KEPT_BYTES}}}").fullmatch
        self.pieces = re.compile(f"{SUFFIXES}|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+").findall
        self._clear()

    def _clear(self) -> None:
        self.words: dict[str, int] = {}
        self.parts: dict[str, tuple[int, ...]] = {}
        self.flat = np.empty(0, dtype=np.uint32)
        self.starts = np.zeros(1, dtype=np.int64)
        self.again = np.empty(0, dtype=bool)

    def _numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.words.get, words, repeat(-1)), dtype=np.int64, count=len(words))

    def _make_room(self) -> None:
        """Only words that a later batch held too stay, half a table at most."""
        stay = np.flatnonzero(self.again)[: KEPT_WORDS // 2]
        sizes = np.diff(self.starts)[stay]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        self.flat = self.flat[np.repeat(self.starts[stay] - ends[:-1], sizes) + np.arange(ends[-1])]
        words = list(self.words)
        self.words = {words[i]: k for k, i in enumerate(stay.tolist())}
        self.starts, self.again = ends, np.zeros(len(stay), dtype=bool)

    def _word_ids(self, word: str) -> list[int] | tuple[int, ...]:
        if word.isalpha() and word.isascii() and len(word) <= KEPT_BYTES:  # one piece, kept as a word
            word = word.lower()
            return self.parts.get(word) or [t.id for t in self.model.tokenize(word)]
        if not self.plain(word) or ("<|" in word and any(s in word for s in self.specials)):
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        ids: tuple[int, ...] = ()
        for piece in self.pieces(word.lower()):
            known = self.parts.get(piece)
            if known is None:
                known = tuple([t.id for t in self.model.tokenize(piece.translate(self.bytes_as_letters))])
                if len(self.parts) >= KEPT_PARTS:
                    self.parts.clear()
                self.parts[piece] = known
            ids += known
        return ids

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and each text's place: text ``i`` has the ids
        from ``ends[i]`` to ``ends[i + 1]``."""
        simple = pc.and_(pc.string_is_ascii(texts), pc.invert(pc.match_substring(texts, "<|")))
        split = pc.ascii_split_whitespace(pc.if_else(simple, pc.ascii_lower(texts), texts))
        coded = split.flatten().dictionary_encode()
        words, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        short = pc.binary_length(coded.dictionary).to_numpy() <= KEPT_BYTES
        numbers = self._numbers(words)
        self.again[numbers[numbers >= 0]] = True
        if len(self.words) + int((short & (numbers < 0)).sum()) > KEPT_WORDS:
            self._make_room()
            numbers = self._numbers(words)
        new = np.flatnonzero(short & (numbers < 0))
        room = len(self.words) + len(new)
        new = np.concatenate([new, np.flatnonzero(~short)])
        numbers[new] = len(self.words) + np.arange(len(new))
        unknown = [words[i] for i in new.tolist()]
        found, upto = array("I"), []
        for word in unknown:
            found.extend(self._word_ids(word))
            upto.append(len(found))
        flat = np.concatenate([self.flat, np.array(found, dtype=np.uint32)])
        starts = np.concatenate([self.starts, self.starts[-1] + np.array(upto, dtype=np.int64)])
        if room <= KEPT_WORDS:
            self.words.update(zip(unknown, range(len(self.words), room), strict=False))  # without the long ones
            self.starts = starts[: room + 1].copy()
            self.flat = flat[: starts[room]].copy()
            self.again = np.concatenate([self.again, np.zeros(room - len(self.again), dtype=bool)])
        begin = starts[numbers][at]
        sizes = np.diff(starts)[numbers][at]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = flat[np.repeat(begin - ends[:-1], sizes) + np.arange(ends[-1])]
        offsets = split.offsets.to_numpy()
        return ids, ends[offsets - offsets[0]]

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text, as an array of unsigned 32-bit integers."""
        return self.encode_array(pa.array([text], pa.string()))[0]

    def documents(self, batch: pa.RecordBatch, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> Iterator[tuple[int | None, np.ndarray]]:
        """Each document of a batch with its ids and ``end_id`` after them."""
        doc_ids, texts = batch.column(id_col).to_pylist(), batch.column(text_col)
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(doc_ids):
            upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BYTES_AT_ONCE)))
            ids, ends = self.encode_array(texts.slice(at, upto - at))
            for doc_id, start, end in zip(doc_ids[at:upto], ends[:-1], ends[1:], strict=True):
                yield doc_id, np.append(ids[start:end], np.uint32(end_id))
            at = upto


def encoder(path: str) -> WordEncoder:
    """The encoder of this process for a vocabulary file."""
    return process_cache(("words", path), lambda: WordEncoder(path))
