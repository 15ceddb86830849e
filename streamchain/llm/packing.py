"""Packing of token sequences into windows: sum-of-squares online bin packing, with cuts."""

from __future__ import annotations

import os
import uuid
import zlib
from functools import lru_cache
from itertools import chain
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .arrow import ascii_lower, chunks, split_words, texts

RESULT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Text bytes of a chunk, words that are encoded at a time, and bytes of words and ids that a worker keeps for the chunks and tasks that follow.
CHUNK_BYTES, ENCODED, KNOWN_BYTES = 8 << 20, 1 << 13, 32 << 20
_TYPES = (pa.int64(),) * 7
_NAMES = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is the only one it may use
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _gather(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``begins``, one after the other."""
    after = np.cumsum(sizes)
    at = np.repeat((begins - (after - sizes)).astype(np.int32), sizes)
    at += np.arange(len(at), dtype=np.int32)
    return flat[at]


def _units(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Each word without the ASCII punctuation at its end, and that: where a letter or digit of ASCII stands before it, the tokenizer cuts there.

    It also puts all in lower case, so ASCII words that differ in case alone become one here.
    Words that might spell a special token, which is matched before that, stay as they are.
    """
    plain = pc.invert(pc.match_substring(words, "<|"))
    words = pc.if_else(plain, ascii_lower(words), words)
    stem = pc.utf8_rtrim(words, characters=punctuation)
    cut = pc.and_(plain, pc.match_substring_regex(stem, "[a-z0-9]$"))
    stem = pc.if_else(cut, stem, words)
    return stem, pc.if_else(cut, pc.replace_substring_regex(words, "^.*[^[:punct:]]", ""), "")


class Known:
    """Texts that were encoded, and their ids: what later chunks have in common with them isn't encoded again. Before it exceeds ``most`` bytes, all is forgotten but the chunk at hand."""

    def __init__(self, most: int = KNOWN_BYTES):
        self.most = most
        self.forget()

    def forget(self) -> None:
        self.units, self.flat, self.sizes = pa.array([], pa.large_string()), np.zeros(0, np.uint32), np.zeros(0, np.int32)

    def encode(self, tokenizer, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids in a row, where those of each of these distinct units begin in them, and how many they are."""
        if self.units.nbytes + self.flat.nbytes + self.sizes.nbytes + units.nbytes > self.most:
            self.forget()
        at = pc.index_in(units, value_set=self.units)
        fresh = units.filter(at.is_null())
        flat, sizes = [self.flat], [self.sizes]
        for k in range(0, len(fresh), ENCODED):
            pieces = [e.ids for e in tokenizer.encode_batch_fast(fresh.slice(k, ENCODED).to_pylist(), add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, pieces), np.int32, len(pieces)))
            flat.append(np.fromiter(chain.from_iterable(pieces), np.uint32, int(sizes[-1].sum())))
        at = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        at[at < 0] = len(self.units) + np.arange(len(fresh))
        self.units, self.flat, self.sizes = pa.concat_arrays([self.units, fresh]), np.concatenate(flat), np.concatenate(sizes)
        sizes = self.sizes.astype(np.int64)
        return self.flat, (np.cumsum(sizes) - sizes)[at], sizes[at]


@lru_cache(1)
def known_to_worker(run: str) -> Known:
    """What a worker's tasks of this run have encoded so far; another run begins anew."""
    return Known()


def encoded(tokenizer, column: pa.Array, end_id: int, known: Known | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, an end id after each; and where each text begins (one entry more than texts).

    The tokenizer never joins characters across ASCII white space, and drops it. So each
    distinct word that isn't known from earlier chunks is encoded once and the ids of a text are
    its words' ids.
    """
    first, words = split_words(column)
    coded = words.dictionary_encode()
    parts = pa.concat_arrays(_units(coded.dictionary)).dictionary_encode()
    flat, begins, sizes = (known or Known()).encode(tokenizer, parts.dictionary)
    # units -> distinct words (a stem and a tail each) -> words -> texts
    unit = parts.indices.to_numpy(zero_copy_only=False).astype(np.int64).reshape(2, -1).T.ravel()
    flat, sizes = _gather(flat, begins[unit], sizes[unit]), sizes[unit].reshape(-1, 2).sum(1)
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ids = _gather(flat, (np.cumsum(sizes) - sizes)[code], sizes[code])
    bounds = np.concatenate(([0], np.cumsum(sizes[code])))[first]
    ids = np.insert(ids, bounds[1:], np.uint32(end_id))
    return ids, bounds + np.arange(len(bounds))


class Packer:
    """The open windows of one task: how many there are at each fill level, and what they hold."""

    def __init__(self, capacity: int, most_open: int, first_id: int):
        self.capacity, self.most_open, self.next_id = capacity, most_open, first_id
        self.level = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list[list]] = {}
        self.count, self.rows = 0, []

    def add(self, doc, ids: np.ndarray) -> None:
        whole = len(ids) - len(ids) % self.capacity
        for start in range(0, whole, self.capacity):
            self._write([(doc, start, ids[start : start + self.capacity], len(ids))])
        rest = ids[whole:]
        if len(rest):
            self._place((doc, whole, rest, len(ids)))

    def _place(self, piece: tuple) -> None:
        """Into the level, or a new window, that leaves the least sum of squared counts of partly filled windows; of equals, the fullest."""
        size, level = len(piece[2]), self.level
        held = np.flatnonzero(level[: self.capacity - size + 1])
        best, change = 0, 2 * level[size] + 1
        if len(held):
            to = held + size
            cost = np.where(to < self.capacity, 2 * level[to] + 1, 0) - 2 * level[held] + 1
            k = len(held) - 1 - int(np.argmin(cost[::-1]))
            if cost[k] <= change:
                best = int(held[k])
        window = self._take(best) if best else []
        window.append(piece)
        self._put(best + size, window)
        if self.count > self.most_open:
            self.drain(everything=False)

    def _take(self, fill: int) -> list:
        self.level[fill] -= 1
        self.count -= 1
        return self.open[fill].pop()

    def _put(self, fill: int, window: list) -> None:
        if fill == self.capacity:
            self._write(window)
        else:
            self.level[fill] += 1
            self.count += 1
            self.open.setdefault(fill, []).append(window)

    def drain(self, everything: bool = True) -> None:
        """Cut the emptiest windows up to fill the fullest, until one partly filled window is left at most."""
        left = sorted(((fill, k) for fill, held in self.open.items() for k in range(len(held))), reverse=True)
        windows = [(fill, self.open[fill][k]) for fill, k in left]
        self.level[:], self.open, self.count = 0, {}, 0
        top, low = 0, len(windows) - 1
        while top < low:
            fill, window = windows[top]
            top += 1
            while fill < self.capacity and top <= low:
                have, donor = windows[low]
                doc, start, ids, n = donor.pop()
                room = self.capacity - fill
                if len(ids) > room:
                    donor.append((doc, start, ids[:-room], n))
                    start, ids = start + len(ids) - room, ids[-room:]
                window.append((doc, start, ids, n))
                fill += len(ids)
                windows[low] = (have - len(ids), donor)
                if not donor:
                    low -= 1
            if fill == self.capacity:
                self._write(window)
            else:
                self._put(fill, window)
        if top == low:
            self._put(*windows[top])
        if everything:
            for held in self.open.values():
                for window in held:
                    self._write(window)
            self.level[:], self.open, self.count = 0, {}, 0

    def _write(self, window: list) -> None:
        offset = 0
        for doc, start, ids, n in window:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), n, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def take_rows(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = zip(*rows, strict=True) if rows else [[]] * len(_NAMES)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], list(_NAMES))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1, most_open: int = 2048) -> DataFrame:
    """Pieces of the documents and their places in windows of ``capacity`` tokens.

    docs: doc_id, text. A null or empty text is the end id alone. Repeated rows are packed as
    often as they occur; a null doc_id stays null; an empty table gives no rows. Other columns
    are not read.

    Each task packs the rows of its partition, so nothing is shuffled. A text that exceeds a
    window fills whole windows first; its rest, and every shorter text, goes to the fill level
    of least squared counts. A task keeps ``most_open`` partly filled windows at most and then,
    and at its end, cuts the emptiest up to fill the fullest: one window with padding is left a
    task. Window ids hold the partition's number in their upper bits.
    """

    this = uuid.uuid4().hex

    def run(batches):
        tokenizer = load_tokenizer(tokenizer_path)
        known = known_to_worker(this)
        packer = Packer(capacity, most_open, TaskContext.get().partitionId() << 32)
        for batch in chunks(batches, limit=CHUNK_BYTES):
            ids, at = encoded(tokenizer, texts(batch.column("text")), end_id, known)
            for k, doc in enumerate(batch.column("doc_id").to_pylist()):
                packer.add(doc, ids[at[k] : at[k + 1]].copy())
            yield packer.take_rows()
        packer.drain()
        yield packer.take_rows()

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, RESULT)
