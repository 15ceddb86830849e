"""Small helpers for code that runs on Arrow batches inside Spark tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Text bytes that one step of a task works on; bounds a worker's memory whatever the batch size is.
CHUNK_BYTES = 8 << 20


@lru_cache(1)
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return lambda _: 0


def release() -> None:
    """Give free memory back to the system: workers outlive their tasks, and others on the machine need it."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def freed(f):
    """The function of a group (key, rows) or of two (key, left, right), which releases what it has freed whenever it returns."""

    def one(key, rows):
        out = f(key, rows)
        release()
        return out

    def two(key, left, right):
        out = f(key, left, right)
        release()
        return out

    return one if f.__code__.co_argcount == 2 else two


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts hold about ``limit`` bytes at most (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, before + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end
            release()


def texts(column) -> pa.Array:
    """The column as large strings without nulls: a null text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return _packed(pc.fill_null(column.cast(pa.large_string()), ""))


def _parts(column: pa.Array) -> tuple[np.ndarray, bytes | pa.Buffer]:
    """Offsets from 0 on, and the bytes that they speak of."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return at - at[0], data.slice(at[0], at[-1] - at[0]) if data is not None else b""


def _packed(column: pa.Array) -> pa.Array:
    """The same strings in a buffer of their own: some of Arrow's kernels misread one that begins in the middle of another's."""
    if not len(column):
        return pa.array([], pa.large_string())
    at, data = _parts(column)
    return pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(at), pa.py_buffer(data))


def ascii_lower(column: pa.Array) -> pa.Array:
    """Large strings without nulls with A-Z in lower case, and nothing else changed."""
    if not len(column):
        return column
    at, data = _parts(column)
    return pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(at), pa.py_buffer(bytes(data).lower()))


def split_words(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text: offsets of the texts' first words, and all words."""
    lists = pc.ascii_split_whitespace(column)
    words = lists.flatten()
    full = pc.greater(pc.binary_length(words), 0)
    kept = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False).astype(np.int64))))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return kept[offsets - offsets[0]], words.filter(full)


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word; every distinct word is hashed once."""
    coded = words.dictionary_encode()
    distinct = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()), np.uint64, len(coded.dictionary))
    return distinct[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values, so that each bit depends on all."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def rolling(h: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` values; entry i covers values i .. i + size - 1 (documents are not told apart)."""
    if len(h) < size:
        return np.zeros(0, np.uint64)
    n = len(h) - size + 1
    out = np.full(n, np.uint64(seed * 2 + 1))
    for i in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
        out ^= out >> np.uint64(29)
    return mixed(out)


def rolling_at(h: np.ndarray, at: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """The same hashes of the runs that begin at these places alone."""
    out = np.full(len(at), np.uint64(seed * 2 + 1))
    for i in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[at + i]
        out ^= out >> np.uint64(29)
    return mixed(out)
