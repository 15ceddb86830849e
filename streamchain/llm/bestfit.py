"""Packing of whole documents into few windows: exact complements by tables of length sums, then best fit."""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .arrow import chunks, texts
from .components import cut
from .packing import CHUNK_BYTES, Known, _gather, known_to_worker, load_tokenizer

RESULT = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
#: Bits for a piece's number among those of its length.
_RANK = 44


def spaced(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where each text's stretches begin (one entry more than texts), and the stretches: texts cut before each space that follows a character which is no white space.

    A byte-level tokenizer's pattern matches a space only at the begin of what it matches, so
    none of its matches reaches over such a place.
    """
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    b = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    spaces = np.flatnonzero(b == 0x20)
    spaces = spaces[spaces >= 1]
    last = b[spaces - 1]
    wide = spaces[last >= 0x80]
    good = (last > 0x20) & (last < 0x80)
    if len(wide):
        one, two, three = (b[np.maximum(wide - k, 0)] for k in (1, 2, 3))
        blank = (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
        # what may be white space: U+1680 and U+180E, U+2000 to U+205F, U+3000
        blank |= ((three == 0xE1) & ((two == 0x9A) | (two == 0xA0))) | ((three == 0xE2) & ((two == 0x80) | (two == 0x81))) | ((three == 0xE3) & (two == 0x80))
        good[last >= 0x80] = ~blank
    opens = np.zeros(len(b) + 1, bool)
    opens[spaces[good]] = True
    opens[at] = True
    opens[-1] = False
    begins = np.flatnonzero(opens)
    first = np.searchsorted(begins, at)
    units = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(np.append(begins, len(b))), pa.py_buffer(np.ascontiguousarray(b)))
    return first, units


def _halves(units: pa.Array) -> pa.Array:
    """All stretches without the ASCII punctuation at their end, where a letter or digit of ASCII stands before it, and then those ends: the pattern cuts there."""
    stem = pc.utf8_rtrim(units, characters=punctuation)
    cut_ = pc.and_(pc.invert(pc.match_substring(units, "<|")), pc.match_substring_regex(stem, "[A-Za-z0-9]$"))
    stem = pc.if_else(cut_, stem, units)
    tail = pc.if_else(cut_, pc.replace_substring_regex(units, "(?s)^.*[A-Za-z0-9]", ""), "")
    return pa.concat_arrays([stem, tail])


def encoded(tokenizer, column: pa.Array, end_id: int, known: Known | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row by a byte-level tokenizer, an end id after each; and where each text begins (one entry more than texts). Each distinct stretch that isn't known from earlier chunks is encoded once."""
    first, units = spaced(column)
    coded = units.dictionary_encode()
    parts = _halves(coded.dictionary).dictionary_encode()
    flat, begins, sizes = (known or Known()).encode(tokenizer, parts.dictionary)
    part = parts.indices.to_numpy(zero_copy_only=False).astype(np.int64).reshape(2, -1).T.ravel()
    flat, sizes = _gather(flat, begins[part], sizes[part]), sizes[part].reshape(-1, 2).sum(1)
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ids = _gather(flat, (np.cumsum(sizes) - sizes)[code], sizes[code])
    bounds = np.concatenate(([0], np.cumsum(sizes[code])))[first]
    return np.insert(ids, bounds[1:], np.uint32(end_id)), bounds + np.arange(len(bounds))


class Lengths:
    """How many pieces of each length are left, and of how many pairs of lengths each sum is made."""

    def __init__(self, counts: np.ndarray):
        self.top = len(counts) - 1
        self.left = counts.astype(np.int64)
        self.live = self.left > 0
        self.pairs = np.zeros(self.top + 1, np.int64)
        for a in np.flatnonzero(self.live):
            b = np.flatnonzero(self.live[a + 1 : self.top + 1 - a]) + a + 1
            self.pairs[a + b] += 1
        self.twice = self.left >= 2
        doubles = np.flatnonzero(self.twice[: self.top // 2 + 1])
        self.pairs[2 * doubles] += 1

    def take(self, length: int, times: int = 1) -> None:
        """So many of a length go; or come back, if the number is negative."""
        self.left[length] -= times
        twice, live = self.left[length] >= 2, self.left[length] >= 1
        if twice != self.twice[length]:
            self.twice[length] = twice
            if 2 * length <= self.top:
                self.pairs[2 * length] += 1 if twice else -1
        if live != self.live[length]:
            self.live[length] = False
            others = np.flatnonzero(self.live[: max(0, self.top + 1 - length)])
            self.pairs[length + others] += 1 if live else -1
            self.live[length] = live

    def pair(self, total: int) -> tuple[int, ...]:
        """Two lengths that are left and make up the sum, the most unequal ones; else none."""
        if total < 2 or not self.pairs[total]:
            return ()
        a = np.arange(1, (total + 1) // 2)
        both = np.flatnonzero(self.live[a] & self.live[total - a])
        if len(both):
            return total - int(a[both[0]]), int(a[both[0]])
        return (total // 2, total // 2)

    def exact(self, gap: int, most: int = 3) -> tuple[int, ...]:
        """Up to three lengths that are left and make up the gap: as few as can be, and of as many those that hold the longest."""
        if self.live[gap]:
            return (gap,)
        if most > 1 and (found := self.pair(gap)):
            return found
        third = np.arange(gap - 2, 0, -1) if most > 2 else np.zeros(0, np.int64)
        for c in third[self.live[third] & (self.pairs[gap - third] > 0)].tolist():
            # the pair must do without the third length, if there is but one of it
            if found := next(((b, a) for b, a in self._pairs(gap - c) if self.left[b] >= 1 + (a == b) + (b == c) and self.left[a] >= 1 + (a == c)), None):
                return (c, *found)
        return ()

    def _pairs(self, total: int):
        a = np.arange(1, total // 2 + 1)
        for k in a[self.live[a] & self.live[total - a]].tolist():
            yield total - k, k

    def largest(self, room: int) -> int:
        held = np.flatnonzero(self.live[: room + 1])
        return int(held[-1]) if len(held) else 0

    def repeat(self, pattern: list[int]) -> int:
        """How often the pattern, which was taken once, is there in all; and takes those."""
        need = Counter(pattern)
        more = int(min(self.left[x] // k for x, k in need.items()))
        if more:
            for x, k in need.items():
                self.take(x, k * more)
        return 1 + more


def patterns(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """The plan of fewest windows of those that fill long pieces' gaps with one, with up to two and with up to three lengths (see filled); of equals, the one of more."""
    return min((filled(counts, capacity, most) for most in (3, 2, 1)), key=lambda plan: sum(times for _, times in plan))


def filled(counts: np.ndarray, capacity: int, depth: int) -> list[tuple[tuple[int, ...], int]]:
    """Fillings of windows and how often each is used, for so many pieces of each length.

    Pieces of more than half a window need one each. From the longest on, such a length takes
    single lengths that fill its gap exactly, as often as both are there: each step uses up a
    length. Then the same with pairs, and then with triples, since short pieces that are many in
    one window are lacking elsewhere. What is left is fitted best: the longest that the room
    holds, until single lengths, pairs or triples fill the rest exactly or nothing fits.
    """
    held, out = Lengths(counts), [((capacity,), int(counts[capacity]))] if counts[capacity] else []
    held.take(capacity, int(counts[capacity]))
    for most in range(1, depth + 1):
        for longest in range(capacity - 1, capacity // 2, -1):
            while held.left[longest]:
                held.take(longest)
                fill = held.exact(capacity - longest, most)
                if not fill:
                    held.take(longest, -1)
                    break
                for x in fill:
                    held.take(x)
                out.append(((longest, *fill), held.repeat([longest, *fill])))
    while longest := held.largest(capacity):
        pattern, room = [], capacity
        while longest:
            held.take(longest)
            pattern.append(longest)
            room -= longest
            if room and (fill := held.exact(room)):
                for x in fill:
                    held.take(x)
                pattern += fill
                break
            longest = held.largest(room)
        out.append((tuple(pattern), held.repeat(pattern)))
    return out


def slots(plan: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (key, first, many, sequence, offset) by key: pieces of one length, from the first-th on, go to windows from this sequence on, ``many`` to each. The key holds length and first."""
    rows, used, sequence = [], Counter(), 0
    for pattern, times in plan:
        offset = 0
        for x, many in sorted(Counter(pattern).items(), reverse=True):
            rows.append((x << _RANK | used[x], used[x], many, sequence, offset))
            used[x] += many * times
            offset += many * x
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _pieces(tokenizer_path: str, capacity: int, end_id: int):
    this = uuid.uuid4().hex

    def run(batches):
        tokenizer = load_tokenizer(tokenizer_path)
        known = known_to_worker(this)
        seen, part = np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in chunks(batches, limit=CHUNK_BYTES):
            ids, at = encoded(tokenizer, texts(batch.column("text")), end_id, known)
            n = np.diff(at)
            count = -(-n // capacity)
            doc = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            head = (n - (count - 1) * capacity)[doc]
            start = np.where(piece > 0, head + (piece - 1) * capacity, 0)
            length = np.where(piece > 0, capacity, head)
            raw, begin = memoryview(ids.astype("<u4").tobytes()), at[doc] + start
            crc = [zlib.crc32(raw[4 * b : 4 * e]) for b, e in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
            order = np.argsort(length, kind="stable")
            by = length[order]
            first = np.flatnonzero(np.concatenate(([True], by[1:] != by[:-1])))
            many = np.diff(np.append(first, len(by)))
            nth = np.empty(len(by), np.int64)
            nth[order] = np.arange(len(by)) - np.repeat(first, many) + seen[by]
            seen[by[first]] += many
            columns = [batch.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(np.full(len(doc), part), pa.int32()), pa.array(nth)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pieces of the documents and their places in windows of ``capacity`` tokens, of which there are as few as the method finds.

    docs: doc_id, text; other columns are not read. A null or empty text is the end id alone.
    Only texts of more than ``capacity`` ids are cut: into full windows, and what remains is
    the first piece. Repeated rows are packed as often as they occur; a null doc_id stays null;
    an empty table gives no rows.

    How windows are filled depends on how many pieces there are of each length alone: these
    counts, ``capacity`` numbers, are all that reaches the driver, and the plan for them all
    that goes out (see patterns). Tasks number the pieces of each length; what earlier
    partitions have of a length is summed by partition and length, and joined. So pieces move
    once, without texts, and no length gathers in one task.
    """
    pieces = cut(docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(_pieces(tokenizer_path, capacity, end_id), _PIECES))
    cells = cut(pieces.groupBy("part", "length").count())
    counts = np.zeros(capacity + 1, np.int64)
    for r in cells.groupBy("length").agg(F.sum("count").alias("count")).collect():
        counts[r["length"]] = r["count"]
    found = slots(patterns(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = cells.select("part", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    numbered = pieces.join(before, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("nth"))

    def place(batches):
        key, first, many, sequence, offset = np.ascontiguousarray(found.T)
        for batch in batches:
            length, nth = (batch.column(c).to_numpy() for c in ("length", "nth"))
            k = np.searchsorted(key, length << _RANK | nth, side="right") - 1
            window, within = np.divmod(nth - first[k], many[k])
            columns = [*batch.columns[:5], pa.array(sequence[k] + window), pa.array(offset[k] + within * length)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return numbered.mapInArrow(place, RESULT)
