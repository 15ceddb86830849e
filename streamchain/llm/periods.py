"""Periodic runs of words: Lyndon arrays of both orders of the alphabet, with matches reused, and the runs that their roots extend to."""

from __future__ import annotations

import hashlib
import zlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrow import chunks, split_words, texts

RESULT = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
_TYPES = (pa.int64(),) * 6 + (pa.string(),) * 2
_NAMES = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
#: Text bytes of a chunk: its words' numbers and the arrays of its longest text are in memory at once.
CHUNK_BYTES = 4 << 20


def lyndon(x: list[int]) -> tuple[list[int], list[int]]:
    """For each place i of x, whose last entry is smaller than all others and not a place itself: where the next smaller suffix begins, and how far the two match.

    x[i : that] is the longest Lyndon word at i. Places that wait for a smaller suffix are a
    chain: the suffix before each is smaller. Place i is compared along it. A match with one
    link of the chain tells the match with the next, but where it equals the match of the
    links; then it goes on from there, never from its beginning. A window, the match (a, a - d)
    that reaches farthest right, answers for places within it: at the same distance by its
    end, and else by what was matched a distance d to the left, unless that reaches its end.
    """
    n = len(x) - 1
    smaller, match = [n] * n, [0] * n
    before, above = [-1] * n, [0] * n  # the chain, and the match with its next link
    alike = [0] * (n + 1)  # match of a place with the one before it
    for i in range(n - 1, 0, -1):
        if x[i] == x[i - 1]:
            alike[i] = alike[i + 1] + 1
    a = d = end = 0
    for i in range(1, n):
        j, k = i - 1, alike[i]
        c = x[i + k]
        while c < x[j + k]:
            smaller[j], match[j] = i, k
            e, j = above[j], before[j]
            if j < 0 or k < e:
                if j < 0:
                    break
                continue
            if k > e:  # the links differ before this match ends, and the farther is the smaller
                k = e
                break
            if c == x[j + k]:
                if i < end:
                    if i - j == d:
                        k = end - i
                    elif j >= a - d and j - d >= 0:
                        u, v = j - d, i - d
                        known = match[u] if smaller[u] == v else above[v] if before[v] == u else k
                        k = max(k, min(known, end - i))
                while x[i + k] == x[j + k]:
                    k += 1
                if i + k > end:
                    a, d, end = i, i - j, i + k
                c = x[i + k]
        before[i], above[i] = j, k if j >= 0 else 0
    return smaller, match


def runs(codes: np.ndarray, least: int = 12) -> list[tuple[int, int, int]]:
    """start, length, period of every run of ``least`` or more of these numbers from 0 on, by start and then period.

    A run is a stretch with smallest period p, of 2 p at least, that no neighbour extends. In
    one of the two orders of the alphabet the longest Lyndon word at some place of it is its
    root, of length p: so each place's word is extended to both sides as far as period p holds.
    """
    n, found = len(codes), set()
    if n < least:
        return []
    top = int(codes.max())
    for values in (codes, top - codes):
        x = values.tolist()
        x.append(-1)
        smaller, match = map(np.array, lyndon(x))
        place = np.arange(n)
        root = smaller - place
        # the match to the right, and what precedes both if they are alike there, must make up a period
        before = np.zeros(n, bool)
        before[1:] = codes[:-1] == codes[np.minimum(smaller[1:], n) - 1]
        may = (smaller < n) & ((match >= np.maximum(root, least - root)) | before)
        seen: dict[int, tuple[int, int]] = {}
        for i, p, k in zip(np.flatnonzero(may).tolist(), root[may].tolist(), match[may].tolist()):
            begin, end = seen.get(p, (0, -1))
            if i > end:  # else this stretch of period p is known
                begin = i
                while begin and x[begin - 1] == x[begin - 1 + p]:
                    begin -= 1
                end = i + k
                seen[p] = begin, end
                if end - begin >= p and end - begin + p >= least:
                    found.add((begin, end - begin + p, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which word stands at each of the n places, for the ids whose texts are made periodic from some word on; None for all others, null among them."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def _row(doc, codes: np.ndarray, text: bytes, least: int, plant: bool) -> tuple:
    at = planted(doc, len(codes)) if plant else None
    found = runs(codes if at is None else codes[at], least)
    words = text.split()
    if at is not None:
        words = [words[k] for k in at.tolist()]
    if found:
        kept = np.ones(len(words), bool)
        for start, length, period in found:
            kept[start + period : start + length] = False
        words = compress(words, kept.tolist())
    start, length, period = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    listed = "".join(f"{s},{m},{p}\n" for s, m, p in found)
    digests = (hashlib.sha256(b).hexdigest() for b in (listed.encode(), b" ".join(words)))
    return (doc, len(found), start, length, period, 1000 * length // period if found else None, *digests)


def detect(docs: DataFrame, least: int = 12, plant: bool = False) -> DataFrame:
    """Per document row: how many runs its words have, the longest one, and digests of all runs and of the words that stay when every run is collapsed to its first period.

    docs: doc_id, text; other columns are not read. Words are split at ASCII white space and
    compared as they are. A null or empty text has no words: no runs, nulls for the longest,
    and digests of the empty string. Of equally long runs the one of smallest start, then
    period, is named. Every row is judged by its own text, so repeated rows give equal rows and
    an empty table none. ``plant`` first makes the texts of a tenth of the ids periodic (see
    planted); a null id is none of them.

    Each task reads its own rows, so nothing is shuffled. Time grows with the words of a text
    whatever they repeat; memory is bounded by a chunk, or by its longest text.
    """

    def run(batches):
        for batch in chunks(batches, limit=CHUNK_BYTES):
            column = texts(batch.column("text"))
            first, words = split_words(column)
            # one order of the alphabet is as good as another: words are numbered as the chunk has them
            code = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) if len(words) else np.zeros(0, np.int64)
            raw = column.cast(pa.large_binary())
            rows = [_row(doc, code[first[k] : first[k + 1]], raw[k].as_py(), least, plant) for k, doc in enumerate(batch.column("doc_id").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], list(_NAMES))

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, RESULT)
