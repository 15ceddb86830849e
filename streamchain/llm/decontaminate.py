"""Benchmark decontamination: multi-pattern search with block shift tables (Wu and Manber)."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import _packed, _parts, chunks, release, rolling, rolling_at, split_words, texts, word_hashes
from .components import cut

#: Maps A-Z to a-z, and each ASCII character that is neither letter nor digit to a space.
_FOLD = bytes(c if c >= 0x80 or chr(c).isalnum() and not chr(c).isupper() else c + 32 if chr(c).isupper() and c < 0x80 else 0x20 for c in range(256))

RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
#: Places of windows that are gone through side by side.
_LANE = 256


def split(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z in lower case: offsets of the texts' first words, and all words."""
    if not len(column):
        return np.zeros(1, np.int64), pa.array([], pa.large_string())
    at, data = _parts(_packed(column))
    return split_words(pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(at), pa.py_buffer(bytes(data).translate(_FOLD))))


def _joined(words: pa.Array, first: int, size: int) -> bytes:
    return b" ".join(words.slice(first, size).cast(pa.large_binary()).to_pylist())


@dataclass(frozen=True)
class Tables:
    """Search tables for windows of one length, as sorted arrays: shifts by the hash of a block of two words, and windows by their own hash.

    The search looks at the last two words of the place where a window could end. A block that
    no window holds lets it jump on by almost a window, one that some hold by as far as the
    nearest of them needs; where it ends windows, it selects their bucket, and in a bucket,
    ordered by the hash of all words, those of the same hash are compared, byte by byte.
    """

    size: int
    blocks: np.ndarray
    shifts: np.ndarray
    buckets: np.ndarray  # of each block: where the windows begin that it ends, and, after the last, their number
    hashes: np.ndarray
    items: np.ndarray  # of each hash: number of the item
    places: np.ndarray  # and of its first word in ``text``, which ``at`` finds
    text: bytes
    at: np.ndarray

    def ends(self, block: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Places of words where windows may end. block: of each word, the hash of it and the one before; first: where documents begin."""
        begin, end = first[:-1] + self.size - 1, first[1:]
        lanes = np.maximum(0, -(-(end - begin) // _LANE))
        doc = np.repeat(np.arange(len(lanes)), lanes)
        at = begin[doc] + _LANE * (np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes))
        stop = np.minimum(at + _LANE, end[doc])
        found = []
        while len(at):
            own = block[at]
            k = np.minimum(np.searchsorted(self.blocks, own), len(self.blocks) - 1)
            step = np.where(self.blocks[k] == own, self.shifts[k], max(1, self.size - 1))
            found.append(at[step == 0])
            at = at + np.maximum(step, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def _place(self, own: np.ndarray, bucket: np.ndarray, before) -> np.ndarray:
        """Of each hash, the first place in its bucket whose hash isn't before it: halved until none is left."""
        low, high = self.buckets[bucket], self.buckets[bucket + 1]
        while (on := low < high).any():
            half = (low + high) // 2
            less = on & before(self.hashes[np.minimum(half, len(self.hashes) - 1)], own)
            low, high = np.where(less, half + 1, low), np.where(on & ~less, half, high)
        return low

    def find(self, words: pa.Array, hash_: np.ndarray, first: np.ndarray):
        """(first word, number of the item) of each occurrence."""
        if len(hash_) < self.size:
            return
        block = _blocks(hash_, self.size)
        begins = self.ends(block, first) - self.size + 1
        own = rolling_at(hash_, begins, self.size)
        bucket = np.searchsorted(self.blocks, block[begins + self.size - 1])
        low = self._place(own, bucket, np.less)
        high = self._place(own, bucket, np.less_equal)
        for begin, a, b in zip(begins[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist(), strict=True):
            window = _joined(words, begin, self.size)
            for k in range(a, b):
                place = self.places[k]
                if self.text[self.at[place] : self.at[place + self.size] - 1] == window:
                    yield begin, int(self.items[k])


def _blocks(hash_: np.ndarray, size: int) -> np.ndarray:
    """Of each word, the hash of the block that ends there: two words, or one for windows of one."""
    return hash_ if size == 1 else np.concatenate((hash_[:1], rolling(hash_, 2)))


def _windows(first: np.ndarray, size: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By window length: the first words of windows, and the items that these are of."""
    n = np.diff(first)
    out = {}
    for m in sorted({min(size, k) for k in n.tolist() if k}):
        own = np.flatnonzero(n >= size if m == size else n == m)
        many = n[own] - m + 1
        item = np.repeat(own, many)
        out[m] = (first[item] + np.arange(len(item)) - np.repeat(np.cumsum(many) - many, many), item)
    return out


def build(items: pa.Array, size: int) -> list[Tables]:
    """Tables of all windows of the items' texts; an item with fewer words than ``size`` is one window."""
    first, words = split(texts(items))
    hash_ = word_hashes(words)
    text = b"".join(w + b" " for w in words.cast(pa.large_binary()).to_pylist())
    at = np.concatenate(([0], np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1)))
    out = []
    for m, (begins, item) in _windows(first, size).items():
        own = rolling_at(hash_, begins, m)
        block = _blocks(hash_, m)
        order = np.lexsort((begins, item, own, block[begins + m - 1]))
        own, item, places = own[order], item[order], begins[order]
        # an item's repeated window is one; of windows with one hash, all others stay, to be compared
        kept = np.array([k == 0 or own[k] != own[k - 1] or item[k] != item[k - 1] or text[at[places[k]] : at[places[k] + m]] != text[at[places[k - 1]] : at[places[k - 1] + m]] for k in range(len(own))])
        held = np.concatenate([block[begins + j] for j in range(min(1, m - 1), m)])
        shift = np.repeat(np.arange(m - 1 - min(1, m - 1), -1, -1, dtype=np.uint8), len(begins))
        order = np.lexsort((shift, held))
        held, shift = held[order], shift[order]
        new = np.concatenate(([True], held[1:] != held[:-1]))
        ended = block[places[kept] + m - 1]
        buckets = np.append(np.searchsorted(ended, held[new]), len(ended))
        out.append(Tables(m, held[new], shift[new].astype(np.int64), buckets, own[kept], item[kept], places[kept], text, at))
    return out


def _result(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], [f.split()[0] for f in RESULT.split(", ")])


def _verdict(doc, n: int, spans: list[tuple[int, int]], items: set[str]) -> tuple:
    """The row of a document, from the spans (first word, end) and the items of all occurrences."""
    covered, reach = 0, 0
    for first, end in sorted(spans):
        covered += max(0, end - max(first, reach))
        reach = max(reach, end)
    names = sorted(items)
    return doc, n, covered, len(names), hashlib.sha256(",".join(names).encode("utf-8", "surrogatepass")).hexdigest(), covered > 0


def _found(batches, sent):
    """Chunks of documents with their offsets of words, and the spans and items of each that has any, by its place in the chunk."""
    names, tables = sent.value
    for batch in chunks(batches):
        first, words = split(texts(batch.column("text")))
        hash_ = word_hashes(words)
        spans, found = defaultdict(list), defaultdict(set)
        for t in tables:
            for begin, item in t.find(words, hash_, first):
                doc = int(np.searchsorted(first, begin, side="right")) - 1
                spans[doc].append((begin - int(first[doc]), begin - int(first[doc]) + t.size))
                found[doc].add(names[item])
        yield batch, first, spans, found


def _search(sent):
    def run(batches):
        for batch, first, spans, found in _found(batches, sent):
            n = np.diff(first).tolist()
            yield _result([_verdict(doc, n[k], spans.get(k, []), found.get(k, set())) for k, doc in enumerate(batch.column("doc_id").to_pylist())])

    return run


def _keys(column: pa.Array) -> list[bytes]:
    return [hashlib.md5(t).digest() for t in column.cast(pa.large_binary()).to_pylist()]


_HITS = "row_key binary, spans array<struct<begin:int,end:int>>, items array<string>"


def _hits(sent):
    """The texts that a part of the benchmark hits, by their digests."""
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch, _, spans, found in _found(batches, sent):
            hit = sorted(spans)
            own = [[{"begin": a, "end": b} for a, b in spans[d]] for d in hit]
            yield pa.RecordBatch.from_arrays([pa.array(_keys(texts(batch.column("text")).take(pa.array(hit, pa.int64()))), pa.binary()), pa.array(own, kind), pa.array([sorted(found[d]) for d in hit], pa.list_(pa.string()))], ["row_key", "spans", "items"])

    return run


def _pieces(size: int, most: int):
    """Items in pieces of so many bytes or a little more, that share ``size`` - 1 words with the next: all windows of an item lie in its pieces."""

    def run(batches):
        for batch in chunks(batches, "body"):
            column = texts(batch.column("body"))
            first, words = split(column)
            ends = np.concatenate(([0], np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1)))
            names = batch.column("item").to_pylist()
            for k in range(len(names)):
                begin, end = int(first[k]), int(first[k + 1])
                while begin < end:
                    upto = min(end, max(begin + size, int(np.searchsorted(ends, ends[begin] + most))))
                    yield pa.RecordBatch.from_arrays([pa.array([names[k]]), pa.array([_joined(words, begin, upto - begin).decode("utf-8", "surrogatepass")])], ["item", "body"])
                    begin = end if upto == end else upto - size + 1

    return run


def _by_parts(docs: DataFrame, items: DataFrame, size: int, held: int, most_bytes: int) -> DataFrame:
    """The same for benchmarks whose tables are too large to send at once: a pass over the documents for each part, which sends that part's tables alone."""
    spark = docs.sparkSession
    parts = -(-2 * held // most_bytes)  # on average half full, so that hashed pieces overfill none
    pieces = items.mapInArrow(_pieces(size, max(1, most_bytes // 16)), "item string, body string").distinct()
    pieces = cut(pieces.withColumn("part", F.pmod(F.xxhash64("item", "body"), F.lit(parts))).repartitionByRange("part"))
    hits = None
    for part in range(parts):
        few = pieces.filter(F.col("part") == part).collect()
        if not few:
            continue
        sent = spark.sparkContext.broadcast(([r.item for r in few], build(pa.array([r.body for r in few], pa.large_string()), size)))
        own = cut(docs.mapInArrow(_hits(sent), _HITS).dropDuplicates(["row_key"]))
        sent.unpersist()
        hits = own if hits is None else hits.unionByName(own)

    def counted(batches):
        for batch in chunks(batches):
            column = texts(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(split(column)[0]), pa.int64()), pa.array(_keys(column), pa.binary())], ["doc_id", "n_words", "row_key"])

    def judge(batches):
        for batch in batches:
            yield _result([_verdict(r["doc_id"], r["n_words"], [(s["begin"], s["end"]) for s in r["spans"] or ()], set(r["items"] or ())) for r in batch.to_pylist()])
            release()

    if hits is None:
        hits = spark.createDataFrame([], _HITS)
    hits = hits.groupBy("row_key").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    return docs.mapInArrow(counted, "doc_id long, n_words long, row_key binary").join(hits, "row_key", "left").select("doc_id", "n_words", "spans", "items").mapInArrow(judge, RESULT)


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, size: int = 10, most_bytes: int = 4 << 20) -> DataFrame:
    """One row per document row: how many of its words lie in an occurrence of a benchmark window.

    docs: doc_id, text; benchmark: item_id, text. Other columns are not read, so their names
    may clash. A null text has no words; items without id or words are left out; rows repeated
    in either table count as themselves (documents) or once (items). An empty benchmark gives
    zero hits, empty documents give no rows.

    Up to ``most_bytes`` of items, their search tables are built once and sent to the tasks
    (about 40 bytes a word): the documents are read once and nothing is shuffled. A larger
    benchmark is dealt into parts of half that on average, long items in pieces that overlap;
    each part's tables are sent and searched alike, one part after another, and only what is
    hit is kept of a pass. So such a benchmark costs a pass over the documents for each 2 MB.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("body")).filter("item is not null and body is not null")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held = items.agg(F.sum(F.octet_length("body") + 16)).first()[0] or 0
    if held > most_bytes:
        return _by_parts(docs, items, size, held, most_bytes)
    few = items.collect()
    tables = build(pa.array([r.body for r in few], pa.large_string()), size)
    return docs.mapInArrow(_search(spark.sparkContext.broadcast(([r.item for r in few], tables))), RESULT)
