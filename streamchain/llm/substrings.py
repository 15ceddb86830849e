"""Substring deduplication: anchors at the positions of a difference cover, then extension to whole windows."""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import combinations, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrow import freed, rolling, split_words, texts, word_hashes
from .blocks import block_count, blocked, by_shard, keys, run_ends, runs, table

RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
_SENT = {"shard": pa.int32(), "block": pa.int32(), "data": pa.binary(), "flags": pa.binary()}
_SENT_SQL = "shard int, block int, data binary, flags binary"
_REPLY = {"block": pa.int32(), "step": pa.int32(), "shard": pa.int32(), "flags": pa.binary()}
_REPLY_SQL = "block int, step int, shard int, flags binary"
#: A window in the exchange: hash, further bits of a second hash, and the smallest doc_id that has it in its block.
_WINDOW = np.dtype([("hash", "<u8"), ("check", "<u4"), ("doc", "<i8")])
_LAST = np.iinfo(np.int64).max


@lru_cache
def difference_cover(period: int) -> tuple[int, ...]:
    """The smallest residues among whose differences modulo the period every residue occurs."""
    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
    raise AssertionError


class Block:
    """The texts of a block as word hashes, in the order of their ids; and what all steps derive from them alike."""

    def __init__(self, docs: pa.Table, window: int, shards: int):
        ids = docs.column("doc_id").combine_chunks()
        order = np.argsort(np.where(ids.is_null().to_numpy(zero_copy_only=False), _LAST, ids.fill_null(0).to_numpy(zero_copy_only=False)), kind="stable")
        ids = ids.take(pa.array(order))
        self.ids = ids.to_pylist()
        self.rank = np.array([_LAST if i is None else i for i in self.ids], np.int64)
        self.texts = texts(docs.column("text")).take(pa.array(order))
        self.first, words = split_words(self.texts)
        self.hash = word_hashes(words)
        self.window, self.shards = window, shards
        self.period = (window + 1) // 2
        self.width = window - self.period + 1
        n = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(n)), n)
        self.place = np.arange(len(self.hash)) - self.first[self.doc]
        self.left = self.first[self.doc + 1] - np.arange(len(self.hash)) if len(self.hash) else np.zeros(0, np.int64)

    def anchors(self) -> None:
        """Hashes of the words at cover positions: ``at`` their places by ascending key, ``key`` their distinct keys, ``run`` the key of each."""
        at = np.flatnonzero(np.isin(self.place % self.period, difference_cover(self.period)) & (self.left >= self.width))
        key = keys(rolling(self.hash, self.width)[at], self.shards) if len(at) else np.zeros(0, np.uint64)
        order = np.argsort(key, kind="stable")
        self.at, key = at[order], key[order]
        begins = runs(key)
        self.key, self.run = key[begins], np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(key))))
        ends = np.append(begins[1:], len(key)) - 1
        self.many = self.doc[self.at[begins]] != self.doc[self.at[ends]] if len(begins) else np.zeros(0, bool)

    def candidates(self, replies: dict[int, bytes]) -> None:
        """Windows around anchors that other documents have too, by ascending hash; ``win_key`` their distinct rows to send."""
        self.anchors()
        shared = np.zeros(len(self.key), bool)
        for shard, begin, end in zip(*by_shard(self.key), strict=True):
            if shard in replies:
                shared[begin:end] = np.unpackbits(np.frombuffer(replies[shard], np.uint8), count=end - begin).astype(bool)
        at = self.at[shared[self.run]]
        near = np.zeros(len(self.hash) + 1, np.int64)
        np.add.at(near, np.maximum(at - (self.period - 1), self.first[self.doc[at]]), 1)
        np.add.at(near, at + 1, -1)
        starts = np.flatnonzero((np.cumsum(near)[:-1] > 0) & (self.left >= self.window))
        hashes = rolling(self.hash, self.window, 1)[starts] if len(starts) else np.zeros(0, np.uint64)
        check = rolling(self.hash, self.window, 2)[starts].astype(np.uint32) if len(starts) else np.zeros(0, np.uint32)
        shard = hashes % np.uint64(self.shards)
        order = np.lexsort((check, hashes, shard))  # stable: a window's documents stay in the order of their ids
        self.starts, hashes, check, shard = starts[order], hashes[order], check[order], shard[order]
        new = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (check[1:] != check[:-1]))) if len(order) else np.zeros(0, bool)
        begins = np.flatnonzero(new)
        self.win_run = np.cumsum(new) - 1
        self.win = np.zeros(len(begins), _WINDOW)
        self.win["hash"], self.win["check"], self.win["doc"] = hashes[begins], check[begins], self.rank[self.doc[self.starts[begins]]]
        self.win_shard = shard[begins].astype(np.int64)

    def window_shards(self):
        begins = runs(self.win_shard)
        return zip(self.win_shard[begins], begins, run_ends(begins, len(self.win_shard)), strict=True)

    def removed(self, replies: dict[int, bytes]) -> np.ndarray:
        """Words in windows that start in a document of smaller id, in this block or another."""
        elsewhere = np.zeros(len(self.win), bool)
        for shard, begin, end in self.window_shards():
            if shard in replies:
                elsewhere[begin:end] = np.unpackbits(np.frombuffer(replies[shard], np.uint8), count=end - begin).astype(bool)
        own = self.rank[self.doc[self.starts]]
        drop = self.starts[elsewhere[self.win_run] | (own > self.win["doc"][self.win_run])] if len(self.starts) else self.starts
        cover = np.zeros(len(self.hash) + 1, np.int64)
        np.add.at(cover, drop, 1)
        np.add.at(cover, drop + self.window, -1)
        return np.cumsum(cover)[:-1] > 0


def _replies(found: pa.Table, step: int) -> dict[int, bytes]:
    return {r["shard"]: r["flags"] for r in found.to_pylist() if r["step"] == step}


def deduplicate(docs: DataFrame, window: int = 13, blocks: int | None = None) -> DataFrame:
    """Per document row: how many of its words lie in a window of words that a document with a smaller id has too, and a digest of the words that stay.

    docs: doc_id, text. A null or empty text has no words. Rows of one doc_id don't remove each
    other's words; a null doc_id counts as the largest. An empty table gives no rows; other
    columns are not read.

    Two equal windows share an anchor of ``window - period + 1`` words at a place of the
    difference cover in both of their documents, since ``period`` successive places hold every
    difference. So: (1) blocks send their distinct anchors to shards, which tell the blocks
    which of them another document has; (2) around those, blocks hash whole windows and send
    them with the smallest id that has them, and learn which of them a smaller id elsewhere
    has. Anchors that only seem shared cost work, never words: windows are told apart by 96
    bits. Texts move once, whichever step reads them; groups of copies cost a row a block.
    """
    n = blocks or block_count(docs)
    dealt = blocked(docs, n)

    @freed
    def send_anchors(key, found):
        block = Block(found, window, n)
        block.anchors()
        low = (block.key & np.uint64(0xFFFFFFFF)).astype("<u4")
        return table(_SENT, [(s, key[0].as_py(), low[b:e].tobytes(), np.packbits(block.many[b:e]).tobytes()) for s, b, e in zip(*by_shard(block.key), strict=True)])

    @freed
    def match_anchors(key, found):
        rows = found.to_pylist()
        own = [np.frombuffer(r["data"], "<u4") for r in rows]
        many = np.concatenate([np.unpackbits(np.frombuffer(r["flags"], np.uint8), count=len(a)) for r, a in zip(rows, own, strict=True)])
        _, at, count = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
        shared = count > 1
        shared[at[many > 0]] = True
        out, begin = [], 0
        for r, a in zip(rows, own, strict=True):
            flags = shared[at[begin : begin + len(a)]]
            begin += len(a)
            if flags.any():
                out.append((r["block"], 1, key[0].as_py(), np.packbits(flags).tobytes()))
        return table(_REPLY, out)

    @freed
    def send_windows(key, found, replies):
        block = Block(found, window, n)
        block.candidates(_replies(replies, 1))
        return table(_SENT, [(s, key[0].as_py(), block.win[b:e].tobytes(), b"") for s, b, e in block.window_shards()])

    @freed
    def match_windows(key, found):
        rows = found.to_pylist()
        own = [np.frombuffer(r["data"], _WINDOW) for r in rows]
        every = np.concatenate(own)
        order = np.lexsort((every["doc"], every["check"], every["hash"]))
        by = every[order]
        new = np.concatenate(([True], (by["hash"][1:] != by["hash"][:-1]) | (by["check"][1:] != by["check"][:-1])))
        least = np.empty(len(every), np.int64)
        least[order] = by["doc"][new][np.cumsum(new) - 1]
        out, begin = [], 0
        for r, a in zip(rows, own, strict=True):
            flags = least[begin : begin + len(a)] < a["doc"]
            begin += len(a)
            if flags.any():
                out.append((r["block"], 2, key[0].as_py(), np.packbits(flags).tobytes()))
        return table(_REPLY, out)

    @freed
    def strip(key, found, replies):
        block = Block(found, window, n)
        block.candidates(_replies(replies, 1))
        gone = block.removed(_replies(replies, 2))
        rows = []
        for k, (doc, text) in enumerate(zip(block.ids, block.texts.to_pylist(), strict=True)):
            words = text.encode("utf-8", "surrogatepass").split()
            lost = gone[block.first[k] : block.first[k + 1]]
            kept = compress(words, ~lost) if lost.any() else words
            rows.append((doc, len(words), int(lost.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()))
        return table({"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string()}, rows)

    by_block = dealt.groupBy("block")
    anchors = by_block.applyInArrow(send_anchors, _SENT_SQL).groupBy("shard").applyInArrow(match_anchors, _REPLY_SQL)
    windows = by_block.cogroup(anchors.groupBy("block")).applyInArrow(send_windows, _SENT_SQL).groupBy("shard").applyInArrow(match_windows, _REPLY_SQL)
    return by_block.cogroup(anchors.unionByName(windows).groupBy("block")).applyInArrow(strip, RESULT)
