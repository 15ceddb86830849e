"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays, scored from mapped files."""

from __future__ import annotations

import mmap
import os
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.checkpoint import own_folder
from .arrow import ascii_lower, chunks, mixed, release, split_words, texts, word_hashes
from .blocks import block_count, from_planes, planes, runs, table

RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
#: Words are told apart by so many bits; bigrams by 64.
_WORD = np.uint64((1 << 48) - 1)
#: Marks of a document's begin (a context) and end (a token); words hash to anything else but by chance.
BEGIN, END = np.uint64(0x0B0B0B0B0B0B), np.uint64(0x0E0E0E0E0E0E)
_SENT_SQL = "file int, shard int, contexts binary, lengths binary, words binary, counts binary"
_WORDS_SQL = "file int, shard int, words binary, kinds binary, counts binary, hot binary, sums array<long>"
_WORDS = {"file": pa.int32(), "shard": pa.int32(), "words": pa.binary(), "kinds": pa.binary(), "counts": pa.binary(), "hot": pa.binary(), "sums": pa.list_(pa.int64())}
_SUMS_SQL = "part int, context long, sums array<long>"
_SUMS = {"part": pa.int32(), "context": pa.int64(), "sums": pa.list_(pa.int64())}
#: Contexts with a larger share of a sample's tokens are dealt out by the word that follows: a thousandth, or HOT_SHARDS times what a shard has where shards are more, so that none of them fills a shard. They are at most as many as the share's inverse, and that is at most MOST_HOT.
HOT_SHARE, HOT_SHARDS, MOST_HOT, HOT_SAMPLE = 0.001, 2, 200_000, 32 << 20
#: Files of each kind of array, whatever the size: each holds the arrays of many shards.
FILES = 1024
#: Bytes of arrays that a worker keeps in memory if they can't be mapped where they lie.
KEPT_BYTES = 256 << 20


def _hash(words: pa.Array) -> np.ndarray:
    return mixed(word_hashes(words)) & _WORD


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, token before it, where each text's tokens begin): lower-cased words, then an end."""
    first, words = split_words(ascii_lower(column))
    h = _hash(words)
    token = np.insert(h, first[1:], END)
    at = first + np.arange(len(first))
    before = np.concatenate(([BEGIN], token[:-1])) if len(token) else token
    before[at[:-1]] = BEGIN
    return token, before, at


def _bigram(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mixed(before * np.uint64(0x9E3779B97F4A7C15) + token)


def _narrow(words: np.ndarray) -> bytes:
    """The six low bytes of each hash."""
    return words.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _wide(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def packed(keys: np.ndarray, *values: np.ndarray) -> bytes:
    """Ascending keys and numbers for each, in as few bytes as the largest needs. Padded to whole words of 8 bytes."""
    arrays = [v.astype(next(t for t in ("<u1", "<u2", "<u4", "<u8") if not len(v) or int(v.max()) <= np.iinfo(t).max)) for v in values]
    head = np.array([len(keys), len(values), *[a.itemsize for a in arrays]], "<u8")
    data = b"".join(np.ascontiguousarray(a).tobytes() for a in (head, keys.astype("<u8"), *sorted(arrays, key=lambda a: -a.itemsize)))
    return data + bytes(-len(data) % 8)


class Written:
    """A file that is written from front to end: sections by shard, then where each lies, then how many there are. It appears whole when it is closed, or not at all; a repeated task writes the same."""

    def __init__(self, folder: Folder, name: str):
        self.path, self.sections, self.at, self.part = folder.path(name), [], 0, None
        if folder.mounted:
            os.makedirs(os.path.dirname(self.path), exist_ok=True)
            self.part = f"{self.path}.{uuid.uuid4().hex}"
            self.out = open(self.part, "wb")
        else:
            system, at = folder.system(name)
            self.out = system.open_output_stream(at)

    def add(self, shard: int, data: bytes) -> None:
        self.out.write(data)
        self.sections.append((shard, self.at, len(data)))
        self.at += len(data)

    def close(self) -> None:
        self.out.write(np.array([x for s in sorted(self.sections) for x in s] + [len(self.sections)], "<u8").tobytes())
        self.out.close()
        if self.part:
            os.replace(self.part, self.path)


class Folder:
    """A folder that all executors reach: a mounted path, or any place that Arrow's file systems open."""

    def __init__(self, uri: str):
        self.uri = uri
        self.mounted = urlparse(uri).scheme in ("", "file")

    def path(self, name: str) -> str:
        return os.path.join(urlparse(self.uri).path if self.mounted else self.uri, name)

    def system(self, name: str):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path(name))


class Stored:
    """A written file. Where the folder is mounted it is mapped once, and sections are views of it; elsewhere a section is read by its range when it is asked for."""

    def __init__(self, folder: Folder, name: str):
        self.mounted = folder.mounted
        if self.mounted:
            with open(folder.path(name), "rb") as f:
                self.data = np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, trackfd=False), np.uint8)
            size = len(self.data)
        else:
            system, at = folder.system(name)
            self.file = system.open_input_file(at)
            size = self.file.size()
        many = int(self._range(size - 8, 8).view("<u8")[0])
        index = self._range(size - 8 - 24 * many, 24 * many).view("<u8").reshape(-1, 3)
        if int(index[:, 2].sum()) + 24 * many + 8 != size:
            raise ValueError("a file of the model is not whole")
        self.sections = {int(s): (int(b), int(n)) for s, b, n in index}

    def _range(self, begin: int, count: int) -> np.ndarray:
        return self.data[begin : begin + count] if self.mounted else np.frombuffer(self.file.read_at(count, begin), np.uint8)

    def section(self, shard: int) -> np.ndarray:
        return self._range(*self.sections[shard])


class Sorted:
    """Ascending keys of 64 bits and a few numbers for each, in one section (see ``packed``)."""

    def __init__(self, data: np.ndarray):
        n, many = data[:16].view("<u8").tolist()
        sizes = data[16 : 16 + 8 * many].view("<u8").tolist()
        at, self.bytes = 16 + 8 * many, len(data)
        self.keys, at, self.values = data[at : at + 8 * n].view("<u8"), at + 8 * n, [None] * many
        for k in sorted(range(many), key=lambda k: -sizes[k]):
            self.values[k] = data[at : at + n * sizes[k]].view(f"<u{sizes[k]}")
            at += n * sizes[k]
        if at + -at % 8 != len(data):
            raise ValueError("an array of the model is not whole")

    def find(self, wanted: np.ndarray) -> list[np.ndarray]:
        """The numbers of each wanted key; zeros if it isn't there."""
        if not len(self.keys):
            return [np.zeros(len(wanted), np.int64) for _ in self.values]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        there = self.keys[at] == wanted
        return [np.where(there, v[at], 0).astype(np.int64) for v in self.values]


@dataclass(frozen=True)
class Model:
    """Where the arrays lie, and the sums over all of the corpus that the formulas need."""

    folder: str
    shards: int
    files: int
    tokens: int
    types: int
    continuations: int
    discounts: tuple[float, float, float]
    low_discounts: tuple[float, float, float]
    low_kinds: tuple[int, int, int]
    #: Contexts that are dealt out by the next word, ascending, and their sums: tokens, and words that follow once, twice and more often.
    hot: np.ndarray
    hot_sums: np.ndarray
    #: Files that have bigrams, and files that have tokens: as bits.
    with_bigrams: bytes
    with_tokens: bytes


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Of counts 1, 2, and 3 or more, from how many things have counts 1 to 4; where too few do to tell, 0.5, 1 and 1.5."""
    if min(n) <= 0:
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    found = tuple(k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3))
    return tuple(min(max(d, 0.0), float(k)) for k, d in zip((1, 2, 3), found, strict=True))


def _shard(values: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(values) % np.uint64(shards)).astype(np.int64)


def _is_hot(before: np.ndarray, hot: np.ndarray) -> np.ndarray:
    return hot[np.minimum(np.searchsorted(hot, before), len(hot) - 1)] == before


def _bigram_shard(before: np.ndarray, token: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """Of the first word; for hot ones, of both."""
    return _shard(np.where(_is_hot(before, hot), _bigram(before, token), before), shards)


def hot_share(shards: int) -> float:
    return max(min(HOT_SHARE, HOT_SHARDS / shards), 1 / MOST_HOT)


def hot_contexts(docs: DataFrame, share: float = HOT_SHARE, sample: int = HOT_SAMPLE) -> np.ndarray:
    """Words that are such a share of a bounded sample's tokens, and the beginning, ascending. They only decide where bigrams are counted, never what is counted."""

    def counted(batches):
        for batch in chunks(batches):
            _, before, _ = tokens(texts(batch.column("text")))
            word, n = np.unique(before, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], ["context", "n"])

    held, sample = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0, max(sample, int(300 / share))
    some = docs.select("text").sample(min(1.0, sample / held), 7) if held > sample else docs.select("text")
    counts = some.mapInArrow(counted, "context long, n long").groupBy("context").agg(F.sum("n").alias("n"))
    many = counts.agg(F.sum("n")).first()[0] or 0
    found = [r.context for r in counts.filter(F.col("n") > F.lit(share) * max(many, 1)).select("context").collect()]
    return np.unique(np.array([int(BEGIN), *found], np.int64).astype(np.uint64))


def sections(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[dict]]]:
    """(file, shard, its rows) of batches sorted by both: the rows of one shard are held at a time."""
    at, rows = None, []
    for batch in batches:
        files, shards = (batch.column(c).to_numpy() for c in ("file", "shard"))
        begins = np.flatnonzero(np.concatenate(([True], (files[1:] != files[:-1]) | (shards[1:] != shards[:-1])))) if len(files) else []
        for b, e in zip(begins, [*begins[1:], len(files)], strict=False):
            if at != (int(files[b]), int(shards[b])):
                if rows:
                    yield *at, rows
                    release()
                at, rows = (int(files[b]), int(shards[b])), []
            rows += batch.slice(b, e - b).to_pylist()
    if rows:
        yield *at, rows


def by_file(rows: DataFrame, files: int) -> DataFrame:
    """A task a file, which gets its shards one after another."""
    return rows.repartition(files, "file").sortWithinPartitions("file", "shard")


def train(spark: SparkSession, docs: DataFrame, folder: str, shards: int | None = None, hot: np.ndarray | None = None, files: int = FILES) -> Model:
    """Count the bigrams of the texts and write the model's arrays to ``folder``, which executors share.

    Tasks send each shard the distinct bigrams of a few MB of text in one row, grouped by the
    first word. Bigrams belong to the shard of their first word, but those of hot ones (which
    the tokens of a sample tell) to that of both words, so that none gathers in one shard.
    Shards follow the text, files don't: a task writes a file, shard after shard, and holds one
    of them. It sums a shard's bigrams, appends their arrays, and passes on how many first words
    each second word has, and how often it occurs. Sums over shards are made in Spark; the driver
    gets those, the hot contexts' and which files there are.
    """
    n = shards or block_count(docs)
    files = min(n, files)
    hot = hot_contexts(docs, hot_share(n)) if hot is None else hot

    def send(batches):
        for batch in chunks(batches, limit=16 << 20):
            token, before, _ = tokens(texts(batch.column("text")))
            if not len(token):
                continue
            shard = _bigram_shard(before, token, hot, n)
            order = np.lexsort((token, before, shard))
            token, before, shard = token[order], before[order], shard[order]
            new = np.flatnonzero(np.concatenate(([True], (token[1:] != token[:-1]) | (before[1:] != before[:-1]))))
            count = np.diff(np.append(new, len(token))).astype("<u4")
            token, before, shard = token[new], before[new], shard[new]
            begins = runs(shard)
            rows: list[list] = [[] for _ in range(6)]
            for b, e in zip(begins, np.append(begins[1:], len(shard)), strict=True):
                first = runs(before[b:e])
                lengths = np.diff(np.append(first, e - b)).astype("<u4")
                for column, value in zip(rows, (int(shard[b]) % files, int(shard[b]), _narrow(before[b:e][first]), planes(lengths), _narrow(token[b:e]), planes(count[b:e])), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([*(pa.array(r, pa.int32()) for r in rows[:2]), *(pa.array(r, pa.binary()) for r in rows[2:])], ["file", "shard", "contexts", "lengths", "words", "counts"])

    def summed(shard, rows, bigrams, contexts):
        """A shard's arrays go to its files; what the shards of its second words get, and its own sums, come back."""
        before = np.concatenate([np.repeat(_wide(r["contexts"]), from_planes(r["lengths"], "<u4")) for r in rows])
        token = np.concatenate([_wide(r["words"]) for r in rows])
        count = np.concatenate([from_planes(r["counts"], "<u4") for r in rows]).astype(np.int64)
        order = np.lexsort((token, before))
        before, token, count = before[order], token[order], count[order]
        new = np.flatnonzero(np.concatenate(([True], (token[1:] != token[:-1]) | (before[1:] != before[:-1]))))
        before, token, count = before[new], token[new], np.add.reduceat(count, new)
        bigram = _bigram(before, token)
        order = np.argsort(bigram)
        bigrams.add(shard, packed(bigram[order], count[order]))
        high = _kinds(count)
        first = runs(before)
        sums = np.stack([np.add.reduceat(x.astype(np.int64), first) for x in (count, count == 1, count == 2, count > 2)])
        own = _is_hot(before[first], hot)
        contexts.add(shard, packed(before[first][~own], *sums[:, ~own]))
        hot_rows = np.concatenate((before[first][own][None].view(np.int64), sums[:, own])).T
        order = np.argsort(token)
        token, count = token[order], count[order]
        new = runs(token)
        kinds, count, token = np.diff(np.append(new, len(token))), np.add.reduceat(count, new), token[new]
        to = _shard(token, n)
        order = np.argsort(to, kind="stable")
        to, token, kinds, count = to[order], token[order], kinds[order].astype("<u8"), count[order].astype("<u8")
        begins = runs(to)
        out = [(int(to[b]) % files, int(to[b]), _narrow(token[b:e]), planes(kinds[b:e]), planes(count[b:e]), None, None) for b, e in zip(begins, np.append(begins[1:], len(to)), strict=True)]
        out.append((shard % files, shard, b"", b"", b"", np.ascontiguousarray(hot_rows).tobytes(), high))
        return table(_WORDS, out)

    def merge(batches):
        file, open_files = None, []
        for at, shard, rows in sections(batches):
            if at != file:
                for f in open_files:
                    f.close()
                file, open_files = at, [Written(Folder(folder), f"{kind}-{at}") for kind in ("bigrams", "contexts")]
            yield from summed(shard, rows, *open_files).to_batches()
        for f in open_files:
            f.close()

    def close(batches):
        file, words = None, None
        for at, shard, rows in sections(batches):
            if at != file:
                if words:
                    words.close()
                file, words = at, None
            token = np.concatenate([_wide(r["words"]) for r in rows])
            out = []
            for r in rows:
                if r["sums"] is not None:  # of this shard's bigrams
                    out += [(0, None, r["sums"]), (2, at, [])]
                    out += [(1, int(c), [int(x) for x in sums]) for c, *sums in np.frombuffer(r["hot"], np.int64).reshape(-1, 5)]
            if len(token):
                order = np.argsort(token)
                new = runs(token[order])
                kinds, count = (np.add.reduceat(np.concatenate([from_planes(r[c], "<u8") for r in rows])[order].astype(np.int64), new) for c in ("kinds", "counts"))
                words = words or Written(Folder(folder), f"tokens-{at}")
                words.add(shard, packed(token[order][new], kinds, count))
                out += [(3, at, []), (4, None, [*_kinds(kinds), len(new), int(kinds.sum()), int(count.sum())])]
            yield from table(_SUMS, out).to_batches()
        if words:
            words.close()

    sent = by_file(docs.select("text").mapInArrow(send, _SENT_SQL), files).mapInArrow(merge, _WORDS_SQL)
    told = by_file(sent, files).mapInArrow(close, _SUMS_SQL)
    some = told.groupBy("part", "context").agg(*[F.sum(F.get("sums", F.lit(k))).alias(f"s{k}") for k in range(8)]).collect()
    high = next(([r[f"s{k}"] for k in range(5)] for r in some if r.part == 0), [0] * 5)
    low = next(([r[f"s{k}"] for k in range(8)] for r in some if r.part == 4), [0] * 8)
    sums = {np.array(r.context, np.int64).view(np.uint64)[()]: [r[f"s{k}"] for k in range(4)] for r in some if r.part == 1}
    hot_sums = np.array([sums.get(c, [0] * 4) for c in hot], np.int64)
    bits = []
    for part in (2, 3):
        there = np.zeros(files, bool)
        there[[r.context for r in some if r.part == part]] = True
        bits.append(np.packbits(there).tobytes())
    return Model(folder, n, files, low[7], low[5], low[6], discounts(high[:4]), discounts(low[:4]), (low[0], low[1], low[4]), hot, hot_sums, *bits)


class Scorer:
    """log10 probabilities of tokens after tokens, from the mapped arrays. A file is opened once, when it is first asked for, and stays open; sections that had to be read are kept up to some bytes, the last used ones."""

    def __init__(self, model: Model, kept: int = KEPT_BYTES):
        self.model, self.store, self.most, self.kept_bytes = model, Folder(model.folder), kept, 0
        self.files: dict[str, Stored] = {}
        self.kept: OrderedDict[tuple[str, int], Sorted] = OrderedDict()
        self.there = {kind: np.unpackbits(np.frombuffer(bits, np.uint8), count=model.files).astype(bool) for kind, bits in (("bigrams", model.with_bigrams), ("contexts", model.with_bigrams), ("tokens", model.with_tokens))}

    def _array(self, kind: str, shard: int) -> Sorted | None:
        """A shard's array, if it has one. A file that training has written must be there."""
        file = shard % self.model.files
        if not self.there[kind][file]:
            return None
        name = f"{kind}-{file}"
        if name not in self.files:
            self.files[name] = Stored(self.store, name)
        found = self.files[name]
        if shard not in found.sections:
            return None
        if found.mounted:
            return Sorted(found.section(shard))
        if (kind, shard) not in self.kept:
            array = self.kept[kind, shard] = Sorted(found.section(shard))
            self.kept_bytes += array.bytes
            while self.kept_bytes > self.most and len(self.kept) > 1:
                self.kept_bytes -= self.kept.popitem(last=False)[1].bytes
        self.kept.move_to_end((kind, shard))
        return self.kept[kind, shard]

    def _find(self, kind: str, many: int, wanted: np.ndarray, shard: np.ndarray) -> list[np.ndarray]:
        """Values of wanted keys. They are asked for in ascending order, each once, so that the pages of a file are passed once."""
        order = np.lexsort((wanted, shard))
        key, by = wanted[order], shard[order]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (by[1:] != by[:-1]))) if len(key) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        key, by = key[at], by[at]
        out = [np.zeros(len(key), np.int64) for _ in range(many)]
        begins = runs(by)
        for b, e in zip(begins, [*begins[1:], len(by)], strict=False):
            array = self._array(kind, int(by[b]))
            if array is not None:
                for o, v in zip(out, array.find(key[b:e]), strict=True):
                    o[b:e] = v
        back = np.empty(len(order), np.int64)
        back[order] = np.cumsum(new) - 1
        return [o[back] for o in out]

    def log10(self, token: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 P(token | before), how often the token occurs in training)."""
        m = self.model
        kinds, count = self._find("tokens", 2, token, _shard(token, m.shards))
        low = _less(kinds, m.low_discounts)
        spare = sum(d * k for d, k in zip(m.low_discounts, m.low_kinds, strict=True))
        total = max(1, m.continuations)
        p = low / total + (spare / total if m.continuations else 1.0) / (m.types + 1)
        hot = _is_hot(before, m.hot)
        sums = np.zeros((4, len(before)))
        sums[:, hot] = m.hot_sums[np.searchsorted(m.hot, before[hot])].T
        sums[:, ~hot] = self._find("contexts", 4, before[~hot], _shard(before[~hot], m.shards))
        of, one, two, more = sums
        (both,) = self._find("bigrams", 1, _bigram(before, token), _bigram_shard(before, token, m.hot, m.shards))
        d = m.discounts
        seen = of > 0
        high = (_less(both, d) + (d[0] * one + d[1] * two + d[2] * more) * p) / np.where(seen, of, 1)
        return np.log10(np.where(seen, high, p)), count


def _less(count: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    """Counts less the discount of their kind."""
    return np.maximum(count - np.array([0.0, *d])[np.minimum(count, 3)], 0.0)


def _kinds(count: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3, 4, and more than 2."""
    return [int((count == k).sum()) for k in (1, 2, 3, 4)] + [int((count > 2).sum())]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per document row (doc_id, text, held_out): tokens, how many the training texts have, and log10 probabilities by the model and by the add-0.1 unigram base."""

    def run(batches):
        scorer = Scorer(model)
        for batch in chunks(batches, limit=4 << 20):
            token, before, at = tokens(texts(batch.column("text")))
            p, count = scorer.log10(token, before)
            base = np.log10((count + 0.1) / (model.tokens + 0.1 * (model.types + 1)))
            n = np.diff(at)
            known, base, p = (np.add.reduceat(x, at[:-1]) for x in ((count > 0).astype(np.int64), base, p))
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(n), pa.array(known), pa.array(np.full(len(n), model.tokens)), pa.array(base), pa.array(p), pa.array(10.0 ** (-p / n))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    return docs.select("doc_id", "text", "held_out").mapInArrow(run, RESULT)


def train_and_score(spark: SparkSession, docs: DataFrame, folds: int = 10) -> DataFrame:
    """Learn from the texts whose crc32(doc_id as text) modulo ``folds`` isn't 0, and score all.

    docs: doc_id, text; other columns are not read. A null text is empty: one end token. A null
    doc_id counts as an empty text for the remainder. Repeated rows count, and are scored, as
    often as they occur; without training texts every token has the one probability of unknown
    ones. The model lies in a new folder below the shared checkpoint folder, which goes when the
    application ends.
    """
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == 0
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held.alias("held_out"))
    return score(docs, train(spark, docs.filter(~F.col("held_out")), own_folder(spark, "ngrams")))
