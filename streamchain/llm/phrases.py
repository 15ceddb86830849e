"""Phrase collocation mining: frequent runs of words, grown to the right from projected occurrences, and their cohesion."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .arrow import chunks, freed, mixed, rolling, texts
from .blocks import block_count, by_shard, from_planes, keys, planes, run_ends, runs, table
from .components import cut

#: Occurrences of a pair of words from which on they are dealt out by the word after it.
HOT = 1 << 17
_DEALT = "lang string, text string, weight long, block int"
_SENT = {"shard": pa.int32(), "block": pa.int32(), "data": pa.binary(), "counts": pa.binary(), "lang": pa.string(), "words": pa.binary()}
_SENT_SQL = "shard int, block int, data binary, counts binary, lang string, words binary"
_REPLY = {"block": pa.int32(), "step": pa.int32(), "shard": pa.int32(), "flags": pa.binary(), "lang": pa.string(), "word": pa.string(), "token": pa.int64(), "f": pa.int64()}
_REPLY_SQL = "block int, step int, shard int, flags binary, lang string, word string, token long, f long"
_CONTEXTS = {"shard": pa.int32(), "tokens": pa.binary(), "codes": pa.binary(), "counts": pa.binary()}
_CONTEXTS_SQL = "shard int, tokens binary, codes binary, counts binary"
_GROWN = {"tokens": pa.list_(pa.int64()), "f": pa.int64()}
_GROWN_SQL = "tokens array<long>, f long"
#: A-Z in lower case, tabs as spaces, and what ends a piece as a line feed.
_TABLE = bytes(10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def _collapsed(blocks: int):
    """Texts of a chunk, equal ones of a language once, with how often they occur and a block by language and text."""

    def run(batches):
        for batch in chunks(batches):
            rows = pa.Table.from_arrays([pc.fill_null(batch.column("lang").cast(pa.string()), "und"), texts(batch.column("text"))], ["lang", "text"])
            some = rows.group_by(["lang", "text"]).aggregate([([], "count_all")])
            some = some.filter(pc.greater(pc.binary_length(some["text"]), 0))
            if some.num_rows:
                block = [xxhash.xxh3_64_intdigest(t.as_py().encode("utf-8", "surrogatepass"), xxhash.xxh3_64_intdigest(x.as_py())) % blocks for x, t in zip(some["lang"], some["text"], strict=True)]
                columns = [some["lang"].combine_chunks(), some["text"].cast(pa.string()).combine_chunks(), some["count_all"].combine_chunks(), pa.array(block, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "text", "weight", "block"])

    return run


class Block:
    """The words of a block's texts as 64-bit hashes of language and word, in order; and what all steps derive from them alike."""

    def __init__(self, docs: pa.Table, shards: int):
        self.shards = shards
        langs = docs.column("lang").combine_chunks().dictionary_encode()
        column = texts(docs.column("text"))
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64)[: len(column) + 1]
        data = bytes(data or b"").translate(_TABLE)
        b = np.frombuffer(data, np.uint8)[: at[-1]]
        word = (b != 32) & (b != 10)
        edge = np.zeros(len(b) + 1, bool)
        edge[at] = True
        before = np.concatenate(([False], word[:-1])) if len(b) else word
        begins = np.flatnonzero(word & (edge[:-1] | ~before))
        after = np.append(word[1:], False) if len(b) else word
        ends = np.flatnonzero(word & (edge[1:] | ~after)) + 1
        doc = np.searchsorted(at, begins, side="right") - 1
        piece = np.cumsum(b == 10, dtype=np.int32)[begins] if len(b) else np.zeros(0, np.int32)
        #: whether a word is followed by the next one in the same piece
        self.joined = np.zeros(len(begins), bool)
        self.joined[:-1] = (doc[1:] == doc[:-1]) & (piece[1:] == piece[:-1])
        places = np.empty(2 * len(begins) + 1, np.int64)
        places[0:-1:2], places[1::2], places[-1] = begins, ends, len(b)
        words = pa.LargeStringArray.from_buffers(2 * len(begins), pa.py_buffer(places), pa.py_buffer(data)).take(pa.array(np.arange(0, 2 * len(begins), 2)))
        coded = words.dictionary_encode()
        self.words, self.code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) if len(words) else np.zeros(0, np.int64)
        self.langs = langs.dictionary.to_pylist()
        self.lang = langs.indices.to_numpy()[doc].astype(np.int64) if len(words) else np.zeros(0, np.int64)
        own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.words.cast(pa.large_binary()).to_pylist()), np.uint64, len(self.words))
        seed = np.fromiter((xxhash.xxh3_64_intdigest(x, 1) for x in self.langs), np.uint64, len(self.langs))
        self.token = mixed(own[self.code] + mixed(seed[self.lang])) if len(words) else np.zeros(0, np.uint64)
        self.weight = docs.column("weight").to_numpy().astype(np.int64)[doc]

    def counted(self, hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys of these hashes, at these places, what each has in all, and which key each has."""
        key = keys(hashes, self.shards)
        every, back = np.unique(key, return_inverse=True)
        return every, np.bincount(back, self.weight[at], len(every)).astype(np.int64), back

    def rows(self, key, every: np.ndarray, count: np.ndarray) -> list[tuple]:
        low, count = (every & np.uint64(0xFFFFFFFF)).astype("<u4"), np.minimum(count, 0xFFFFFFFF).astype("<u4")
        return [(s, key, low[b:e].tobytes(), planes(count[b:e]), None, None) for s, b, e in zip(*by_shard(every), strict=True)]

    def frequent(self, replies: dict[int, bytes]) -> None:
        """``pair``: places of words that are frequent, as far as the exchange tells, and so is the next one of the piece."""
        every, _, back = self.counted(self.token, np.arange(len(self.token)))
        self.often = _told(every, replies)[back] > 0 if len(every) else np.zeros(0, bool)
        self.pair = np.flatnonzero(self.joined & self.often & np.append(self.often[1:], False)) if len(every) else np.zeros(0, np.int64)
        self.pair_hash = rolling(self.token, 2)[self.pair] if len(self.pair) else np.zeros(0, np.uint64)

    def listed(self, key) -> list[tuple]:
        """Words that may be frequent with their counts here, a row a language and shard; and a row without words for all words of each language."""
        n = np.bincount(self.lang, self.weight, len(self.langs)).astype("<i8")
        out = [(xxhash.xxh3_64_intdigest(x) % self.shards, key, None, n[k : k + 1].tobytes(), x, None) for k, x in enumerate(self.langs) if n[k]]
        at = np.flatnonzero(self.often)
        token, one, back = np.unique(self.token[at], return_index=True, return_inverse=True)
        count = np.bincount(back, self.weight[at], len(one)).astype("<i8")
        lang = self.lang[at[one]]
        home = lang * self.shards + (token % np.uint64(self.shards)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        home, token, count, lang = home[order], token[order].astype("<u8"), count[order], lang[order]
        spelled = self.words.take(pa.array(self.code[at[one]][order])).cast(pa.large_binary()).to_pylist()
        begins = runs(home)
        for b, e in zip(begins, run_ends(begins, len(home)), strict=True):
            out.append((int(home[b] % self.shards), key, token[b:e].tobytes(), planes(count[b:e]), self.langs[lang[b]], b"\n".join(spelled[b:e])))
        return out

    def contexts(self, replies: dict[int, bytes], most: int) -> list[tuple]:
        """Occurrences of frequent pairs with the words to their right, as long as these follow in frequent pairs and up to ``most`` words; equal ones once, by shard."""
        every, _, back = self.counted(self.pair_hash, self.pair)
        flag = _told(every, replies)[back] if len(every) else np.zeros(0, np.uint8)
        goes = np.zeros(len(self.token) + most, np.uint8)  # 1: a frequent pair begins here; 2: a hot one
        goes[self.pair] = flag
        at = self.pair[flag > 0]
        if not len(at):
            return []
        known, code = np.unique(self.token, return_inverse=True)
        code = np.append(code + 1, np.zeros(most, np.int64))
        columns, on = [code[at], code[at + 1]], np.ones(len(at), bool)
        for k in range(2, most):
            on = on & (goes[at + k - 1] > 0)
            columns.append(np.where(on, code[at + k], 0))
        columns, weight, chosen = _merged(columns, self.weight[at], len(known) + 1)
        at = at[chosen]
        home = rolling(self.token, 2)[at]
        hot = (goes[at] == 2) & (columns[2] > 0) if most > 2 else np.zeros(len(at), bool)
        home[hot] = rolling(self.token, 3)[at[hot]] if hot.any() else home[hot]
        shard = ((home >> np.uint64(32)) % np.uint64(self.shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        shard, weight, matrix = shard[order], weight[order], np.stack(columns)[:, order]
        begins, out = runs(shard), []
        for b, e in zip(begins, run_ends(begins, len(shard)), strict=True):
            used, own = np.unique(matrix[:, b:e], return_inverse=True)
            tokens = np.where(used > 0, known[used - 1], 0).astype("<u8")
            if used[0]:  # code 0 stands for no word
                tokens, own = np.insert(tokens, 0, 0), own + 1
            out.append((int(shard[b]), tokens.tobytes(), planes(own.ravel().astype("<u4")), planes(weight[b:e].astype("<i8"))))
        return out


def _told(every: np.ndarray, replies: dict[int, bytes]) -> np.ndarray:
    """What the shards say of each key; 0 where they say nothing."""
    out = np.zeros(len(every), np.uint8)
    for shard, begin, end in zip(*by_shard(every), strict=True):
        if shard in replies:
            out[begin:end] = np.frombuffer(replies[shard], np.uint8)
    return out


def _merged(columns: list[np.ndarray], weight: np.ndarray, codes: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct rows of the columns in ascending order, their weights summed, and a place of each."""
    bits, packed = max(1, int(codes).bit_length()), []
    each = max(1, 63 // bits)
    for k in range(0, len(columns), each):
        key = np.zeros(len(weight), np.int64)
        for c in columns[k : k + each]:
            key = key << bits | c
        packed.append(key)
    order = np.lexsort(packed[::-1]) if len(packed) > 1 else np.argsort(packed[0], kind="stable")
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in packed:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    begins = np.flatnonzero(new)
    chosen = order[begins]
    return [c[chosen] for c in columns], np.add.reduceat(weight[order], begins) if len(begins) else weight[:0], chosen


def grow(columns: list[np.ndarray], weight: np.ndarray, least: int) -> list[tuple[tuple[int, ...], int]]:
    """Phrases (codes) and counts, from sorted occurrences: every pair, and longer ones of at least so many.

    The occurrences of a prefix are a stretch of rows, which is all that is passed on: it falls
    into stretches by the next word, of which those that are frequent are followed, depth first.
    """
    out, many = [], np.concatenate(([0], np.cumsum(weight)))

    def extend(prefix: tuple[int, ...], begin: int, end: int) -> None:
        own = columns[len(prefix)][begin:end]
        at = runs(own)
        ends = run_ends(at, len(own)) + begin
        at = at + begin
        f = many[ends] - many[at]
        wanted = f >= least if len(prefix) > 1 else np.ones(len(f), bool)  # other tasks may hold more of a hot pair
        wanted &= own[at - begin] > 0
        for b, e, k in zip(at[wanted].tolist(), ends[wanted].tolist(), f[wanted].tolist(), strict=True):
            phrase = (*prefix, int(own[b - begin]))
            if prefix:
                out.append((phrase, k))
            if len(phrase) < len(columns) and (k >= least or not prefix):
                extend(phrase, b, e)

    if len(weight):
        extend((), 0, len(weight))
    return out


def frequent(docs: DataFrame, least: int = 100, most: int = 5, blocks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(lang, word, token, f) of frequent words, and of every language the count of its words without word or token; and (tokens, f) of frequent phrases of 2 to ``most`` words.

    Texts lie in blocks (equal texts of a chunk once, with their number) and exchange packed
    hashes with shards, as blocks.py tells: which words may be frequent, then which pairs of
    such words. These are filters alone: hashes that fall together let more through. Then each
    occurrence of a frequent pair goes to the task of its prefix with the words that follow in
    frequent pairs, equal ones of a block once; there phrases grow to the right (see grow) and
    are counted exactly. Pairs with very many occurrences are dealt by the next word too, and
    what tasks count of such a pair is summed.
    """
    n = blocks or block_count(docs)
    dealt = docs.selectExpr("cast(lang as string) lang", "text").mapInArrow(_collapsed(n), _DEALT).groupBy("block")

    def replies(found: pa.Table, step: int) -> dict[int, bytes]:
        return {r["shard"]: r["flags"] for r in found.to_pylist() if r["step"] == step}

    @freed
    def send_words(key, found):
        block = Block(found, n)
        every, count, _ = block.counted(block.token, np.arange(len(block.token)))
        return table(_SENT, block.rows(key[0].as_py(), every, count))

    def judged(rows: list[dict], step: int, shard: int, hot: int | None) -> list[tuple]:
        """Each block's keys with 1 where all blocks' counts make up enough, or 2 where they make a hot key."""
        if not rows:
            return []
        own = [np.frombuffer(r["data"], "<u4") for r in rows]
        _, at = np.unique(np.concatenate(own), return_inverse=True)
        sums = np.bincount(at, np.concatenate([from_planes(r["counts"], "<u4") for r in rows]).astype(np.float64))
        flag = (sums >= least).astype(np.uint8)
        if hot:
            flag[sums >= max(hot, least)] = 2
        out, begin = [], 0
        for r, a in zip(rows, own, strict=True):
            told = flag[at[begin : begin + len(a)]]
            begin += len(a)
            if told.any():
                out.append((r["block"], step, shard, told.tobytes(), None, None, None, None))
        return out

    def summed(rows: list[dict]) -> list[tuple]:
        """Frequent words with their exact counts, and the words of each language in all."""
        of: dict[tuple, int] = {}
        for r in rows:
            if r["words"] is None:
                of[r["lang"], None, None] = of.get((r["lang"], None, None), 0) + int(np.frombuffer(r["counts"], "<i8")[0])
                continue
            for word, token, count in zip(r["words"].split(b"\n"), np.frombuffer(r["data"], "<i8").tolist(), from_planes(r["counts"], "<i8").tolist(), strict=True):
                of[r["lang"], word, token] = of.get((r["lang"], word, token), 0) + count
        return [(None, None, None, None, lang, word and word.decode(), token, f) for (lang, word, token), f in of.items() if word is None or f >= least]

    @freed
    def match_words(key, found):
        return table(_REPLY, judged(found.to_pylist(), 1, key[0].as_py(), None))

    @freed
    def match_pairs(key, found):
        rows = found.to_pylist()
        return table(_REPLY, judged([r for r in rows if r["lang"] is None], 2, key[0].as_py(), HOT) + summed([r for r in rows if r["lang"] is not None]))

    @freed
    def send_pairs(key, found, told):
        if not found.num_rows:
            return table(_SENT, [])
        block = Block(found, n)
        block.frequent(replies(told, 1))
        every, count, _ = block.counted(block.pair_hash, block.pair)
        return table(_SENT, block.listed(key[0].as_py()) + block.rows(key[0].as_py(), every, count))

    @freed
    def send_contexts(key, found, told):
        if not found.num_rows:
            return table(_CONTEXTS, [])
        block = Block(found, n)
        block.frequent(replies(told, 1))
        return table(_CONTEXTS, block.contexts(replies(told, 2), most))

    @freed
    def mine(key, found):
        tokens, codes, counts = [], [], []
        for r in found.to_pylist():
            tokens.append(np.frombuffer(r["tokens"], "<u8"))
            codes.append(from_planes(r["codes"], "<u4").reshape(most, -1))
            counts.append(from_planes(r["counts"], "<i8"))
        known = np.unique(np.concatenate(tokens))  # 0, no word, is the first
        columns = np.concatenate([np.searchsorted(known, t)[c] for t, c in zip(tokens, codes, strict=True)], axis=1)
        columns, weight, _ = _merged(list(columns), np.concatenate(counts), len(known))
        names, found = known.view(np.int64), grow(columns, weight, least)
        sizes = np.fromiter((len(p) for p, _ in found), np.int64, len(found))
        flat = np.fromiter((c for p, _ in found for c in p), np.int64, int(sizes.sum()))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(names[flat]))
        return pa.Table.from_arrays([lists, pa.array([k for _, k in found], pa.int64())], list(_GROWN))

    told = dealt.applyInArrow(send_words, _SENT_SQL).groupBy("shard").applyInArrow(match_words, _REPLY_SQL)
    both = cut(dealt.cogroup(told.groupBy("block")).applyInArrow(send_pairs, _SENT_SQL).groupBy("shard").applyInArrow(match_pairs, _REPLY_SQL).unionByName(told))
    words = both.filter("block is null").select("lang", "word", "token", "f")
    told = both.filter("block is not null").select("block", "step", "shard", "flags")
    contexts = dealt.cogroup(told.groupBy("block")).applyInArrow(send_contexts, _CONTEXTS_SQL)
    grown = cut(contexts.groupBy("shard").applyInArrow(mine, _GROWN_SQL))
    longer = grown.filter(F.size("tokens") > 2)
    twos = grown.filter(F.size("tokens") == 2).groupBy("tokens").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    return words, cut(longer.unionByName(twos))


def collocations(docs: DataFrame, least: int = 100, most: int = 5, top: int = 2000, blocks: int | None = None) -> DataFrame:
    """Each language's ``top`` phrases by cohesion: lang, rank, phrase, a, l, r, n, score.

    docs: lang, text; other columns are not read. Texts are cut into pieces at
    ``[.,;:!?\\x0A-\\x0D]`` and these into words at spaces and tabs, A-Z in lower case. A null
    language is ``und``; a null or empty text has no words; repeated rows count as often as
    they occur; an empty table gives no rows. Of a phrase of 2 to ``most`` words that occurs a
    times, ``least`` or more, each cut into a first part and a rest gives
    floor(1000 a n / (l r)), in exact numbers of 38 digits; the lowest counts, of equals that
    after the fewest words. Phrases inside a longer one of ``most`` words or fewer that occurs
    as often are left out: then one that is a word longer does so too.

    Counts of parts are joined by their words' hashes. Ranks within a language are cut off in
    every task before rows gather (equal score and count stay together until phrases decide).
    """
    words, phrases = frequent(docs, least, most, blocks)
    single = words.filter("word is not null").select(F.array("token").alias("tokens"), "f")
    parts = single.unionByName(phrases)
    size = F.size("tokens")
    place = F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    cuts = phrases.select("tokens", F.col("f").alias("a"), place)
    cuts = cuts.select("tokens", "a", "k", F.slice("tokens", F.lit(1), F.col("k")).alias("first"), F.slice("tokens", F.col("k") + 1, size - F.col("k")).alias("rest"))
    cuts = cuts.join(parts.select(F.col("tokens").alias("first"), F.col("f").alias("l")), "first").join(parts.select(F.col("tokens").alias("rest"), F.col("f").alias("r")), "rest")
    # phrases that one a word longer holds, as often
    held = cuts.filter((F.col("k") == 1) & (F.col("a") == F.col("r")) & (F.size("rest") > 1)).select(F.col("rest").alias("tokens"))
    held = held.unionByName(cuts.filter((F.col("k") == size - 1) & (F.col("a") == F.col("l")) & (F.size("first") > 1)).select(F.col("first").alias("tokens")))
    # every phrase has the language of its first word
    named = words.filter("word is not null").join(words.filter("word is null").select("lang", F.col("f").alias("n")), "lang").select("token", "lang", "n")
    exact = lambda x: x.cast("decimal(38,0)")
    whole = cuts.withColumn("token", F.element_at("tokens", 1)).join(named, "token")
    whole = whole.withColumn("above", exact(exact(1000 * F.col("a")) * exact(F.col("n")))).withColumn("below", exact(exact(F.col("l")) * exact(F.col("r"))))
    whole = whole.withColumn("score", F.expr("above div below").cast("long"))
    best = whole.groupBy("tokens", "lang", "n", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).join(held.distinct(), "tokens", "left_anti")
    best = best.select("tokens", "lang", "a", "cut.l", "cut.r", "n", "cut.score")
    leading = best.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))).filter(F.col("place") <= top).drop("place")
    leading = cut(leading)
    spelled = leading.select("tokens", F.posexplode("tokens").alias("i", "token")).join(words.select("token", "word"), "token")
    spelled = spelled.groupBy("tokens").agg(F.array_sort(F.collect_list(F.struct("i", "word"))).alias("words")).select("tokens", F.array_join("words.word", " ").alias("phrase"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    out = leading.join(spelled, "tokens").withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
