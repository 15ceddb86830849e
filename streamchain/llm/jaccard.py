"""N-gram Jaccard join: token-combination prefixes, then exact verification; and the groups that its links make."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import ascii_lower, chunks, freed, rolling, split_words, texts, word_hashes
from .blocks import block_count, blocked, by_shard, from_planes, keys, planes, runs, table
from .components import components, cut

_SENT_SQL = "shard int, block int, data binary, counts binary"
_SENT = {"shard": pa.int32(), "block": pa.int32(), "data": pa.binary(), "counts": pa.binary()}
_REPLY = {"block": pa.int32(), "shard": pa.int32(), "common": pa.binary(), "counts": pa.binary()}
_KEYS_SQL = "doc_id long, block int, n_shingles long, digest binary"
_INDEX = {"doc": pa.int64(), "n": pa.int32(), "prefix": pa.int32(), "tokens": pa.list_(pa.int64())}
_INDEX_SQL = "doc long, n int, prefix int, tokens array<long>"

#: With how many first members of entries a set is compared before all else.
HUBS = 3
#: An entry's pairs are compared when there are so few, or when longer combinations would take more than so many rows a pair.
FEW, ROWS_A_PAIR = 16, 16
#: All entries that are left are compared once they hold no more pairs than so many a row of the first ones: then their number is linear in the table.
LINEAR = 2
#: Combinations are taken for a division once they leave such a share of the entry's pairs.
DIVIDED = 0.25
#: Ratio of the bounds of a size class.
CLASS = 1.04


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, one text after the other; and where each text's begin (one entry more)."""
    first, words = split_words(ascii_lower(column))
    h = word_hashes(words)
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    left = first[doc + 1] - np.arange(len(h)) if len(h) else np.zeros(0, np.int64)
    at = np.flatnonzero(left >= size)
    token, owner = (rolling(h, size)[at], doc[at]) if len(at) else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):
        token = np.concatenate([token, [rolling(h[first[k] : first[k + 1]], int(n[k]), 7)[0] for k in short]]).astype(np.uint64)
        owner = np.concatenate([owner, short])
    order = np.lexsort((token, owner))
    token, owner = token[order], owner[order]
    if len(token):
        new = np.concatenate(([True], (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])))
        token, owner = token[new], owner[new]
    return token, np.searchsorted(owner, np.arange(len(n) + 1))


def _set_keys(size: int):
    def run(batches):
        for batch in chunks(batches):
            token, at = shingle_sets(texts(batch.column("text")), size)
            digests = [xxhash.xxh3_128_digest(token[at[k] : at[k + 1]].tobytes()) for k in range(len(at) - 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("block"), pa.array(np.diff(at), pa.int64()), pa.array(digests, pa.binary())], ["doc_id", "block", "n_shingles", "digest"])

    return run


def _representatives(docs: pa.Table, listed: pa.Table, size: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Ids and shingle sets of the block's rows that stand for all rows with the same set."""
    wanted = {(d, x) for d, x in zip(listed.column("doc_id").to_pylist(), listed.column("digest").to_pylist(), strict=True) if x is not None}
    ids = docs.column("doc_id").to_pylist()
    may = {d for d, _ in wanted}
    rows = [k for k, d in enumerate(ids) if d in may]
    token, at = shingle_sets(texts(docs.column("text")).take(pa.array(rows, pa.int64())), size)
    kept, parts = [], []
    for k, row in enumerate(rows):
        own = token[at[k] : at[k + 1]]
        if (key := (ids[row], xxhash.xxh3_128_digest(own.tobytes()))) in wanted:
            wanted.discard(key)
            kept.append(ids[row])
            parts.append(own)
    return kept, np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.cumsum([0, *map(len, parts)])


def _indexed(docs: DataFrame, listed: DataFrame, size: int, percent: int, blocks: int) -> DataFrame:
    """The listed sets that share a shingle of their prefix with another one: doc, n (size), the shingles that others have too, from rare to frequent, and how many of these lie in the prefix.

    The order is that of (how many sets have it, hash). Shingles of one set alone come first in
    it and can't be shared: they count as places, but aren't kept. The prefix is that of
    n - ceil(percent n / 100) + 1 shingles, which hold the first common one of any linked pair.
    """
    dealt = docs.groupBy("block")

    @freed
    def send(key, found, rows):
        _, token, _ = _representatives(found, rows, size)
        every = np.sort(keys(token, blocks))
        begins = runs(every)
        count = np.minimum(np.diff(np.append(begins, len(every))), 255).astype(np.uint8)
        every = every[begins]
        low = (every & np.uint64(0xFFFFFFFF)).astype("<u4")
        return table(_SENT, [(s, key[0].as_py(), low[b:e].tobytes(), count[b:e].tobytes()) for s, b, e in zip(*by_shard(every), strict=True)])

    @freed
    def total(key, found):
        rows = found.to_pylist()
        own = [np.frombuffer(r["data"], "<u4") for r in rows]
        _, at = np.unique(np.concatenate(own), return_inverse=True)
        sums = np.bincount(at, np.concatenate([np.frombuffer(r["counts"], np.uint8) for r in rows])).astype("<u4")
        out, begin = [], 0
        for r, a in zip(rows, own, strict=True):
            count = sums[at[begin : begin + len(a)]]
            begin += len(a)
            if (common := count > 1).any():
                out.append((r["block"], key[0].as_py(), np.packbits(common).tobytes(), planes(count[common])))
        return table(_REPLY, out)

    @freed
    def index(key, found, rows):
        kind = rows.column("digest").is_null()
        ids, token, at = _representatives(found, rows.filter(pc.invert(kind)), size)
        replies = {r["shard"]: (r["common"], r["counts"]) for r in rows.filter(kind).select(["shard", "common", "counts"]).to_pylist()}
        own = keys(token, blocks)
        every, back = np.unique(own, return_inverse=True)
        count = np.ones(len(every), np.int64)
        for shard, begin, end in zip(*by_shard(every), strict=True):
            if shard in replies:
                common = np.unpackbits(np.frombuffer(replies[shard][0], np.uint8), count=end - begin).astype(bool)
                count[begin:end][common] = from_planes(replies[shard][1], "<u4")
        count = count[back]
        out = []
        for k, doc in enumerate(ids):
            own, held = token[at[k] : at[k + 1]], count[at[k] : at[k + 1]]
            n, many = len(own), held > 1
            kept = own[many][np.lexsort((own[many], held[many]))]
            prefix = n - (-(-n * percent // 100)) + 1 - (n - len(kept))
            if prefix > 0:
                out.append((doc, n, prefix, kept.view(np.int64)))
        return table(_INDEX, out)

    sent = dealt.cogroup(listed.groupBy("block")).applyInArrow(send, _SENT_SQL)
    counted = sent.groupBy("shard").applyInArrow(total, "block int, shard int, common binary, counts binary")
    both = listed.select("block", "doc_id", "digest").unionByName(counted, allowMissingColumns=True)
    return dealt.cogroup(both.groupBy("block")).applyInArrow(index, _INDEX_SQL)


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets share ``percent`` of their union."""
    left = pairs.join(sets.select(F.col("doc").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("other")), "b")
    both = left.join(sets.select(F.col("doc").alias("a"), "n", "tokens"), "a")
    share = F.size(F.array_intersect("tokens", "other"))
    return both.filter(100 * share >= percent * (F.col("n") + F.col("n_b") - share)).select("a", "b")


def _fits(k, n, place, m, other, percent: int):
    """Whether sets of n and m can still link if these places hold their k-th common shingle: they share no more than k and what comes after it in either."""
    return (F.least(n - place, m - other) + k - 1) * (100 + percent) >= percent * (n + m)


def _stats(rows: DataFrame) -> DataFrame:
    """By root and signature, of those with members in several components: members, pairs across components, rows that longer combinations would make, shared shingles that these could still have, and the largest component. Pre-aggregated by component."""
    room = F.greatest(F.col("n") - F.col("least") + F.col("k") - F.col("place"), F.lit(0))
    some = rows.groupBy("root", "signature", "component").agg(F.count("*").alias("c"), F.sum(room).alias("room"), F.min(F.col("least") - F.col("k")).alias("spare"))
    each = some.groupBy("root", "signature").agg(F.sum("c").alias("m"), F.sum(F.col("c").cast("double") ** 2).alias("square"), F.sum("room").alias("room"), F.min("spare").alias("spare"), F.max_by("component", "c").alias("main"), F.count("*").alias("parts"))
    return each.filter("parts > 1").select("root", "signature", "m", "main", "room", "spare", ((F.col("m").cast("double") ** 2 - F.col("square")) / 2).alias("pairs"))


def _cells(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of cells of an entry (members of one size and place, of the largest component or not) that may hold linked ones: signature, a, b, and the counts of both."""
    cells = rows.groupBy("root", "signature", "k", F.struct("n", "place", (F.col("component") == F.col("main")).alias("own")).alias("cell")).count()
    left, right = (cells.select("root", "signature", *["k"][:only], F.col("cell").alias(s), F.col("count").alias(f"n_{s}")) for s, only in (("a", 1), ("b", 0)))
    turn = F.when(F.col("a.own"), ~F.col("b.own")).otherwise(~F.col("b.own") & (F.col("a") <= F.col("b")))
    fits = _fits(F.col("k"), F.col("a.n"), F.col("a.place"), F.col("b.n"), F.col("b.place"), percent)
    return left.join(right, ["root", "signature"]).filter(turn & fits).select("root", "signature", "a", "b", "n_a", "n_b")


def _fitting(rows: DataFrame, stats: DataFrame, percent: int) -> DataFrame:
    """The stats with only those pairs counted that places and sizes don't rule out; entries without any are left out."""
    cells = _cells(rows.join(stats.select("root", "signature", "main"), ["root", "signature"]), percent)
    many = F.when(F.col("a") == F.col("b"), F.col("n_a").cast("double") * (F.col("n_a") - 1) / 2).otherwise(F.col("n_a").cast("double") * F.col("n_b"))
    fitting = cells.groupBy("root", "signature").agg(F.sum(many).alias("pairs")).filter("pairs > 0")
    return stats.drop("pairs").join(fitting, ["root", "signature"])


def _plain(pairs, room, spare):
    """Whether to compare an entry's pairs rather than to divide it."""
    return (pairs <= FEW) | (room > pairs * ROWS_A_PAIR) | (spare <= 0)


def _divided(rows: DataFrame, sets: DataFrame, percent: int) -> Iterator[DataFrame]:
    """Pairs (a, b) to compare, of entries whose members (doc, n, component, least, k, signature, place) lie in several components.

    An entry that is not compared as it is is a root: its members go under longer and longer
    combinations, until these leave few of its pairs (each combination is a root then), or have
    taken as many rows as its pairs are worth (it is compared as it is after all), or no two
    members are left under any.
    """
    base = cut(rows.withColumn("root", F.col("signature")))  # members of roots, as they are compared
    most = LINEAR * base.count()
    stats = cut(_stats(base))
    plain = stats.select("root", "m", "main", "pairs", _plain(F.col("pairs"), F.col("room"), F.col("spare")).alias("plain"), F.col("room").alias("spent"))
    first = True
    while True:
        base = base.join(plain, "root")
        if (plain.filter("not plain").agg(F.sum("pairs")).first()[0] or 0) <= most:
            base = base.withColumn("plain", F.lit(True))
        base = cut(base)
        yield _across(base.filter("plain"), percent)
        base = base.filter("not plain")
        if base.isEmpty():
            return
        if first:  # sizes divide an entry without more rows than a few a member
            base = cut(_by_size(base.drop("m", "main", "plain", "pairs", "spent"), percent).withColumn("root", F.col("signature")))
            stats = cut(_fitting(base, _stats(base), percent))
            plain = stats.select("root", "m", "main", "pairs", _plain(F.col("pairs"), F.col("room"), F.col("spare")).alias("plain"), F.col("room").alias("spent"))
            first, rows = False, base
            continue
        rows = cut(_longer(rows.join(base.select("root").distinct(), "root", "left_semi"), sets))
        stats = cut(_fitting(rows, _stats(rows), percent))
        roots = base.groupBy("root").agg(F.first("pairs").alias("whole"), F.first("spent").alias("spent"), F.first("m").alias("whole_m"), F.first("main").alias("whole_main"))
        sums = stats.groupBy("root").agg(F.sum("pairs").alias("left"), F.sum("room").alias("more"), F.min("spare").alias("spare"))
        judged = cut(roots.join(sums, "root").withColumn("divided", F.col("left") <= F.col("whole") * DIVIDED))
        new = stats.join(judged.filter("divided").select("root"), "root", "left_semi")
        over = (F.col("spent") + F.col("more") > F.col("whole") * ROWS_A_PAIR) | (F.col("spare") <= 0)
        old = judged.filter("not divided").select("root", F.col("whole_m").alias("m"), F.col("whole_main").alias("main"), F.col("whole").alias("pairs"), over.alias("plain"), (F.col("spent") + F.col("more")).alias("spent"))
        names = ["doc", "n", "component", "least", "k", "signature", "place", "root"]
        moved = rows.join(new.select("root", "signature"), ["root", "signature"], "left_semi").withColumn("root", F.col("signature"))
        rows = cut(moved.select(*names).unionByName(rows.join(old.filter("not plain").select("root"), "root", "left_semi").join(stats.select("root", "signature"), ["root", "signature"], "left_semi").select(*names)))
        base = moved.select(*names).unionByName(base.join(old.select("root"), "root", "left_semi").select(*names))
        fresh = new.select(F.col("signature").alias("root"), "m", "main", "pairs", _plain(F.col("pairs"), F.col("room"), F.col("spare")).alias("plain"), F.col("room").alias("spent"))
        plain = fresh.unionByName(old)


def _across(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of an entry's members in different components that places and sizes don't rule out: joined by cells, so that no others are ever made."""
    cells = _cells(rows, percent).select("signature", "a", "b")
    members = rows.select("signature", F.struct("n", "place", (F.col("component") == F.col("main")).alias("own")).alias("cell"), "doc", "component")
    left, right = (members.select("signature", F.col("cell").alias(s), F.col("doc").alias(f"doc_{s}"), F.col("component").alias(f"component_{s}")) for s in ("a", "b"))
    both = left.join(cells, ["signature", "a"]).join(right, ["signature", "b"]).filter("component_a <> component_b and (a <> b or doc_a < doc_b)")
    return both.select(F.least("doc_a", "doc_b").alias("a"), F.greatest("doc_a", "doc_b").alias("b"))


def _by_size(rows: DataFrame, percent: int) -> DataFrame:
    """Members of entries, dealt by their own size class and that of a partner: for each class that a partner can be of, with the least that they must share."""
    n, place = F.col("n"), F.col("place")
    kind = lambda c: F.floor(F.log(c.cast("double")) / F.log(F.lit(CLASS))).cast("int")
    low = F.ceil(n * percent / 100).cast("int")
    # a partner has what both share, no more than comes from this place on
    high = F.least(F.floor(n * 100 / percent), F.floor((n - place) * (100 + percent) / percent) - n).cast("int")
    classes = F.when(high >= low, F.sequence(kind(low), kind(high)))
    out = rows.withColumn("other", F.explode(classes)).withColumn("own", kind(n))
    smallest = F.greatest(low, F.floor(F.pow(F.lit(CLASS), F.col("other")) * (1 - 1e-9)).cast("int"))
    out = out.withColumn("least", F.ceil((n + smallest) * percent / (100 + percent)).cast("int")).filter(place <= n - F.col("least"))
    signature = F.xxhash64("signature", F.least("own", "other"), F.greatest("own", "other"))
    return out.withColumn("signature", signature).drop("own", "other", "root")


def _longer(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Members of entries under combinations of one shingle more: each of those at places where the next common one can be."""
    held = rows.join(sets.select("doc", "tokens"), "doc")
    skipped = F.col("n") - F.size("tokens")  # places of shingles that no other set has
    next_ = F.slice("tokens", F.col("place") - skipped + 2, F.greatest(F.col("n") - F.col("least") + F.col("k") - F.col("place"), F.lit(0)))
    more = held.select("root", "doc", "n", "component", "least", (F.col("k") + 1).alias("k"), "signature", F.col("place").alias("last"), F.posexplode(next_).alias("i", "token"))
    return more.select("root", "doc", "n", "component", "least", "k", F.xxhash64("signature", "token").alias("signature"), (F.col("last") + 1 + F.col("i")).alias("place"))


def join(spark: SparkSession, docs: DataFrame, size: int = 4, percent: int = 85, blocks: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest id that a document reaches by links.

    docs: doc_id, text; other columns are not read. A set has the distinct shingles of ``size``
    successive words, A-Z in lower case; fewer words make one shingle; a text without words, or
    a null one, has none and links with nothing. Documents link when they share ``percent`` of
    the union of their sets. Rows without id link with nothing and have no component. Repeated
    rows give a row each; an empty table gives none.

    Rows with equal sets are one class, for which its smallest id stands. Representatives send
    their shingles to shards (packed, see blocks) and learn how many others have each. Ordered
    from rare to frequent, the shingles of a prefix of each set are its index entries. A set is
    first compared with the members of its entries that have the fewest rarer shingles, which
    in a group of near copies are nearest to their common source: so such a group costs a few
    comparisons a member, and is one component from then on. Where an entry still has members
    in different components, their pairs are compared if they are few beside the rows that
    longer combinations make. Else the entry is divided: by the sizes of both partners, and
    then by ever longer combinations of shingles, whose places these sizes bound the more (see
    _divided). Linked sets meet in every division, since those under their first common
    shingles are among it.
    """
    count = blocks or block_count(docs)
    docs = blocked(docs, count)
    found = cut(docs.mapInArrow(_set_keys(size), _KEYS_SQL))
    classes = found.filter("n_shingles > 0 and doc_id is not null").groupBy("digest").agg(F.min(F.struct("doc_id", "block")).alias("first"))
    index = cut(_indexed(docs, classes.select("first.doc_id", "first.block", "digest"), size, percent, count))
    sets = index.select("doc", "n", "tokens")

    tokens = index.select("doc", "n", (F.col("n") - F.size("tokens")).alias("skipped"), F.posexplode(F.slice("tokens", F.lit(1), F.col("prefix"))).alias("i", "signature"))
    entries = tokens.select("doc", "n", (F.col("skipped") + F.col("i")).alias("place"), "signature")
    hubs = entries.groupBy("signature").agg(F.min(F.struct("place", "doc", "n")).alias("hub"), F.count("*").alias("m")).filter("m > 1").select("signature", "hub")
    starred = entries.join(hubs, "signature").filter("doc <> hub.doc").filter(_fits(F.lit(1), F.col("n"), F.col("place"), F.col("hub.n"), F.col("hub.place"), percent))
    # of a set's many hubs, those that it shares most entries with; as many as its prefix has at most
    best = starred.groupBy("doc", F.col("hub.doc").alias("hub")).count().groupBy("doc").agg(F.slice(F.sort_array(F.collect_list(F.struct("count", "hub")), asc=False), 1, HUBS).alias("hubs"))
    tried = best.select("doc", F.explode("hubs.hub").alias("hub")).select(F.least("hub", "doc").alias("a"), F.greatest("hub", "doc").alias("b")).distinct()
    links = cut(_similar(tried, sets, percent))
    part = components(spark, links)

    least = F.ceil(F.col("n") * percent / 100).cast("int")
    named = index.join(part.withColumnRenamed("node", "doc"), "doc", "left").select("doc", "n", "prefix", "tokens", F.coalesce("component", "doc").alias("component"))
    tokens = named.select("doc", "n", "component", (F.col("n") - F.size("tokens")).alias("skipped"), F.posexplode(F.slice("tokens", F.lit(1), F.col("prefix"))).alias("i", "signature"))
    rows = tokens.select("doc", "n", "component", least.alias("least"), F.lit(1).alias("k"), "signature", (F.col("skipped") + F.col("i")).alias("place"))
    pairs = reduce(DataFrame.unionByName, (cut(some.distinct()) for some in _divided(rows, sets, percent)))
    part = components(spark, links.union(_similar(pairs.distinct(), sets, percent)))
    named = classes.select("digest", "first.doc_id").join(part.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("digest", F.coalesce("component", "doc_id").alias("group"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("group", "doc_id"))
    return found.join(named, "digest", "left").select("doc_id", "n_shingles", component.alias("component_id"))
