"""Merging of redundant inputs, deduplication, and heads of logs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.msgid import construct
from ..sources.checkpoint import cut
from . import prefix
from .sink import FEW_STREAMS, on_keys


def first_per(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row, by ``order``, of each key; partly aggregated before the shuffle, so a hot key moves a row a task."""
    rest = [c for c in log.columns if c not in keys]
    best = log.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("row"))
    return best.select(*keys, "row.*").select(*log.columns)


def deduplicate(log: DataFrame) -> DataFrame:
    """Of rows with one message id in a stream, the first."""
    log = log.withColumn("msg_id", construct(F.col("height"), F.col("block_type"), F.col("shard_id")))
    return first_per(log, ["stream_id", "msg_id"], ["seq"])


def deduplicate_within(log: DataFrame, seconds: float = 120.0, segment: int = prefix.SEGMENT) -> DataFrame:
    """The rows of a stream whose message id no kept row of the ``seconds`` before has: after the window, a copy is a new message.

    Rows of one id that follow each other within the window are a run. A run's first row is
    kept, and the others within the window of it are not. Only what a run has beyond that
    depends on which rows are kept on the way: those rows alone are walked, in order of seq.
    """
    rows = log.withColumn("msg_id", construct(F.col("height"), F.col("block_type"), F.col("shard_id"))).withColumn("at_", F.unix_micros(F.col("ts").cast("timestamp")))
    key, window = ("stream_id", "msg_id"), round(seconds * 1e6)
    rows = prefix.before(prefix.segmented(rows, segment=segment, by=key), {"last_": ("last", F.col("at_"))}, by=key)
    opens = F.coalesce(F.col("at_") - F.col("last_") >= window, F.lit(True))
    rows = prefix.before(rows.withColumn("opens_", opens), {"begun_": ("last", F.when(opens, F.col("at_")))}, by=key).drop("__segment")

    def walk(batches):
        run, kept_at = None, 0
        for batch in batches:
            kept = []
            for stream, msg_id, begun, at in zip(*(batch.column(c).to_pylist() for c in ("stream_id", "msg_id", "begun_", "at_")), strict=True):
                if run != (stream, msg_id, begun):
                    run, kept_at = (stream, msg_id, begun), begun
                kept.append(at - kept_at >= window)
                kept_at = at if kept[-1] else kept_at
            yield batch.filter(pa.array(kept, pa.bool_()))

    late = rows.filter(~F.col("opens_") & (F.col("at_") - F.col("begun_") >= window))
    late = late.repartition(*key, "begun_").sortWithinPartitions(*key, "begun_", "seq").mapInArrow(walk, rows.schema)
    return rows.filter("opens_").unionByName(late).select(*log.columns, "msg_id")


#: What a candidate's turn in its chain depends on, and its stream.
TURN = ("stream_id", "height", "input_id", "seq")
#: Heights of a stretch of candidates, which a task walks at a time.
STRETCH = 1 << 16
#: Candidates that a task sorts, about.
PLACED = 1 << 20


def placed(inputs: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """The rows dealt by stretches of heights, to as many tasks as their number asks for. A merge uses that where it is there: rows may be dealt while they are still narrow."""
    if "__segment" in inputs.columns:
        return inputs
    return _dealt(prefix.segmented(inputs, "height", stretch), inputs)


def _dealt(rows: DataFrame, like: DataFrame) -> DataFrame:
    """Rows dealt by their stretch, as many as ``like`` has."""
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-like.count() // PLACED)), "__segment")


def _runs(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple]:
    """Stretches' rows in turn: (stream_id, number), the batch and the run's place in it, and lists of the columns; a run ends with its stretch or batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        number = batch.column("n").to_numpy(zero_copy_only=False)
        stream = batch.column("stream_id").dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        begins = [0, *(np.flatnonzero((number[1:] != number[:-1]) | (stream[1:] != stream[:-1])) + 1).tolist(), batch.num_rows]
        for begin, end in zip(begins, begins[1:], strict=False):
            key = (batch.column("stream_id")[begin].as_py(), int(number[begin]))
            yield key, batch, begin, end, [batch.column(c).slice(begin, end - begin).to_pylist() for c in columns]


def _judged(inputs: DataFrame, bad: Column, names: list[str], start_height: int, contiguous: bool, hash_ci: bool, stretch: int, segment: int, written_only: bool = False) -> DataFrame:
    """The rows that have a height, as ``names``, each with what becomes of it as a candidate (kind): corrupted where it is ``bad``, written, low, high or mismatch.

    A walk in turn needs no more than the head. Rows are dealt by stretches of heights, and tasks
    walk these side by side, in three passes over sorted rows, of which a task keeps none:
    what a stretch may be left with (heads that nothing in it follows, and where a chain that
    begins in it leaves it); where each of those hashes that enters a later stretch leaves that;
    and, once the heads that the chain does enter its stretches with are known, each row's kind.
    """
    folded = (lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))) if hash_ci else (lambda c: F.coalesce(F.col(c), F.lit("")))
    rows = placed(inputs.filter("height is not null"), stretch).withColumn("__bad", bad)
    kept = {"stream_id": F.col("stream_id"), "n": F.col("__segment.n"), "height": F.col("height"), "__hash": folded("hash"), "__prev": folded("prev_hash")}
    turn = ("__segment", "height", "input_id", "seq", "hash", "prev_hash")  # all passes must see rows of one turn in the same order
    stream = inputs.schema["stream_id"]
    fields = lambda *named: T.StructType([stream, *[T.StructField(c, T.StringType() if c.endswith("hash") else T.LongType()) for c in named]])
    fits = (lambda h, height: h == height - 1) if contiguous else (lambda h, height: h < height)

    def table(found: list[tuple], result: T.StructType, batch: pa.RecordBatch) -> pa.RecordBatch:
        kinds = [batch.schema.field("stream_id").type, *[pa.string() if c.endswith("hash") else pa.int64() for c in result.names[1:]]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True) if found else [[]] * len(kinds), kinds, strict=True)], result.names)

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, heads, begun, top, batch = None, {}, None, None, None

        def left() -> list[tuple]:
            begins = (*at, 1, *(begun or (None, None)))
            return [begins, *[(*at, 0, h, x) for x, found in heads.items() for h in found if not contiguous or h == top]]

        for key, batch, _, _, columns in _runs(batches, ("height", "__hash", "__prev")):
            if key != at:
                if at:
                    yield table(left(), exits_schema, batch)
                at, heads, begun = key, {}, None
            for height, x, prev in zip(*columns, strict=True):
                found = heads.get(prev)
                if found:
                    heads[prev] = found = [h for h in found if h >= height]  # a lower one is followed, or nothing will follow it
                    if not found:
                        del heads[prev]
                found = heads.setdefault(x, [])
                if not found or found[-1] != height:
                    found.append(height)
                if begun is None:
                    begun = (height, x) if not start_height or height == start_height else None
                elif prev == begun[1] and fits(begun[0], height):
                    begun = (height, x)
                top = height
        if at:
            yield table(left(), exits_schema, batch)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, heads, entered, batch = None, {}, {}, None
        left = lambda: [(*at, x, entered[x], h, out) for out, found in heads.items() for h, those in found.items() for x in those]
        for key, batch, _, _, columns in _runs(batches, ("height", "__hash", "__prev", "asked")):
            if key != at:
                if entered:
                    yield table(left(), ways_schema, batch)
                at, heads, entered = key, {}, {}
            for height, x, prev, asked in zip(*columns, strict=True):
                found = heads.get(prev)
                moved = [found.pop(h) for h in [h for h in found if fits(h, height)]] if found else []
                if moved and not found:
                    del heads[prev]
                if asked and prev not in entered:
                    entered[prev] = height
                    moved.append([prev])
                if moved:
                    there = heads.setdefault(x, {})
                    moved = sorted([*moved, there.get(height, [])], key=len, reverse=True)
                    there[height] = moved[0]
                    for more in moved[1:]:
                        moved[0].extend(more)
        if entered:
            yield table(left(), ways_schema, batch)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, last, kinds = None, None, []
        for key, batch, begin, end, columns in _runs(batches, ("height", "__prev", "__hash", "__bad")):
            if key != at:
                at, last = key, batch.column("__head")[begin].as_py()
                last = last and (last["height"], last["hash"])
            for height, prev, x, bad in zip(*columns, strict=True):
                if bad:
                    kinds.append("corrupted")
                    continue
                if last is None:
                    kind = "low" if height < start_height else "high" if start_height and height > start_height else "written"
                elif height <= last[0]:
                    kind = "low"
                elif contiguous and height > last[0] + 1:
                    kind = "high"
                else:
                    kind = "written" if prev == last[1] else "mismatch"
                if kind == "written":
                    last = (height, x)
                kinds.append(kind)
            if end == batch.num_rows:
                out = pa.RecordBatch.from_arrays([*[batch.column(f"_{c}") for c in names], pa.array(kinds, pa.string())], [*names, "kind"])
                yield out.filter(pc.equal(out.column("kind"), "written")) if written_only else out
                kinds = []

    node = ["stream_id", "n", "height", "hash"]
    exits_schema, ways_schema = fields("n", "begins", "height", "hash"), fields("n", "enter_hash", "at", "height", "hash")
    could = rows.filter(~F.col("__bad") & (F.col("height") >= start_height))
    exits = cut(could.sortWithinPartitions(*turn).select(*[c.alias(k) for k, c in kept.items()]).mapInArrow(leave, exits_schema).repartition("stream_id", "n"))  # a cut computes twice what comes after the last shuffle
    begins = exits.filter("begins = 1 and height is not null").groupBy("stream_id").agg(F.min_by(F.struct(*node[1:]), "n").alias("first")).select("stream_id", "first.*")
    ends = exits.filter("begins = 0").select(*node)
    asked = ends.select("stream_id", F.col("hash").alias("__prev")).distinct().withColumn("asked", F.lit(True))
    few = asked.limit(FEW_STREAMS + 1).count() <= FEW_STREAMS
    linked = on_keys(could.withColumn("__prev", kept["__prev"]), F.broadcast(asked) if few else asked, ["stream_id", "__prev"])
    linked = linked if few else _dealt(linked, inputs)
    ways = cut(linked.sortWithinPartitions(*turn).select(*[c.alias(k) for k, c in kept.items() if k != "__prev"], "__prev", F.coalesce("asked", F.lit(False)).alias("asked")).mapInArrow(enter, ways_schema).repartition("stream_id", "n"))
    # a head that a stretch is left with is asked for the least later stretch that its hash enters: those stand at 2 n, heads at 2 n + 1
    into = F.struct("n", "at", "height", "hash")
    given = ways.select("stream_id", F.col("enter_hash").alias("link"), (2 * F.col("n")).alias("place"), *[F.lit(None).cast(t).alias(c) for c, t in (("n", "long"), ("height", "long"), ("hash", "string"))], into.alias("into"))
    sought = ends.select("stream_id", F.col("hash").alias("link"), (2 * F.col("n") + 1).alias("place"), *node[1:], F.lit(None).cast(given.schema["into"].dataType).alias("into"))
    both = prefix.before(sought.unionByName(given), {"next": ("last", F.col("into"))}, by=("stream_id", "link"), order="place", segment=segment, descending=True)
    steps = both.filter("into is null and next is not null" + (" and next.at = height + 1" if contiguous else ""))
    left = _reached(steps.select(*node, *[F.col(f"next.{c}").alias(f"to_{c}") for c in node[1:]]), begins)
    # each stretch is entered with the head that the chain has left the last one before it with
    heads = left.select("stream_id", (2 * F.col("n") + 1).alias("place"), F.lit(None).cast("long").alias("n"), F.struct("height", "hash").alias("left"))
    stretches = exits.filter("begins = 1").select("stream_id", (2 * F.col("n")).alias("place"), "n", F.lit(None).cast(heads.schema["left"].dataType).alias("left"))
    entered = prefix.before(heads.unionByName(stretches), {"__head": ("last", F.col("left"))}, order="place", segment=segment).filter("n is not null and __head is not null")
    entered = cut(entered.select(F.struct("stream_id", "n").alias("__segment"), "__head"))
    few = entered.limit(FEW_STREAMS + 1).count() <= FEW_STREAMS
    met = rows.join(F.broadcast(entered) if few else entered, "__segment", "left")
    met = met if few else _dealt(met, inputs)
    result = T.StructType([*[inputs.schema[c] for c in names], T.StructField("kind", T.StringType())])
    return met.sortWithinPartitions(*turn).select(*[c.alias(k) for k, c in kept.items()], "__bad", "__head", *[F.col(c).alias(f"_{c}") for c in names]).mapInArrow(judge, result)


def _reached(steps: DataFrame, begins: DataFrame) -> DataFrame:
    """All heads (stream_id, n, height, hash) that steps (to_n, to_height, to_hash) lead to from where chains begin, those too; by doubled steps."""
    node = ["stream_id", "n", "height", "hash"]
    to = ["stream_id", *[f"to_{c}" for c in node[1:]]]
    reached, steps, many = cut(begins), cut(steps), -1
    while (n := reached.count()) != many:
        many = n
        on = on_keys(reached, steps, node, "inner").select("stream_id", *[F.col(c).alias(k) for k, c in zip(node[1:], to[1:], strict=True)])
        reached = cut(reached.unionByName(on).distinct())
        further = steps.select("stream_id", *[F.col(k).alias(c) for k, c in zip(node[1:], to[1:], strict=True)], *[F.col(c).alias(f"then_{c}") for c in to[1:]])
        steps = cut(on_keys(steps, further, to, "inner").select(*node, *[F.col(f"then_{c}").alias(c) for c in to[1:]]))
    return reached


def merged(inputs: DataFrame, start_height: int = 0, contiguous: bool = False, hash_ci: bool = False, stretch: int = STRETCH, segment: int = prefix.SEGMENT, columns: tuple[str, ...] | None = None) -> DataFrame:
    """One chain from several inputs (input_id): candidates come by (height, input_id, seq), and one is taken if it is higher than the head and its prev_hash is the head's hash.

    Others are passed over, so where an input has a bad block, the next input's good one is
    taken. The first candidate begins the chain; with a ``start_height``, the first one of that
    height. ``contiguous`` takes no block but that of the next height; ``hash_ci`` compares
    hashes in lower case. A missing hash is an empty one; rows without height don't count.
    ``columns``: those that are given out, if not all; others don't move. Rows move once a pass
    (see ``_judged``) unless they are ``placed``, and nothing is kept of them.
    """
    names = list(columns or [c for c in inputs.columns if c != "__segment"])
    return _judged(inputs, F.lit(False), names, start_height, contiguous, hash_ci, stretch, segment, written_only=True).drop("kind")


def heads(log: DataFrame) -> DataFrame:
    """stream_id with seq, height and hash of its last row."""
    last = log.groupBy("stream_id").agg(F.max_by(F.struct("seq", "height", "hash"), "seq").alias("head"))
    return last.select("stream_id", "head.*")


def write_check(rows: DataFrame, head: DataFrame, start_height: int = 0, contiguous: bool = False, hash_ci: bool = False) -> DataFrame:
    """The rows with the status of appending each to its stream's head (stream_id, head_height, head_hash, known).

    A head that isn't known makes the outputter unavailable; one without a block (null height)
    takes the start height alone, or anything if that is 0.
    """
    both = on_keys(rows, head, ["stream_id"])
    folded = (lambda c: F.lower(F.col(c))) if hash_ci else F.col
    empty = F.col("head_height").isNull()
    status = F.when(~F.coalesce("known", F.lit(False)), "OutputterUnavailable")
    if start_height:
        status = status.when(empty & (F.col("height") < start_height), "LowBlock").when(empty & (F.col("height") > start_height), "HighBlock")
    status = status.when(empty, "OK").when(F.col("height") <= F.col("head_height"), "LowBlock")
    if contiguous:
        status = status.when(F.col("height") - F.col("head_height") > 1, "HighBlock")
    status = status.when(~folded("head_hash").eqNullSafe(folded("prev_hash")), "HashMismatch").otherwise("OK")
    return both.withColumn("status", status).drop("head_height", "head_hash", "known")


#: How far from an input's end, or from the target, a row may be to count as close. Fixed value.
CLOSE = 100


def target_height(head: DataFrame, start_height: int) -> DataFrame:
    """stream_id and the height that an output wants next: after its head's, or the start height while it is empty (null head_height)."""
    return head.select("stream_id", F.coalesce(F.col("head_height") + 1, F.lit(start_height).cast("long")).alias("target_height"))


def is_close(target: Column, known_seq: Column, close: int = CLOSE) -> Column:
    """Whether a row shows that an input is at work near its target: not above it, and near it or near the input's known end."""
    return (F.col("height") <= target) & (F.least(target - F.col("height"), known_seq - F.col("seq")) <= close)


def input_counts(rows: DataFrame, target: Column) -> DataFrame:
    """By input: rows, those that the header rule skips, and those handled."""
    skipped = F.col("height") < target
    return rows.groupBy("input_id").agg(F.count("*").alias("rows"), F.count_if(skipped).alias("skipped"), F.count_if(~F.coalesce(skipped, F.lit(False))).alias("handled"))


def merge_counts(inputs: DataFrame, chain: DataFrame | None = None, start_height: int = 0, contiguous: bool = False, hash_ci: bool = False, segment: int = prefix.SEGMENT, stretch: int = STRETCH) -> DataFrame:
    """By input, what became of its rows as candidates for a chain: handled, corrupted, written, low, high and mismatch.

    A row is judged against the chain's head when its turn comes, by (height, input_id, seq):
    the last chain row of a smaller height, or of its own height from an earlier turn. Rows
    marked as corrupted, or without height, have no block to judge. Without a ``chain``, it is the
    one that ``merged`` gives of the other rows, which are counted as they are walked.
    """
    marked = F.coalesce("corrupted", F.lit(False)) if "corrupted" in inputs.columns else F.lit(False)
    if chain is None:
        rows = _judged(inputs, marked, ["input_id"], start_height, contiguous, hash_ci, stretch, segment)
        rows = rows.unionByName(inputs.filter("height is null").select("input_id", F.lit("corrupted").alias("kind")))
    else:
        rows = _against(inputs, marked, chain, start_height, contiguous, hash_ci, segment)
    count = lambda k: F.count_if(F.col("kind") == k).alias(k)
    return rows.groupBy("input_id").agg(F.count("*").alias("handled"), *[count(k) for k in ("corrupted", "written", "low", "high", "mismatch")])


def _against(inputs: DataFrame, marked: Column, chain: DataFrame, start_height: int, contiguous: bool, hash_ci: bool, segment: int) -> DataFrame:
    """input_id and kind of the rows, judged against a chain that is there."""
    folded = (lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))) if hash_ci else (lambda c: F.coalesce(F.col(c), F.lit("")))
    taken = chain.select(F.struct(*TURN).alias("turn_"), F.lit(True).alias("taken_"))
    rows = inputs.select(*TURN, "hash", "prev_hash", (F.col("height").isNull() | marked).alias("bad_"))
    rows = rows.withColumn("turn_", F.struct(*TURN)).join(taken, "turn_", "left").drop("turn_")
    rows = prefix.segmented(rows, "height", segment)
    head = F.when(F.col("taken_"), F.struct(F.col("height").alias("h"), folded("hash").alias("x"), F.col("input_id").alias("i"), F.col("seq").alias("q")))
    rows = prefix.before(rows.withColumn("order_", F.struct("height", "input_id", "seq")), {"head": ("last", head)}, order="order_")
    above = F.col("height") - F.col("head.h")
    low = F.coalesce(above <= 0, F.lit(False)) | (F.col("head").isNull() & (F.col("height") < start_height))
    high = (F.col("head").isNull() & (F.col("height") > start_height) & F.lit(bool(start_height))) | (F.coalesce(above > 1, F.lit(False)) & F.lit(contiguous))
    kind = F.when(F.col("bad_"), "corrupted").when(F.col("taken_"), "written").when(low, "low").when(high, "high").when(F.col("head").isNotNull() & (folded("prev_hash") != F.col("head.x")), "mismatch")
    return rows.select("input_id", kind.alias("kind"))
