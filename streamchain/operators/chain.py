"""Extraction of the valid chain of a log: closed forms where the rules allow them, a streaming fold where they don't."""

from __future__ import annotations

import base64
import json
from bisect import insort
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.msgid import order_key
from ..schema import REASON_CLASS, SHARD
from ..sources.checkpoint import cut
from . import prefix
from .sink import FEW_STREAMS, by_stream, on_keys
from .tolerance import Counts, Tolerances
from .verify import FIELDS, Verifier


def sound(log: DataFrame) -> DataFrame:
    """The rows that hold a block: neither marked as corrupted nor without height, type or shard."""
    held = F.col("height").isNotNull() & F.col("block_type").isNotNull() & F.col("shard_id").isNotNull()
    return log.filter(held & ~F.coalesce("corrupted", F.lit(False)) if "corrupted" in log.columns else held)


def records(log: DataFrame, segment: int = prefix.SEGMENT, order: str = "seq") -> DataFrame:
    """The chain where heights may have gaps and neither hashes nor completeness count, without a buffer.

    Corrupted rows and rows without a block don't count. A stream's first row is accepted as it
    is. An announcement is accepted if it is higher than all before; a shard if its height is
    the highest announced so far and its id greater than those accepted there. Two prefix
    passes; the second only sees shards of the block that was open when they came, so its
    windows are as small as a block.
    """
    log = sound(log)
    specs = {"announced": ("max", F.when(F.col("block_type") == 0, F.col("height"))), "opened": ("first", F.col("height"))}
    log = prefix.before(log, specs, order=order, segment=segment).withColumn("top", F.greatest("announced", "opened"))
    higher = F.col("top").isNull() | ((F.col("block_type") == 0) & (F.col("height") > F.col("top")))
    inside = (F.col("block_type") == SHARD) & (F.col("height") == F.col("top"))
    kept = log.filter(higher | inside)
    earlier = Window.partitionBy("stream_id", "height").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    kept = kept.withColumn("before", F.max(F.when(F.col("block_type") == SHARD, F.col("shard_id"))).over(earlier))
    accepted = F.col("top").isNull() | (F.col("height") > F.col("top")) | F.col("before").isNull() | (F.col("shard_id") > F.col("before"))
    return kept.filter(accepted).drop("announced", "opened", "top", "before")


def island(log: DataFrame, segment: int = prefix.SEGMENT) -> DataFrame:
    """The chain where heights have no gaps and the buffer is unbounded: the first run of successive heights from the first row's, each by its first row."""
    rest = [c for c in log.columns if c not in ("stream_id", "height")]
    log = prefix.before(log, {"start": ("first", F.col("height"))}, segment=segment).withColumn("start", F.coalesce("start", "height"))
    by_height = log.filter("height >= start").groupBy("stream_id", "height", "start").agg(F.min_by(F.struct(*rest), "seq").alias("row"))
    numbered = prefix.before(by_height, {"n": ("sum", F.lit(1))}, order="height", segment=segment)
    return numbered.filter(F.col("height") - F.col("start") == F.col("n")).select("stream_id", "height", "row.*").select("stream_id", "height", *rest)


@dataclass(frozen=True)
class Anchor:
    """Where an empty output begins: a block (height, type, shard) to meet, a block to follow, or a seq to start at. None: the first row."""

    block: tuple[int, int, int] | None = None
    after: tuple[int, int, int] | None = None
    seq: int | None = None


@dataclass(frozen=True)
class Bridge:
    """What a chain extraction may do: the verifier, the reorder buffer, tolerances, where it starts and where it ends."""

    verifier: Verifier = Verifier()
    buffer: int = 0
    tolerances: Tolerances = Tolerances()
    anchor: Anchor = Anchor()
    last_block: tuple[int, int, int] | None = None
    end_block: tuple[int, int, int] | None = None
    #: Count shards that the filter rejects as corrupted, rather than by their class without the filter.
    strict_filter: bool = False


def block_key(row: dict) -> tuple[int, int, int]:
    return row["height"], row["block_type"], row["shard_id"] if row["block_type"] == SHARD else 0


def _turn(row: dict) -> tuple[tuple[int, int, int], int]:
    return block_key(row), row["seq"]


class Fold:
    """State of one stream: the tip, the buffer and the counters. ``take`` gives the rows that a row lets out."""

    def __init__(self, bridge: Bridge, tip: dict | None = None):
        self.bridge, self.tip = bridge, tip
        self.held: list[dict] = []  # in the order of blocks, once a row is taken
        self._settled: dict | None = None  # the tip that all of them are too high for
        self.counts = Counts(bridge.tolerances)
        self.ended: str | None = None
        self._check_tip()

    def take(self, row: dict) -> Iterator[dict]:
        if not self.ended:
            yield from self._unload()
        if not self.ended:
            yield from self._handle(row)
        if not self.ended:
            yield from self._unload()

    def unload(self) -> Iterator[dict]:
        """The rows of the buffer that fit by now, without a row of the log."""
        if not self.ended:
            yield from self._unload()

    def move(self, tip: dict) -> None:
        """The output's tip is this row, unless it is no higher: someone else has written it."""
        if self.tip is None or block_key(tip) > block_key(self.tip):
            self.tip = {**dict.fromkeys(("seq", *FIELDS)), **tip}
            self._check_tip()

    def _check_tip(self) -> None:
        b = self.bridge
        if self.tip is not None and any(k is not None and block_key(self.tip) >= k for k in (b.last_block, b.end_block)):
            self.ended = "terminal"

    def _unload(self) -> Iterator[dict]:
        """One pass over the lowest rows of the buffer: those that fit are written, those too high stay, others go.

        Rows that come in are too high for the tip, so a pass is due where it has moved alone; and
        where heights have no gaps, it ends at the first row that is further off than the next.
        """
        if self.tip is None:
            self.held = []
            return
        if self._settled is None:
            self.held.sort(key=_turn)
        del self.held[self.bridge.buffer :]
        if self._settled is self.tip:
            return
        held, kept, k = self.held, [], 0
        while k < len(held) and not self.bridge.verifier.beyond(self.tip, held[k]):
            row, k = held[k], k + 1
            reason = self._reason(self.tip, row)
            if reason == "OK":
                yield from self._write(row)
                if self.ended:
                    held[:k] = kept
                    return
            elif REASON_CLASS[reason] == "high":
                kept.append(row)
        held[:k] = kept
        self._settled = self.tip

    def _reason(self, last: dict | None, row: dict) -> str:
        return self.bridge.verifier.reason(last, row)

    def _handle(self, row: dict) -> Iterator[dict]:
        if row.get("corrupted") or any(row[f] is None for f in ("height", "block_type", "shard_id")):
            return self._count("corrupted")
        verdict = self._first(row) if self.tip is None else REASON_CLASS[self._reason(self.tip, row)]
        if verdict == "irrelevant":
            plain = REASON_CLASS[self.bridge.verifier.without_filter().headers_only().reason(self.tip, row)]
            verdict = "corrupted" if self.bridge.strict_filter or plain == "irrelevant" else plain
            if verdict == "ok":  # a filtered shard in its place: neither written nor held against the input
                self.counts.take("ok")
                return iter(())
            return self._count(verdict)
        if verdict == "desync":
            self.ended = "desync"
            return iter(())
        if verdict == "ok":
            self.counts.take("ok")
            return self._write(row)
        if verdict == "high" and self.bridge.buffer:
            insort(self.held, row, key=_turn)
        return self._count(verdict)

    def _first(self, row: dict) -> str:
        """The verdict while nothing is written yet."""
        a, key = self.bridge.anchor, block_key(row)
        if a.block is not None:
            return "ok" if key == a.block else "low" if key < a.block else "high"
        if a.after is not None:
            height, kind, shard = a.after
            pre = {"height": height, "block_type": kind, "shard_id": shard, "hash": None, "prev_hash": None, "shard_mask": None}
            return REASON_CLASS[self._reason(pre, row)]
        if a.seq is not None:
            return "ok" if row["seq"] == a.seq else "low" if row["seq"] < a.seq else "desync"
        return "ok"

    def _count(self, kind: str) -> Iterator[dict]:
        if self.counts.take(kind):
            self.ended = "desync"
        return iter(())

    def _write(self, row: dict) -> Iterator[dict]:
        b = self.bridge
        if b.end_block is not None and block_key(row) >= b.end_block:
            self.ended = "terminal"
            return
        self.tip = row
        yield row
        if b.last_block is not None and block_key(row) >= b.last_block:
            self.ended = "terminal"


#: What the rules look at.
NEEDED = ("stream_id", "seq", *FIELDS, "corrupted")
#: Marks rows of a table of tips among those of a log.
TIP = "__tip"


def with_tips(log: DataFrame, tips: DataFrame) -> DataFrame:
    """The log and, marked, the last row that each stream's output has taken (a row a stream), which comes before all rows of the log."""
    own = tips.select(*[c for c in log.columns if c in tips.columns]).withColumn(TIP, F.lit(True))
    return log.withColumn(TIP, F.lit(False)).unionByName(own, allowMissingColumns=True)


#: Rows of a stretch of a stream, which a task folds at a time.
FOLDED = 1 << 17
#: A larger buffer isn't passed on between stretches: its streams are folded as wholes.
PASSED_ON = 1 << 10
_STATE = "__state"


def _frozen(fold: Fold) -> tuple[str, str]:
    """A fold's state as text: what decides about later rows, and the same with the whole rows of its buffer."""
    plain = [{f: row[f] for f in ("seq", *FIELDS)} for row in ([fold.tip] if fold.tip else []) + fold.held]
    core = {"tip": plain.pop(0) if fold.tip else None, "held": plain, "counts": fold.counts.now, "ended": fold.ended}
    whole = []
    for row in fold.held:
        batch, k = row["at"]  # a row of it
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(_some(batch, [k]))
        whole.append(base64.b64encode(sink.getvalue()).decode())
    return json.dumps(core), json.dumps({**core, "whole": whole})


def _thawed(bridge: Bridge, text: str | None) -> Fold:
    """A fold that goes on from such a text; from an output's tip alone, if the text is no more than that; or from nothing."""
    known = json.loads(text) if text else None
    if known is None or "counts" not in known:
        return Fold(bridge, known and {**dict.fromkeys(("seq", *FIELDS)), **known})
    fold = Fold(bridge)
    fold.tip, fold.counts.now, fold.ended = known["tip"], known["counts"], known["ended"]
    for row, data in zip(known["held"], known["whole"], strict=True):
        batch = next(iter(pa.ipc.open_stream(base64.b64decode(data))))
        fold.held.append({**row, "at": (batch, 0)})
    return fold


def _some(batch: pa.RecordBatch, places: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c.take(pa.array(places, pa.int64())) for c in batch.columns], schema=batch.schema)


def _detach(held: list[dict], batch: pa.RecordBatch) -> None:
    """What waits keeps its own rows, not the batch; nor others' rows, once most of those that it was kept with have gone."""
    kept: dict[int, list[dict]] = {}
    for row in held:
        kept.setdefault(id(row["at"][0]), []).append(row)
    for rows in kept.values():
        of = rows[0]["at"][0]
        if of is batch or of.num_rows > 2 * len(rows):
            own = _some(of, [row["at"][1] for row in rows])
            for k, row in enumerate(rows):
                row["at"] = (own, k)


def _stretched(rows: DataFrame, states: DataFrame) -> DataFrame:
    """Rows of stretches, each behind a marked row that tells the state that it is entered with and how many rows are written before it."""
    marked = rows.withColumn(TIP, F.lit(False)).withColumns({_STATE: F.lit(None).cast("string"), "__base": F.lit(None).cast("long")})
    marks = states.select("stream_id", "__n", F.lit(True).alias(TIP), F.col("state").alias(_STATE), F.col("base").alias("__base"))
    both = marked.unionByName(marks, allowMissingColumns=True)
    return both.repartition("stream_id", "__n").sortWithinPartitions("stream_id", "__n", F.col(TIP).desc(), "seq")


def _left(rows: DataFrame, states: DataFrame, bridge: Bridge) -> DataFrame:
    """What each stretch was entered with and is left with, and how many rows it lets out."""
    kind = rows.schema["stream_id"].dataType
    names = [c for c in rows.columns if c != "__n"]
    fields = [f for f in ("stream_id", "seq", "__n", TIP, _STATE, *FIELDS, "corrupted") if f in (*names, "__n", TIP, _STATE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, fold, entered, many = None, None, None, 0

        def leave(schema):
            core, whole = _frozen(fold)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*place, entered, core, whole, many), (schema.field("stream_id").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()), strict=True)], ["stream_id", "__n", "entered", "core", "whole", "many"])

        schema = None
        for batch in batches:
            schema = batch.schema
            whole = batch.select(names)
            for k, own in enumerate(batch.select(fields).to_pylist()):
                if own[TIP]:
                    if fold is not None:
                        yield leave(schema)
                    place, fold, many = (own["stream_id"], own["__n"]), _thawed(bridge, own[_STATE]), 0
                    entered = _frozen(fold)[0]
                else:
                    many += sum(1 for _ in fold.take({**dict.fromkeys(FIELDS), **own, "at": (whole, k)}))
            _detach(fold.held if fold else [], whole)
        if fold is not None:
            yield leave(schema)

    result = T.StructType([T.StructField("stream_id", kind), T.StructField("__n", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("entered", "core", "whole")], T.StructField("many", T.LongType())])
    return _stretched(rows, states).mapInArrow(run, result)


def written(log: DataFrame, bridge: Bridge, stretch: int = FOLDED) -> DataFrame:
    """The rows of the log that ``bridge`` lets out, with all their columns, out_seq (the place in the output) and event ("written"); and a row for the end of a stream's output (event "desync" or "terminal").

    Each decision needs the state that the rows before have left: tip, buffer and counters. A
    stream of more than so many rows is cut into stretches of as many (up to twice that), which
    tasks fold side by side, each entered with a guess: the highest block before it as the tip.
    What a stretch is left with must be what the next one was entered with; those where it differs
    are folded again with it, as long as that at least halves their number. Then rows are given
    out: where stretches still disagree, a stream's rows from the first of these on in one task.
    So a log that is nearly a chain is folded about once on all cores, and one that never falls in
    step with a guess twice, stream by stream. A task keeps a state, never a stretch. Streams are
    not cut where the buffer is larger than ``PASSED_ON``.

    Rows without a block count as corrupted. A row marked as a tip (see ``with_tips``) is where
    its stream's output stands; it isn't given out. The row of an end is the one at which it came.
    """
    tips = log.filter(TIP) if TIP in log.columns else None
    rows = log.filter(~F.col(TIP)).drop(TIP) if tips is not None else log
    names = rows.columns
    fields = [f for f in FIELDS if f in names]
    tip = F.struct("seq", *fields)
    cell = F.expr(f"seq div {stretch}").alias("__cell") if bridge.buffer <= PASSED_ON else F.lit(0).cast("long").alias("__cell")
    key = F.when(F.col("height").isNotNull(), order_key(F.col("height"), F.col("block_type"), F.col("shard_id")))
    if "corrupted" in names:
        key = F.when(~F.coalesce("corrupted", F.lit(False)), key)
    parts = rows.groupBy("stream_id", cell).agg(F.max(F.when(key.isNotNull(), F.struct(key.alias("key"), tip.alias("tip")))).alias("top"), F.count("*").alias("many"))
    by_cell = Window.partitionBy("stream_id").orderBy("__cell")
    earlier = by_cell.rowsBetween(Window.unboundedPreceding, -1)
    place = F.floor(F.coalesce(F.sum("many").over(earlier), F.lit(0)) / stretch).cast("long")
    cells = cut(parts.select("stream_id", "__cell", place.alias("__n"), F.to_json(F.max("top").over(earlier)["tip"]).alias("guess")))
    parts = cells.groupBy("stream_id", "__n").agg(F.min_by("guess", "__cell").alias("guess"))
    along = Window.partitionBy("stream_id").orderBy("__n")
    parts = parts.select("stream_id", "__n", (F.row_number().over(along) == 1).alias("first"), "guess")
    begun = F.lit(None).cast("string")
    if tips is not None:
        parts, begun = on_keys(parts, tips.select("stream_id", F.to_json(tip).alias("begun")), ["stream_id"]), F.col("begun")
    states = cut(parts.select("stream_id", "__n", "first", F.when(F.col("first"), begun).otherwise(F.col("guess")).alias("state"), F.lit(0).cast("long").alias("base")))
    many = states.filter("not first").count()
    if not many:
        return _given(rows.withColumn("__n", F.lit(0).cast("long")), states, bridge, names)
    rows = rows.withColumn("__cell", cell)
    rows = on_keys(rows, _few(cells.filter("__n > 0").select("stream_id", "__cell", "__n")), ["stream_id", "__cell"]).drop("__cell").withColumn("__n", F.coalesce("__n", F.lit(0)))
    # with a buffer, states carry rows over that are given out as they are; else the rules' columns are enough
    needed = rows if bridge.buffer else rows.select(*[c for c in ("stream_id", "seq", "__n", *fields, "corrupted") if c in rows.columns])
    left = cut(_left(needed, states, bridge))
    while True:
        after = left.select("*", F.lag("core").over(along).alias("before"), F.lag("whole").over(along).alias("state"), F.row_number().over(along).alias("k"))
        again = cut(after.filter("k > 1 and not (entered <=> before)").select("stream_id", "__n", "state", F.lit(0).cast("long").alias("base")))
        wrong = again.count()
        if 2 * wrong > many or not wrong:
            break
        anew = _left(on_keys(needed, _few(again.select("stream_id", "__n")), ["stream_id", "__n"], "left_semi"), again, bridge)
        left, many = cut(on_keys(left, again, ["stream_id", "__n"], "left_anti").unionByName(anew)), wrong
    states = _entered(left, states, along)
    if wrong:
        since = cut(again.groupBy("stream_id").agg(F.min("__n").alias("since")))
        states = by_stream(states, since).filter("since is null or __n <= since").drop("since")
        rows = by_stream(rows, since).withColumn("__n", F.least("__n", "since")).drop("since")
    return _given(rows, states, bridge, names)


def _few(keys: DataFrame) -> DataFrame:
    """Keys of stretches, broadcast if they are counted to be few."""
    return F.broadcast(keys) if keys.limit(FEW_STREAMS + 1).count() <= FEW_STREAMS else keys


def _entered(left: DataFrame, states: DataFrame, along) -> DataFrame:
    """Each stretch's true entering state, and how many rows are written before it."""
    after = left.select("stream_id", "__n", F.lag("whole").over(along).alias("whole"), F.coalesce(F.sum("many").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    both = on_keys(states.drop("base"), after, ["stream_id", "__n"])
    return both.select("stream_id", "__n", F.when(F.col("first"), F.col("state")).otherwise(F.col("whole")).alias("state"), F.col("base"))


def _given(rows: DataFrame, states: DataFrame, bridge: Bridge, names: list[str]) -> DataFrame:
    fields = [f for f in ("stream_id", "seq", TIP, _STATE, "__base", *FIELDS, "corrupted") if f in (*names, TIP, _STATE, "__base")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, n = None, 0
        for batch in batches:
            whole = batch.select(names)
            out: list[tuple[pa.RecordBatch, int, int | None, str]] = []
            for k, own in enumerate(batch.select(fields).to_pylist()):
                if own[TIP]:
                    state, n = _thawed(bridge, own[_STATE]), own["__base"]
                    continue
                row = {**dict.fromkeys(FIELDS), **own, "at": (whole, k)}
                before = state.ended
                for kept in state.take(row):
                    n += 1
                    out.append((*kept["at"], n, "written"))
                if state.ended and not before:
                    out.append((whole, k, None, state.ended))
            yield from _taken(out, whole.schema)
            _detach(state.held if state else [], whole)

    events = [T.StructField("out_seq", T.LongType()), T.StructField("event", T.StringType())]
    return _stretched(rows, states).mapInArrow(run, T.StructType([rows.schema[c] for c in names] + events))


def _taken(rows: list[tuple[pa.RecordBatch, int, int | None, str]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of the rows, each given as (its batch, its place there, out_seq, event), in this order."""
    begin = 0
    for end in range(1, len(rows) + 1):
        if end == len(rows) or rows[end][0] is not rows[begin][0]:
            some = rows[begin:end]
            own = some[0][0].take(pa.array([r[1] for r in some], pa.int64()))
            more = [pa.array([r[2] for r in some], pa.int64()), pa.array([r[3] for r in some], pa.string())]
            yield pa.RecordBatch.from_arrays([*own.columns, *more], [*schema.names, "out_seq", "event"])
            begin = end


def fold(log: DataFrame, bridge: Bridge) -> DataFrame:
    """What ``written`` gives, without the blocks: stream_id (as a string), seq, out_seq and event."""
    needed = [f for f in (*NEEDED[1:], TIP) if f in log.columns]
    out = written(log.select(F.col("stream_id").cast("string").alias("stream_id"), *needed), bridge)
    return out.select("stream_id", "seq", "out_seq", "event")


def take_while(chain: DataFrame, last_block: tuple[int, int, int] | None = None, end_block: tuple[int, int, int] | None = None, order: str = "seq") -> DataFrame:
    """A valid chain up to and with ``last_block``, and before ``end_block``: its keys rise, so both are plain filters."""
    key = order_key(F.col("height"), F.col("block_type"), F.col("shard_id"))
    literal = lambda b: order_key(F.lit(b[0]).cast("long"), F.lit(b[1]), F.lit(b[2]).cast("long"))
    if end_block is not None:
        chain = chain.filter(key < literal(end_block))
    if last_block is not None:
        before = prefix.previous(chain, {"h": "height", "t": "block_type", "s": "shard_id"}, order=order)
        reached = order_key(F.col("h"), F.col("t"), F.col("s")) >= literal(last_block)
        chain = before.filter(F.col("h").isNull() | ~reached).drop("h", "t", "s")
    return chain


def anchored(log: DataFrame, anchor: Anchor) -> DataFrame:
    """The log from where an empty output may begin: from the anchor block's first row, after the pre-anchor, or from the anchor seq. Rows don't move."""
    if anchor.seq is not None:
        return log.filter(F.col("seq") >= anchor.seq)
    key = order_key(F.col("height"), F.col("block_type"), F.col("shard_id"))
    block = anchor.block or anchor.after
    literal = order_key(F.lit(block[0]).cast("long"), F.lit(block[1]), F.lit(block[2]).cast("long"))
    meets = (key == literal) if anchor.block else ((F.col("block_type") == 0) & (key > literal))
    rows = by_stream(log, log.filter(meets).groupBy("stream_id").agg(F.min(prefix.place("seq")).alias("begun")))
    return rows.filter(prefix.place("seq") >= F.col("begun")).drop("begun")
