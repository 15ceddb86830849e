"""Chain extraction on a live log: each stream's tip, buffer and counters are its keyed state."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.chain import TIP, Bridge, Fold
from ..operators.tolerance import COUNTERS
from ..operators.verify import FIELDS
from .state import arm, stored

RESULT = "stream_id string, seq long, out_seq long, event string"
_ROW = "seq long, height long, block_type int, shard_id long, hash string, prev_hash string, shard_mask array<boolean>"
_NAMES = ("seq", *FIELDS)


class _Follow(StatefulProcessor):
    """One stream's fold. Its state has types: ``tip``, ``held`` (the buffer, by seq) and ``counts`` (counters, rows written, how it ended)."""

    def __init__(self, bridge: Bridge, unload_ms: int | None):
        self.bridge, self.unload_ms = bridge, unload_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tip = handle.getValueState("tip", _ROW)
        self.held = handle.getMapState("held", "seq long", _ROW)
        self.counts = handle.getValueState("counts", ", ".join(f"{c} long" for c in COUNTERS) + ", written long, ended string")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.tip.update(tuple(initialState[c] for c in _NAMES))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        fold, n = self._load()
        before = {r["seq"] for r in fold.held}
        out = []
        for row in sorted((r.asDict() for r in rows), key=lambda r: (not r[TIP], r["seq"])):
            ended = fold.ended
            if row.pop(TIP):
                fold.move(row)
            else:
                for kept in fold.take(row):
                    n += 1
                    out.append(Row(stream_id=key[0], seq=kept["seq"], out_seq=n, event="written"))
            if fold.ended and not ended:
                out.append(Row(stream_id=key[0], seq=row["seq"], out_seq=None, event=fold.ended))
        self._store(fold, n, before)
        if self.unload_ms is not None and fold.held and not fold.ended:
            arm(self.handle, timerValues.getCurrentProcessingTimeInMs() + self.unload_ms)
        yield from out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        fold, n = self._load()
        before = {r["seq"] for r in fold.held}
        out = []
        for kept in fold.unload():
            n += 1
            out.append(Row(stream_id=key[0], seq=kept["seq"], out_seq=n, event="written"))
        if fold.ended:
            out.append(Row(stream_id=key[0], seq=fold.tip["seq"], out_seq=None, event=fold.ended))
        self._store(fold, n, before)
        if fold.held and not fold.ended:
            arm(self.handle, timerValues.getCurrentProcessingTimeInMs() + self.unload_ms)
        yield from out

    def _load(self) -> tuple[Fold, int]:
        fold = Fold(self.bridge, dict(zip(_NAMES, self.tip.get(), strict=True)) if self.tip.exists() else None)
        if not self.counts.exists():
            return fold, 0
        *now, n, fold.ended = self.counts.get()
        fold.counts.now = dict(zip(COUNTERS, now, strict=True))
        fold.held = [dict(zip(_NAMES, row, strict=True)) for _, row in self.held.iterator()]
        return fold, n

    def _store(self, fold: Fold, n: int, before: set[int]) -> None:
        if fold.tip is not None:
            self.tip.update(tuple(fold.tip[c] for c in _NAMES))
        held = {r["seq"]: r for r in fold.held}
        for seq in before - held.keys():
            self.held.removeKey((seq,))
        for seq in held.keys() - before:
            self.held.updateValue((seq,), tuple(held[seq][c] for c in _NAMES))
        self.counts.update((*(fold.counts.now[c] for c in COUNTERS), n, fold.ended))


def follow(log: DataFrame, bridge: Bridge, tips: DataFrame | None = None, unload_seconds: float | None = None) -> DataFrame:
    """The rows that a streaming log lets out, as ``operators.chain.fold`` does for a table.

    Rows of a micro-batch are taken in seq order; across batches a log only grows. There is no
    watermark: a row is late when it is below the tip, which the rules count and drop. State
    holds as many rows as the buffer, beside the tip; Spark's state source reads it.

    ``tips`` (stream_id, seq and the block) tells where outputs stand. A table of them, a row a
    stream, is what the chains go on from. A streaming one is the output itself: whoever has
    written its rows, they move the tip on, and rows of the buffer that then fit are let out
    after ``unload_seconds`` at most, with no row of the log to wake them. None unloads with
    rows of the log alone, and suits a trigger that ends.
    """
    stored(log.sparkSession)
    fields = [f for f in (*FIELDS, "corrupted") if f in log.columns]
    types = dict(field.strip().split(" ") for field in _ROW.split(", ")) | {"corrupted": "boolean"}
    shaped = lambda t, tip: t.select(F.col("stream_id").cast("string").alias("stream_id"), *[(F.col(c) if c in t.columns else F.lit(None)).cast(types[c]).alias(c) for c in (*_NAMES, "corrupted")], F.lit(tip).alias(TIP))
    rows, begun = shaped(log.select("stream_id", "seq", *fields), False), None
    if tips is not None and tips.isStreaming:
        rows = rows.unionByName(shaped(tips, True))
    elif tips is not None:
        begun = shaped(tips, True).groupBy("stream_id")
    unload_ms = None if unload_seconds is None else round(unload_seconds * 1000)
    return rows.groupBy("stream_id").transformWithState(_Follow(bridge, unload_ms), RESULT, "Append", "None" if unload_ms is None else "ProcessingTime", begun)


def deduplicated(log: DataFrame, window: str = "2 minutes") -> DataFrame:
    """Of messages with one id that come within the window of each other, the first."""
    return log.withWatermark("ts", window).dropDuplicatesWithinWatermark(["stream_id", "msg_id"])
