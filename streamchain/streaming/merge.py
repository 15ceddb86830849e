"""Merging of redundant live inputs: candidates wait, by height, until every input has passed them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .state import arm, stored


class _Merge(StatefulProcessor):
    """One stream's head, what each input has come to, and the candidates above the head, by (height, input_id, seq)."""

    def __init__(self, schema: T.StructType, inputs: int, start_height: int, contiguous: bool, hash_ci: bool, patience_ms: int | None):
        self.names, self.schema, self.inputs = schema.names, schema, inputs
        self.start_height, self.contiguous, self.hash_ci, self.patience_ms = start_height, contiguous, hash_ci, patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kind = lambda c: self.schema[c].dataType
        turn = T.StructType([T.StructField(c, kind(c)) for c in ("height", "input_id", "seq")])
        self.head = handle.getValueState("head", "height long, hash string, written long")
        self.tops = handle.getMapState("tops", T.StructType([T.StructField("input_id", kind("input_id"))]), "height long, at long, since long")
        self.waiting = handle.getMapState("waiting", turn, self.schema)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs() if self.patience_ms is not None else 0
        height = self.head.get()[0] if self.head.exists() else None
        tops: dict = {}
        for row in rows:
            tops[row["input_id"]] = max(row["height"], tops.get(row["input_id"], row["height"]))
            if row["height"] >= self.start_height and (height is None or row["height"] > height):
                self.waiting.updateValue((row["height"], row["input_id"], row["seq"]), tuple(row[c] for c in self.names))
        for name, top in tops.items():
            known, _, since = self.tops.getValue((name,)) if self.tops.containsKey((name,)) else (top, now, now)
            self.tops.updateValue((name,), (max(top, known), now, since))
        yield from self._settled(now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._settled(timerValues.getCurrentProcessingTimeInMs())

    def _barrier(self, now: int) -> float | None:
        """The height below which nothing more is waited for."""
        tops = [tuple(v) for _, v in self.tops.iterator()]
        if self.patience_ms is None:
            return min(t[0] for t in tops) if len(tops) >= self.inputs else None
        if len(tops) < self.inputs and now - min(t[2] for t in tops) < self.patience_ms:
            return None
        return min((t[0] for t in tops if now - t[1] < self.patience_ms), default=float("inf"))

    def _settled(self, now: int) -> Iterator[Row]:
        """The rows below the barrier that the chain takes; those that it doesn't take go."""
        barrier = self._barrier(now)
        waiting = [(tuple(k), tuple(v)) for k, v in self.waiting.iterator()]
        left = waiting if barrier is None else [w for w in waiting if w[0][0] >= barrier]
        height, link, n = self.head.get() if self.head.exists() else (None, None, 0)
        out = []
        for turn, row in sorted((w for w in waiting if barrier is not None and w[0][0] < barrier), key=lambda w: [(x is not None, x) for x in w[0]]):
            own = dict(zip(self.names, row, strict=True))
            if self._follows(height, link, own):
                height, link, n = own["height"], self._folded(own["hash"]), n + 1
                out.append(Row(**own, out_seq=n))
            self.waiting.removeKey(turn)
        if out:
            self.head.update((height, link, n))
        if self.patience_ms is not None and left:
            arm(self.handle, now + self.patience_ms)
        yield from out

    def _folded(self, text: str | None) -> str:
        return (text or "").lower() if self.hash_ci else text or ""

    def _follows(self, height: int | None, link: str | None, row: dict) -> bool:
        if height is None:
            return not self.start_height or row["height"] == self.start_height
        return (row["height"] == height + 1 if self.contiguous else row["height"] > height) and self._folded(row["prev_hash"]) == link


def merged(inputs: list[DataFrame], start_height: int = 0, contiguous: bool = False, hash_ci: bool = False, patience_seconds: float | None = None) -> DataFrame:
    """The chain that ``operators.merge.merged`` takes from tables, of streaming inputs: their rows with input_id (an input's place in the list, unless it has its own) and out_seq.

    A candidate is settled once all inputs have shown a greater height: only then is it known
    to be the first that may follow the head. So the output doesn't depend on how the inputs
    are cut into batches, as long as no input falls back below a height that all have passed;
    rows that do come too late. State holds the candidates between the head and the slowest
    input. With a patience, an input that has been silent for so long is waited for no more,
    and candidates are let out by a timer, with no further row of any input. Rows without
    height don't count, and a missing hash is an empty one.
    """
    stored(inputs[0].sparkSession)
    named = [t if "input_id" in t.columns else t.withColumn("input_id", F.lit(k)) for k, t in enumerate(inputs)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named).filter("height is not null")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    patience_ms = None if patience_seconds is None else round(patience_seconds * 1000)
    worker = _Merge(schema, len(inputs), start_height, contiguous, hash_ci, patience_ms)
    result = T.StructType([*schema, T.StructField("out_seq", T.LongType())])
    return rows.groupBy("stream_id").transformWithState(worker, result, "Append", "None" if patience_ms is None else "ProcessingTime")
