"""Exactly-once appends from streaming queries, and what watches them."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def append(rows: DataFrame, path: str, checkpoint: str, once: bool = True, figures: list[Column] | None = None, told: Callable[[int, dict], None] | None = None) -> StreamingQuery:
    """Start writing to ``path``. A batch owns a folder named for it, which a repeated batch overwrites with the same rows.

    ``figures`` (see ``operators.metrics.observed``) are taken of each batch in the pass that
    writes it, and handed to ``told`` with the batch's number once it is written; a repeated
    batch is told again, so figures are kept by number.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation() if figures else None
        (batch.observe(seen, *figures) if figures else batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if figures and told:
            told(batch_id, seen.get)

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 second")).start()


def stop_between(query: StreamingQuery, seconds: float = 60.0) -> bool:
    """Stop a query while no batch runs, so that no task is killed with its state store open; False if a batch ran all that time and was broken off."""
    until = time.monotonic() + seconds
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
        time.sleep(0.02)
    idle = not (query.isActive and query.status["isTriggerActive"])
    query.stop()
    return idle


class Silence(StreamingQueryListener):
    """Calls back when a query has gone so many triggers without a row."""

    def __init__(self, most: int, alarm):
        self.most, self.alarm, self.quiet = most, alarm, 0

    def onQueryStarted(self, event) -> None:
        self.quiet = 0

    def onQueryProgress(self, event) -> None:
        self.quiet = 0 if event.progress.numInputRows else self.quiet + 1
        if self.quiet == self.most:
            self.alarm(event.progress)

    def onQueryIdle(self, event) -> None:
        self.quiet += 1
        if self.quiet == self.most:
            self.alarm(event)

    def onQueryTerminated(self, event) -> None:
        pass
