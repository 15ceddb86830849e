"""Alarms for subjects that a reader no longer hears, though the log is known to go on."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .state import stored

_KEYS = ("stream_id", "subject")
RESULT = "stream_id string, subject string, read_seq long, known_seq long, silent_ms long"


class _Silence(StatefulProcessor):
    """One subject: the last seq that was read and when, and the last that the log is known to have."""

    def __init__(self, most_ms: int):
        self.most_ms = most_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.place = handle.getValueState("place", "read_seq long, known_seq long, at long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        read, known, at = self.place.get() if self.place.exists() else (0, 0, now)
        heard = read
        for row in rows:
            if row["read"]:
                heard = max(heard, row["seq"])
            known = max(known, row["seq"])
        self._wait(heard, known, now if heard > read or known == read else at, now)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        read, known, at = self.place.get()
        silent = known > read and now - at >= self.most_ms
        if silent:
            yield Row(stream_id=key[0], subject=key[1], read_seq=read, known_seq=known, silent_ms=now - at)
        self._wait(read, known, at, now, again=silent)

    def _wait(self, read: int, known: int, at: int, now: int, again: bool = False) -> None:
        self.place.update((read, known, at))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if known > read:
            self.handle.registerTimer(max(now + 1, (now if again else at) + self.most_ms))


def silences(log: DataFrame, known: DataFrame, most_seconds: float) -> DataFrame:
    """stream_id, subject, read_seq, known_seq and silent_ms of subjects (stream_id, subject, seq) of which a live log has brought nothing for so long, though ``known`` (rows of the same form: the last seqs that the log is known to have) tells of newer rows.

    Nothing to read is no silence: only a subject with newer rows is watched, by a timer of its
    own, however busy the others are; it is told again each time as long passes. Null subjects
    and streams are watched as one each. Rows without seq don't count.
    """
    stored(log.sparkSession)
    shaped = lambda t, read: t.select(*[F.col(c).cast("string").alias(c) for c in _KEYS], F.col("seq").cast("long").alias("seq"), F.lit(read).alias("read"))
    rows = shaped(log, True).unionByName(shaped(known, False)).filter("seq is not null")
    return rows.groupBy(*_KEYS).transformWithState(_Silence(round(most_seconds * 1000)), RESULT, "Append", "ProcessingTime")
