"""Tolerance counters: how long a log may go on without an acceptable row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import prefix

#: Counter -> (classes that raise it, classes that set it back to zero). Fixed values.
COUNTERS = {
    "corrupted": (("corrupted",), ("low", "high", "ok")),
    "low": (("low",), ("high", "ok")),
    "high": (("high",), ("low", "ok")),
    "wrong": (("corrupted", "high"), ("low", "ok")),
    "no_write": (("corrupted", "low", "high"), ("ok",)),
}
#: In which order a row's counters are checked. Fixed values.
CHECKED = {"corrupted": ("corrupted", "wrong", "no_write"), "low": ("low", "no_write"), "high": ("high", "wrong", "no_write"), "ok": ()}


@dataclass(frozen=True)
class Tolerances:
    """Largest allowed counts; negative is no limit."""

    corrupted: int = -1
    low: int = -1
    high: int = -1
    wrong: int = -1
    no_write: int = -1

    def limits(self) -> dict[str, int]:
        return {k: getattr(self, k) for k in COUNTERS}


class Counts:
    """The counters in a fold. ``take`` returns the one that would exceed its limit, which then stays as it was."""

    def __init__(self, limits: Tolerances):
        self.limits, self.now = limits.limits(), dict.fromkeys(COUNTERS, 0)

    def take(self, kind: str) -> str | None:
        for name, (_, back) in COUNTERS.items():
            if kind in back:
                self.now[name] = 0
        for name in CHECKED.get(kind, ()):
            if 0 <= self.limits[name] <= self.now[name]:
                return name
            self.now[name] += 1
        return None


def counters(log: DataFrame, class_column: str = "class", segment: int = prefix.SEGMENT) -> DataFrame:
    """The rows (stream_id, seq, class) with the five counters after each, as running sums within islands that end at a reset.

    Two prefix passes: a counter is the count of its rows so far less that count at its last reset.
    """
    kind = F.col(class_column)
    raised = {f"up_{c}": ("sum", F.when(kind.isin(*up), 1).otherwise(0)) for c, (up, _) in COUNTERS.items()}
    log = prefix.before(prefix.segmented(log, segment=segment), raised)
    for c, (up, _) in COUNTERS.items():
        log = log.withColumn(f"up_{c}", F.col(f"up_{c}") + F.when(kind.isin(*up), 1).otherwise(0))
    resets = {f"at_{c}": ("last", F.when(kind.isin(*back), F.col(f"up_{c}"))) for c, (_, back) in COUNTERS.items()}
    log = prefix.before(log, resets)
    for c, (_, back) in COUNTERS.items():
        since = F.col(f"up_{c}") - F.coalesce(F.col(f"at_{c}"), F.lit(0))
        log = log.withColumn(f"n_{c}", F.when(kind.isin(*back), 0).otherwise(since).cast("long"))
    return log.drop("__segment", *[f"{p}_{c}" for p in ("up", "at") for c in COUNTERS])


def first_desync(log: DataFrame, limits: Tolerances, class_column: str = "class", segment: int = prefix.SEGMENT) -> DataFrame:
    """stream_id, seq and counter of the first row that exceeds a limit."""
    fired = F.lit(None).cast("string")
    kind = F.col(class_column)
    for c in reversed(("corrupted", "low", "high", "wrong", "no_write")):
        if limits.limits()[c] >= 0:
            fired = F.when(kind.isin(*COUNTERS[c][0]) & (F.col(f"n_{c}") > limits.limits()[c]), c).otherwise(fired)
    rows = counters(log, class_column, segment).withColumn("counter", fired).filter("counter is not null")
    return rows.groupBy("stream_id").agg(F.min("seq").alias("seq"), F.min_by("counter", "seq").alias("counter"))
