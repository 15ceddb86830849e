"""Running aggregates over ordered logs that don't put a whole log into one task.

A log is cut into segments of so many sequence numbers. Each segment is a window partition of
its own; what earlier segments add is one row a segment, aggregated, prefix-summed and joined
back on the same key that the windows are partitioned by, so the log moves once. The key is a
struct, in which nulls are equal: rows without a stream are a stream of their own, and rows
without a place come first in theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sequence numbers of a segment.
SEGMENT = 1 << 20


def _joined(kind: str, carry: Column, local: Column) -> Column:
    if kind == "sum":
        return F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0))
    if kind == "first":
        return F.coalesce(carry, local)
    return {"max": F.greatest, "min": F.least, "last": F.coalesce}[kind](local, carry)


def place(order: str) -> Column:
    """A row's place in its stream as a number: rows without one come first."""
    return F.coalesce(F.col(order), F.lit(-(1 << 63)))


def segmented(log: DataFrame, order: str = "seq", segment: int = SEGMENT, by: tuple[str, ...] = ("stream_id",)) -> DataFrame:
    """The rows with their segment (the keys and its number). ``before`` uses it where it is there, and leaves it: passes over one log then share its partitioning."""
    return log.withColumn("__segment", F.struct(*by, F.expr(f"{order} div {segment}").alias("n")))


def before(log: DataFrame, specs: dict[str, tuple[str, Column]], by: tuple[str, ...] = ("stream_id",), order: str = "seq", segment: int = SEGMENT, descending: bool = False) -> DataFrame:
    """The rows with a column for each spec (kind, expression): its aggregate over the rows of the same log that come strictly before.

    Kinds: max, min, sum (0 before the first row), first and last (of the values that aren't null).
    """
    given = "__segment" in log.columns
    log = log if given else segmented(log, order, segment, by)
    for name, (_, expression) in specs.items():
        log = log.withColumn(f"__{name}", expression)
    turn = (lambda c: F.col(c).desc()) if descending else F.col
    inside = Window.partitionBy("__segment").orderBy(turn(order)).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*[f"__segment.{c}" for c in by]).orderBy(turn("__segment.n")).rowsBetween(Window.unboundedPreceding, -1)

    def over(kind: str, column: Column, window) -> Column:
        if kind in ("first", "last"):
            return {"first": F.first, "last": F.last}[kind](column, ignorenulls=True).over(window)
        return {"max": F.max, "min": F.min, "sum": F.sum}[kind](column).over(window)

    def total(kind: str, name: str) -> Column:
        column = F.col(f"__{name}")
        if kind not in ("first", "last"):
            return {"max": F.max, "min": F.min, "sum": F.sum}[kind](column)
        pick = F.max_by if (kind == "last") != descending else F.min_by
        return pick(column, F.when(column.isNotNull(), F.struct(order)))

    totals = log.groupBy("__segment").agg(*[total(kind, name).alias(f"__total_{name}") for name, (kind, _) in specs.items()])
    carries = totals.select("__segment", *[over(kind, F.col(f"__total_{name}"), earlier).alias(f"__carry_{name}") for name, (kind, _) in specs.items()])
    local = log.select("*", *[over(kind, F.col(f"__{name}"), inside).alias(f"__local_{name}") for name, (kind, _) in specs.items()])
    both = local.join(carries, "__segment")
    for name, (kind, _) in specs.items():
        both = both.withColumn(name, _joined(kind, F.col(f"__carry_{name}"), F.col(f"__local_{name}")))
    return both.drop(*[f"__{part}{name}" for name in specs for part in ("", "carry_", "local_")], *([] if given else ["__segment"]))


def previous(log: DataFrame, columns: dict[str, str], by: tuple[str, ...] = ("stream_id",), order: str = "seq", segment: int = SEGMENT) -> DataFrame:
    """The rows with columns of the row just before, by new name; null before the first."""
    row = F.struct(*[F.col(c).alias(name) for name, c in columns.items()])
    out = before(log, {"previous_row": ("last", row)}, by, order, segment)
    for name in columns:
        out = out.withColumn(name, F.col("previous_row")[name])
    return out.drop("previous_row")
