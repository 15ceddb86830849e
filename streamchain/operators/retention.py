"""Tail retention by messages and bytes, and the stepwise lowering of a limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import prefix

#: Bytes of a unit. Fixed values.
UNITS = {"kb": 1024, "mb": 1024**2, "gb": 1024**3}


def newest_messages(log: DataFrame, most: int, segment: int = prefix.SEGMENT) -> DataFrame:
    """The newest ``most`` rows of each stream."""
    rows = prefix.before(log, {"newer": ("sum", F.lit(1))}, descending=True, segment=segment)
    return rows.filter(F.col("newer") < most).drop("newer")


def newest_bytes(log: DataFrame, most: int, bytes_: Column | None = None, segment: int = prefix.SEGMENT) -> DataFrame:
    """The newest rows of each stream that together hold at most ``most`` bytes."""
    size = F.octet_length("data") if bytes_ is None else bytes_
    rows = prefix.before(log, {"newer": ("sum", size)}, descending=True, segment=segment)
    return rows.filter(F.col("newer") + size <= most).drop("newer")


def size_limit(**units: int) -> int:
    """Bytes of exactly one of kb, mb and gb."""
    given = {k: v for k, v in units.items() if v}
    if len(given) != 1:
        raise ValueError("give exactly one of kb, mb, gb")
    ((unit, value),) = given.items()
    return value * UNITS[unit]


def shrink_steps(spark: SparkSession, size: int, limit: int, target: int, speed: int) -> DataFrame:
    """step, limit_bytes, eta: the limits that lead from ``limit`` (below 1: none) to ``target``, at most ``speed`` bytes lower a step.

    An unlimited log first gets its own size, or the target if that is more.
    """
    first = max(size, target) if limit < 1 else max(target, limit - speed)
    steps = max(0, -(-(first - target) // speed)) + 1 if limit < 1 or limit > target else 0
    at = F.greatest(F.lit(target).cast("long"), F.lit(first).cast("long") - F.col("id") * F.lit(speed).cast("long"))
    return spark.range(steps).select((F.col("id") + 1).alias("step"), at.alias("limit_bytes"), F.ceil((at - target) / speed).cast("long").alias("eta"))
