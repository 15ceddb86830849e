"""Operational figures of logs: sizes, rates, gaps, write counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import prefix

#: Buckets of message sizes. Fixed values.
SIZE_BUCKETS = (10, 128 * 1024 * 1024, 20)


def exponential(low: float, high: float, n: int) -> list[float]:
    return [low * (high / low) ** (i / (n - 1)) for i in range(n)]


def linear(start: float, width: float, n: int) -> list[float]:
    return [start + width * i for i in range(n)]


def histogram(rows: DataFrame, value: Column, by: list[str], edges: list[float]) -> DataFrame:
    """by, le (index of the upper edge; as many as edges for no edge) and the count of values at or below it.

    Counts by bucket first; the cumulative step only sees a row a bucket and group.
    """
    index = F.lit(len(edges))
    for i in reversed(range(len(edges))):
        index = F.when(value <= edges[i], i).otherwise(index)
    counts = rows.groupBy(*by).agg(*[F.count_if(index <= i).alias(f"b{i}") for i in range(len(edges) + 1)])
    pairs = F.array(*[F.struct(F.lit(i).alias("le"), F.col(f"b{i}").alias("n")) for i in range(len(edges) + 1)])
    return counts.select(*by, F.explode(pairs).alias("p")).select(*by, "p.le", "p.n")


def throughput(log: DataFrame, seconds: int = 3) -> DataFrame:
    """Messages by stream and stretch of so many seconds."""
    at = (F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / seconds) * seconds).cast("long")
    return log.groupBy("stream_id", at.alias("from_second")).agg(F.count("*").alias("msgs"))


def silences(log: DataFrame, most_seconds: int, by: tuple[str, ...] = ("stream_id",), segment: int = prefix.SEGMENT) -> DataFrame:
    """by, seq, gap: rows that came more than so many seconds after the one before in their stream (or of the other keys, such as its subject)."""
    rows = prefix.previous(log.select(*by, "seq", "ts"), {"prev_ts": "ts"}, by=by, segment=segment)
    at = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    return rows.withColumn("gap", at("ts") - at("prev_ts")).filter(F.col("gap") > most_seconds).select(*by, "seq", "gap")


def write_figures(writes: DataFrame) -> DataFrame:
    """By block type and write status: count, and seq and height of the last write; all types together under a null one."""
    return writes.rollup("status", "block_type").agg(F.count("*").alias("writes"), F.max("seq").alias("last_seq"), F.max_by("height", "seq").alias("last_height")).filter("status is not null")


def observed(value: Column, edges: list[float], among: dict[str, Column] | None = None) -> list[Column]:
    """Figures of rows (seq, height) for ``DataFrame.observe``, which takes them in the pass that writes: writes, bytes, last_seq, last_height and, for each upper edge of a size and none (see ``histogram``), le_0, le_1, ...

    ``among`` names kinds of rows, by their conditions: each figure is given for each kind, as
    kind.figure, since observations have no groups. Without rows, sums and last ones are null.
    """
    out = []
    for name, holds in (among or {"": F.lit(True)}).items():
        prefix_ = f"{name}." if name else ""
        own = lambda c, holds=holds: F.when(holds, c)
        out += [F.count_if(holds).alias(f"{prefix_}writes"), F.sum(own(value)).alias(f"{prefix_}bytes"), F.max(own(F.col("seq"))).alias(f"{prefix_}last_seq"), F.max_by("height", own(F.col("seq"))).alias(f"{prefix_}last_height")]
        out += [F.count_if(holds & (value <= edge)).alias(f"{prefix_}le_{i}") for i, edge in enumerate(edges)] + [F.count_if(holds).alias(f"{prefix_}le_{len(edges)}")]
    return out


def input_gauges(log: DataFrame) -> DataFrame:
    """By stream: bytes read, what the log has deleted and knows, and the seq and height that a reader of all of it has come to."""
    return log.groupBy("stream_id").agg(
        F.sum("bytes").alias("in_bytes"), (F.min("seq") - 1).alias("deleted_seq"), F.max("seq").alias("known_seq"), F.max("height").alias("known_height"),
        F.max_by("seq", F.when(F.col("height").isNotNull(), F.col("seq"))).alias("reader_seq"), F.max_by("height", "seq").alias("reader_height"),
    )


def output_gauges(writes: DataFrame) -> DataFrame:
    """By block type and write status: writes, bytes, and the source seq of the last write."""
    return writes.groupBy("block_type", "status").agg(F.count("*").alias("writes"), F.sum("bytes").alias("out_bytes"), F.max_by("source_seq", "seq").alias("last_source_seq"))


def running_tip(log: DataFrame, segment: int = prefix.SEGMENT) -> DataFrame:
    """The rows with the largest height up to and with each."""
    rows = prefix.before(log, {"tip": ("max", F.col("height"))}, segment=segment)
    return rows.withColumn("tip", F.greatest("tip", "height"))
