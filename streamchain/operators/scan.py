"""Scans and point lookups of sequence-addressed logs, and checks on what they deliver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.headers import first_value, matches_subject
from ..functions.msgid import parse
from ..sources.decode import decode
from ..sources.checkpoint import cut
from . import prefix
from .sink import by_stream


def between(log: DataFrame, start: int | None = None, end: int | None = None, subjects: list[str] | None = None) -> DataFrame:
    """Rows with start <= seq < end and a matching subject; plain comparisons, which Parquet scans take over."""
    if start is not None:
        log = log.filter(F.col("seq") >= start)
    if end is not None:
        log = log.filter(F.col("seq") < end)
    return log.filter(matches_subject(F.col("subject"), subjects)) if subjects else log


def until_time(log: DataFrame, end) -> DataFrame:
    """Rows of each stream before its first row at or after ``end``, whatever the later ones' times are; rows don't move."""
    over = F.coalesce(F.col("ts") >= F.lit(end), F.lit(False))
    rows = by_stream(log, log.filter(over).groupBy("stream_id").agg(F.min(prefix.place("seq")).alias("over")))
    return rows.filter(F.col("over").isNull() | (prefix.place("seq") < F.col("over"))).drop("over")


def get(log: DataFrame, seq: int) -> DataFrame:
    return log.filter(F.col("seq") == seq)


def last_per_subject(log: DataFrame) -> DataFrame:
    """The row with the largest seq of each stream and subject; partly aggregated before the shuffle."""
    rest = [c for c in log.columns if c not in ("stream_id", "subject")]
    best = log.groupBy("stream_id", "subject").agg(F.max_by(F.struct(*rest), "seq").alias("row"))
    return best.select("stream_id", "subject", "row.*")


def state(log: DataFrame, bytes_: Column | None = None) -> DataFrame:
    """First and last seq, deleted seq, messages, bytes and last time of each stream."""
    return log.groupBy("stream_id").agg(
        F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), (F.min("seq") - 1).alias("deleted_seq"), F.count("*").alias("msgs"),
        F.sum(bytes_ if bytes_ is not None else F.octet_length("data")).alias("bytes"), F.max("ts").alias("last_ts"),
    )


def resolve_mirrors(streams: DataFrame) -> DataFrame:
    """(stream, mirror_of, subjects) -> each stream's subjects at the end of its mirrors, and how many steps that takes.

    Follows doubled steps, so the rounds grow with the logarithm of the longest path. A stream
    whose path has no end (a cycle, or a missing stream) is left out: more steps than there are
    streams can only go round.
    """
    ends = streams.filter("mirror_of is null").select(F.col("stream").alias("to"), "subjects")
    at = cut(streams.select("stream", F.coalesce("mirror_of", "stream").alias("to"), F.when(F.col("mirror_of").isNull(), 0).otherwise(1).alias("steps")))
    most, reach = at.count(), 1
    while reach < most:
        following = at.select(F.col("stream").alias("to"), F.col("to").alias("next"), F.col("steps").alias("more"))
        at = cut(at.join(following, "to").select("stream", F.col("next").alias("to"), (F.col("steps") + F.col("more")).alias("steps")))
        reach *= 2
        if at.join(ends, "to", "left_anti").isEmpty():
            break
    return at.join(ends, "to").select("stream", F.col("to").alias("origin"), "subjects", "steps")


def contiguity(log: DataFrame, filtered: bool = False, strict_start: int | None = None, segment: int = prefix.SEGMENT) -> DataFrame:
    """Rows whose seq doesn't follow the one before: by exactly one, or (filtered scans) by more than zero.

    With ``strict_start`` a stream's first row must have just that seq, or (filtered) no smaller one.
    """
    rows = prefix.previous(log.select("stream_id", "seq"), {"prev_seq": "seq"}, segment=segment)
    broken = (F.col("seq") <= F.col("prev_seq")) if filtered else (F.col("seq") != F.col("prev_seq") + 1)
    if strict_start:
        first = (F.col("seq") < strict_start) if filtered else (F.col("seq") != strict_start)
        broken = F.when(F.col("prev_seq").isNull(), first).otherwise(broken)
    return rows.filter(broken)


def skip_by_header(log: DataFrame, target: Column, msg_id: Column | None = None) -> DataFrame:
    """Rows whose message id tells a height below the target go before their payload is decoded; a missing or bad id stays."""
    height = parse(first_value(F.col("headers"), "Nats-Msg-Id") if msg_id is None else msg_id)["height"]
    return log.filter(F.coalesce(height >= target, F.lit(True)))


def resume_point(log: DataFrame, state_header: str) -> DataFrame:
    """The largest source seq that a copy's headers tell, by stream; 0 without any."""
    value = first_value(F.col("headers"), state_header)
    number = F.when(value.rlike("^[0-9]+$"), value.try_cast("decimal(20,0)"))
    return log.groupBy("stream_id").agg(F.coalesce(F.max(number), F.lit(0).cast("decimal(20,0)")).cast("long").alias("resume_seq"))


def blocks(log: DataFrame, kind: str, start: int | None = None, end: int | None = None, subjects: list[str] | None = None, target: Column | None = None) -> DataFrame:
    """A stored log as decoded blocks: ranges and subjects first, then rows whose message id is below the target go, and only what is left is decoded.

    Rows that can't be decoded stay, with their decode_error. Bounds reach the Parquet scan.
    """
    rows = between(log, start, end, subjects)
    return decode(rows if target is None else skip_by_header(rows, target), kind)
