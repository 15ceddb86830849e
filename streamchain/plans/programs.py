"""The programs: bridge, merge, validate, copy and shrink logs that are tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.headers import copied
from ..functions.msgid import order_key
from ..operators import merge, retention, scan, verify
from ..operators.chain import Bridge
from ..operators.sink import by_stream
from ..schema import STATE_HEADER
from . import planner


@dataclass(frozen=True)
class Copy:
    start_seq: int = 0
    end_seq: int | None = None
    subject: str | None = None
    state_header: str = STATE_HEADER
    drop_msg_id: bool = False


def bridge(log: DataFrame, config: Bridge, output: DataFrame | None = None) -> DataFrame:
    """Rows to append to an output: those of the log that make a valid chain, from the output's tip on where it has one.

    output: what has been written so far, as rows of the log (their seqs are the source's). Its
    highest block in each stream is what the next rows are verified against. Rows up to that
    one are not read again; but with a buffer, whose rows a restart has lost, all are from the
    first one that is higher. Streams without output begin as ``config`` says.
    """
    if output is None:
        return planner.rows(log, config)
    key = order_key(F.col("height"), F.col("block_type"), F.col("shard_id"))
    tips = output.groupBy("stream_id").agg(F.max_by(F.struct(*[c for c in output.columns if c != "stream_id"]), key).alias("tip")).select("stream_id", "tip.*")
    if config.buffer:
        higher = by_stream(log, tips.select("stream_id", key.alias("tip"))).filter(F.col("tip").isNotNull() & (key > F.col("tip")))
        start = higher.groupBy("stream_id").agg(F.min("seq").alias("start"))
    else:
        start = tips.select("stream_id", (F.col("seq") + 1).alias("start"))
    return planner.rows(by_stream(log, start).filter("start is null or seq >= start").drop("start"), config, tips)


def copy(log: DataFrame, output: DataFrame | None, config: Copy) -> DataFrame:
    """Rows that a verbatim copy still lacks, with the headers and subject that it gives them; the copy's own headers tell where it stopped."""
    rows = log.filter(F.col("seq") >= config.start_seq) if config.start_seq else log
    if config.end_seq is not None:
        rows = rows.filter(F.col("seq") < config.end_seq)
    if output is not None:
        at = scan.resume_point(output, config.state_header)
        rows = by_stream(rows, at).filter(F.col("seq") > F.coalesce("resume_seq", F.lit(0))).drop("resume_seq")
    out = rows.withColumn("headers", copied(F.col("headers"), F.col("seq"), config.state_header, config.drop_msg_id))
    return out.withColumn("subject", F.lit(config.subject)) if config.subject else out


def validate(log: DataFrame, start_seq: int = 0, contiguous: bool = False, hash_ci: bool = False) -> DataFrame:
    """The first violation of each stream from ``start_seq`` on, whose row has no predecessor to be checked against."""
    return verify.first_violation(log.filter(F.col("seq") >= start_seq), contiguous=contiguous, hash_ci=hash_ci)


def multi_bridge(inputs: DataFrame, start_height: int = 0, columns: tuple[str, ...] | None = None) -> DataFrame:
    return merge.merged(inputs, start_height, columns=columns)


def shrink(log: DataFrame, limit_bytes: int) -> DataFrame:
    """The log as a lowered byte limit leaves it."""
    return retention.newest_bytes(log, limit_bytes, F.col("bytes") if "bytes" in log.columns else None)
