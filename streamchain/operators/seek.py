"""Seeks: where a scan has to start so that it meets a block or a sequence number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.msgid import order_key


def _bounds(log: DataFrame) -> DataFrame:
    return log.groupBy("stream_id").agg(F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))


def seek_block(log: DataFrame, height: int, block_type: int = 0, shard_id: int = 0, start: int = 0, end: int = 0, only_greater: bool = False) -> DataFrame:
    """stream_id, seq of the first row in [start, end) whose block is at or after (or only after) the target, and the outcome.

    Outcome "empty": the range, or the stream's part of it, holds nothing to read. Past all
    rows, seq is the one after the last. Rows without a block (null height) count as greater.
    One aggregate; bounds on seq reach the scan.
    """
    key = order_key(F.col("height"), F.col("block_type"), F.col("shard_id"))
    target = order_key(F.lit(height).cast("long"), F.lit(block_type), F.lit(shard_id).cast("long"))
    reached = F.col("height").isNull() | ((key > target) if only_greater else (key >= target))
    inside = F.col("seq") >= start
    if end:
        inside &= F.col("seq") < end
    found = log.groupBy("stream_id").agg(F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.min(F.when(inside & reached, F.col("seq"))).alias("hit"))
    return outcome(found, start, end)


def outcome(found: DataFrame, start: int, end: int) -> DataFrame:
    """stream_id, seq and outcome of a seek in [start, end), from each stream's first_seq, last_seq and hit."""
    low = F.greatest(F.lit(1).cast("long"), F.col("first_seq"), F.lit(start).cast("long"))
    empty = F.lit(bool(end and start >= end)) | (F.lit(bool(end)) & (F.col("first_seq") >= end))
    past = low > F.col("last_seq")
    cut = F.col("hit").isNull() & F.lit(bool(end)) & (F.col("last_seq") + 1 >= end)
    seq = F.when(empty, None).when(past, low).when(cut, None).otherwise(F.coalesce("hit", F.col("last_seq") + 1))
    return found.select("stream_id", seq.alias("seq"), F.when(seq.isNull(), "empty").otherwise("found").alias("outcome"))


def seek_seq(log: DataFrame, target: int, start: int = 0, end: int = 0) -> DataFrame:
    """stream_id and max(1, first seq, start, target), or "empty" where the range ends before the start, the target or the first seq."""
    empty = F.lit(bool(end and (start >= end or target >= end))) | (F.lit(bool(end)) & (F.col("first_seq") >= end))
    seq = F.when(~empty, F.greatest(F.lit(1).cast("long"), F.col("first_seq"), F.lit(start).cast("long"), F.lit(target).cast("long")))
    return _bounds(log).select("stream_id", seq.alias("seq"), F.when(seq.isNull(), "empty").otherwise("found").alias("outcome"))


def seek_height(log: DataFrame, target: Column) -> DataFrame:
    """stream_id and the greatest seq whose height is at most the target; null if there is none."""
    return log.groupBy("stream_id").agg(F.max(F.when(F.col("height") <= target, F.col("seq"))).alias("seq"))


def plan(tip: tuple | None, anchor_output_seq: int, tip_seq: int, anchor: tuple | None = None, pre_anchor: tuple | None = None, anchor_input_seq: int = 0) -> dict:
    """Which seek starts a session: after the tip; else at the anchor block, after the pre-anchor, or at the anchor seq. Blocks are (height, type, shard)."""
    if tip is not None:
        return {"seek": "block", "target": tip, "only_greater": True}
    if not anchor_output_seq or anchor_output_seq != tip_seq + 1:
        raise ValueError(f"the output's next seq is {tip_seq + 1}, the anchor wants {anchor_output_seq}")
    if anchor is not None:
        return {"seek": "block", "target": anchor, "only_greater": False}
    if pre_anchor is not None:
        return {"seek": "block", "target": pre_anchor, "only_greater": True}
    if anchor_input_seq:
        return {"seek": "seq", "target": anchor_input_seq}
    raise ValueError("no tip, and no anchor to start from")
