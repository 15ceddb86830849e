"""Which form of chain extraction a configuration needs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import chain
from ..operators.chain import Bridge
from ..operators.tolerance import Tolerances


def form(bridge: Bridge) -> str:
    """"records" or "fold": the closed form runs each stream in parallel segments, the fold in one task."""
    v = bridge.verifier
    plain = not (v.check_completion or v.check_hashes or v.shard_filter is not None)
    free = bridge.tolerances == Tolerances() and bridge.anchor == chain.Anchor()
    if plain and free and v.allow_gaps and not bridge.buffer:
        return "records"
    return "fold"


def rows(log: DataFrame, bridge: Bridge, tips: DataFrame | None = None) -> DataFrame:
    """The rows that the bridge writes, as they are in the log; after the tips (a row a stream that has one), where there are any.

    A tip that is at or beyond the last or the end block leaves nothing to write.
    """
    if tips is not None:
        log = chain.with_tips(log, tips)
    if form(bridge) == "fold":
        return chain.written(log, bridge).filter("event = 'written'").drop("out_seq", "event")
    if tips is None:
        return chain.take_while(chain.records(log), bridge.last_block, bridge.end_block)
    # a tip is its stream's first row: it stands before all others
    placed = log.withColumn("__place", F.when(F.col(chain.TIP), F.lit(-(1 << 62))).otherwise(F.col("seq")))
    kept = chain.take_while(chain.records(placed, order="__place"), bridge.last_block, bridge.end_block, order="__place")
    return kept.filter(~F.col(chain.TIP)).drop(chain.TIP, "__place")


def extract(log: DataFrame, bridge: Bridge) -> DataFrame:
    """stream_id (as a string), seq of the rows that the bridge writes."""
    return rows(log.select(*[c for c in chain.NEEDED if c in log.columns]), bridge).select(F.col("stream_id").cast("string").alias("stream_id"), "seq")
