"""Compare-and-append writes, judged against a snapshot of the output; and what surrounds a position in it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.checkpoint import cut

#: Streams whose bounds or resume points may be broadcast.
FEW_STREAMS = 100_000


def by_stream(log: DataFrame, points: DataFrame, most: int = FEW_STREAMS) -> DataFrame:
    """The log with its streams' points (a row a stream): broadcast if they are counted to be few, else by a shuffle of both."""
    points = cut(points)  # made once, for the count and for the join
    few = points.limit(most + 1).count() <= most
    points = points.withColumnRenamed("stream_id", "of_")
    return log.join(F.broadcast(points) if few else points, F.col("stream_id").eqNullSafe(F.col("of_")), "left").drop("of_")


def on_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """A join on keys in which nulls are equal: rows without a stream are a stream of their own."""
    right = right.withColumnsRenamed({k: f"of_{k}" for k in keys})
    both = left.join(right, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys]), how)
    return both.drop(*[f"of_{k}" for k in keys])


def classify_writes(requests: DataFrame, output: DataFrame) -> DataFrame:
    """Requests (stream_id, msg_id, pred_seq, pred_msg_id) with outcome and metric status against the output (stream_id, seq, msg_id).

    An empty pred_msg_id isn't enforced. An id that the output has (its last seq counts) is a
    duplicate if it is in its place, else a collision. Joins on keys, none of which can multiply a
    request: by id; and by the position after the predecessor, which only requests of unknown ids
    within the output's bounds are moved for. The predecessor itself matters where it is the last
    row alone, so the bounds have it: a row a stream, broadcast where these are few.
    """
    own = output.select("stream_id", "seq", "msg_id")
    last_row = F.max(F.struct("seq", "msg_id")).alias("last_row")
    bounds = own.groupBy("stream_id").agg(F.min("seq").alias("first_seq"), last_row).select("stream_id", "first_seq", F.col("last_row.seq").alias("last_seq"), F.col("last_row.msg_id").alias("last_id"))
    known = own.groupBy("stream_id", "msg_id").agg(F.max("seq").alias("known_seq"))
    r = cut(by_stream(on_keys(requests, known, ["stream_id", "msg_id"]), bounds))
    asks = F.coalesce(F.col("known_seq").isNull() & (F.col("pred_seq") + 1 >= F.col("first_seq")) & (F.col("pred_seq") + 1 <= F.col("last_seq")), F.lit(False))
    wanted = r.filter(asks).select("stream_id", (F.col("pred_seq") + 1).alias("seq"))
    if wanted.limit(FEW_STREAMS + 1).count() <= FEW_STREAMS:
        own = on_keys(own, F.broadcast(wanted), ["stream_id", "seq"], "left_semi")
    places = own.groupBy("stream_id", (F.col("seq") - 1).alias("pred_seq")).agg(F.max("msg_id").alias("place_id"))
    placed = on_keys(r.filter(asks), places, ["stream_id", "pred_seq"])
    r = placed.unionByName(r.filter(~asks).withColumn("place_id", F.lit(None).cast("string")))
    pred, last, free = F.col("pred_seq"), F.coalesce("last_seq", F.lit(0)), F.col("pred_msg_id") == ""
    rules = [
        (F.col("known_seq") == pred + 1, "OK", "duplicate"),
        (F.col("known_seq").isNotNull(), "Collision", "collision"),
        ((pred == last) & (free | (F.col("pred_msg_id") == F.col("last_id"))), "OK", "success"),
        (pred + 1 < F.col("first_seq"), "RemovedPosition", "desync"),
        ((pred + 1 <= last) & F.col("place_id").isNotNull() & (F.col("place_id") != F.col("msg_id")), "Collision", "collision"),
        ((pred + 1 <= last) & (F.col("place_id") == F.col("msg_id")), "OK", "duplicate"),
        ((pred == 0) & ~free, "WrongPredecessor", "collision"),
        (pred == 0, "TemporarilyUnavailable", "error"),
        ((pred == last) & ~free & F.col("last_id").isNull(), "RemovedPredecessor", "desync"),
        ((pred == last) & ~free, "WrongPredecessor", "collision"),
        (pred == last, "TemporarilyUnavailable", "error"),
        (pred > last, "WrongPredecessor", "collision"),
    ]
    outcome, status = F.when(*[rules[0][0], rules[0][1]]), F.when(*[rules[0][0], rules[0][2]])
    for when, o, s in rules[1:]:
        outcome, status = outcome.when(when, o), status.when(when, s)
    return r.select(*requests.columns, outcome.otherwise("RemovedPosition").alias("outcome"), status.otherwise("desync").alias("status"))


def seqs_around(centres: DataFrame, reach: int = 3) -> DataFrame:
    """stream_id, seq: the distinct seqs from 1 on within reach of any of the centres (stream_id, centre)."""
    around = F.sequence(F.greatest(F.lit(1).cast("long"), F.col("centre") - reach), F.col("centre") + reach)
    return centres.select("stream_id", F.explode(around).alias("seq")).distinct()


def live_tips(output: DataFrame, deleted: DataFrame) -> DataFrame:
    """stream_id, seq and height of each output's last row; without seq and height where the log has already deleted up to it (deleted: stream_id, deleted_seq)."""
    last = output.groupBy("stream_id").agg(F.max_by(F.struct("seq", "height"), "seq").alias("tip"))
    gone = F.coalesce(F.col("deleted_seq") >= F.col("tip.seq"), F.lit(False))
    both = on_keys(last, deleted, ["stream_id"])
    return both.select("stream_id", F.when(~gone, F.col("tip.seq")).alias("seq"), F.when(~gone, F.col("tip.height")).alias("height"))


def vicinity(centres: DataFrame, output: DataFrame, reach: int = 3) -> DataFrame:
    """For each centre (stream_id, centre): what the seqs around it hold. ``found`` is message, removed or not yet."""
    around = F.explode(F.sequence(F.greatest(F.lit(1).cast("long"), F.col("centre") - reach), F.col("centre") + reach))
    asked = centres.select("stream_id", "centre", around.alias("seq"))
    last = output.groupBy("stream_id").agg(F.max("seq").alias("last_seq"))
    rows = on_keys(on_keys(asked, output.select("stream_id", "seq", "msg_id"), ["stream_id", "seq"]), last, ["stream_id"])
    found = F.when(F.col("msg_id").isNotNull(), "message").when(F.col("seq") > F.coalesce("last_seq", F.lit(0)), "not yet").otherwise("removed")
    return rows.select("stream_id", "centre", "seq", found.alias("found"), "msg_id")
