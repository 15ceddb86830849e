"""Rows of block and message logs, and the fixed vocabularies that classify them."""

from __future__ import annotations

from pyspark.sql import types as T

#: Block types. Fixed values.
ANNOUNCEMENT, SHARD, UNKNOWN = 0, 1, 2
BLOCK_TYPE_NAMES = {ANNOUNCEMENT: "[H]", SHARD: "[B]", UNKNOWN: "Unknown"}

MESSAGE = T.StructType(
    [
        T.StructField("stream_id", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("subject", T.StringType()),
        T.StructField("headers", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
        T.StructField("data", T.BinaryType()),
    ]
)
BLOCK = T.StructType(
    [
        T.StructField("height", T.LongType()),
        T.StructField("block_type", T.ByteType()),
        T.StructField("shard_id", T.LongType()),
        T.StructField("hash", T.StringType()),
        T.StructField("prev_hash", T.StringType()),
        T.StructField("shard_mask", T.ArrayType(T.BooleanType())),
    ]
)

#: Why a row cannot be appended, and the class that follows from it. Fixed values.
REASON_CLASS = {
    "OK": "ok",
    "FilteredShard": "irrelevant",
    "UnknownBlockType": "irrelevant",
    "LowHeight": "low",
    "Reannouncement": "low",
    "LowShard": "low",
    "UnwantedShard": "low",
    "ShardHashConflict": "low",
    "IncompletePreviousBlock": "high",
    "UnannouncedBlock": "high",
    "HeightGap": "high",
    "HashMismatch": "high",
    "ShardGap": "high",
}

#: Headers that a log writes itself, and the one that identifies a message. Fixed values.
MESSAGE_ID = "Nats-Msg-Id"
SERVICE_HEADERS = (
    MESSAGE_ID,
    "Nats-Expected-Stream",
    "Nats-Expected-Last-Sequence",
    "Nats-Expected-Last-Subject-Sequence",
    "Nats-Expected-Last-Msg-Id",
    "Nats-Rollup",
)
#: Where a copy keeps the sequence number of its original.
STATE_HEADER = "X-Source-Seq"
