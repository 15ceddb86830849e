"""Packed exchange of hashes between blocks of documents and shards of the hash space.

Documents lie in blocks of a few MB of text. A block sends each shard one row that holds all
of its hashes there (distinct and sorted, four bytes each), rather than a row for each hash;
a shard answers each block with a row of as many flags or small numbers, in the same order.
So neither ids nor positions travel: the block finds them again from its texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text bytes of a block, about.
BLOCK_BYTES = 8 << 20


def block_count(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    """So many blocks that each has about ``block_bytes`` of text."""
    held = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-held // block_bytes))


def blocked(docs: DataFrame, blocks: int) -> DataFrame:
    """doc_id and text with the number of their block, which a hash of both deals out: rows without id, or of one id, lie in many, as long as their texts differ."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))


def keys(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Hash -> shard in the upper half and 32 more bits in the lower: what tells hashes apart in the exchange."""
    shard = (hashes >> np.uint64(32)) % np.uint64(shards)
    return shard << np.uint64(32) | hashes & np.uint64(0xFFFFFFFF)


def by_shard(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shards that occur in the sorted keys, and where each begins and ends."""
    shard = (sorted_keys >> np.uint64(32)).astype(np.int64)
    begins = runs(shard)
    return shard[begins], begins, run_ends(begins, len(shard))


def planes(values: np.ndarray) -> bytes:
    """The bytes of the numbers, all lowest ones first: where most numbers are small, the rest compresses to nothing."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def runs(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)


def run_ends(begins: np.ndarray, count: int) -> np.ndarray:
    """Where each run ends, of ``count`` values in all; none where there are no values."""
    return np.append(begins[1:], count) if len(begins) else np.zeros(0, np.int64)


def table(schema: dict, rows: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.values(), strict=True)], names=list(schema))
