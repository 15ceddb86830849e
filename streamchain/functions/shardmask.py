"""Shard masks and filters: arrays of booleans by shard id. Null is no filter; an empty array lets nothing pass."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import SHARD

#: Largest shard id in a mask expression. Fixed value.
MOST = 10_000
_ITEM = r"^\s*([0-9]+)\s*(?:-\s*([0-9]+)\s*)?$"


def parse(text: Column) -> Column:
    """struct<mask array<boolean>, error string> of "1-3, 5": "" is null, "-" empty."""
    items = F.transform(
        F.split(text, ",", -1),
        lambda x: F.struct(F.regexp_extract(x, _ITEM, 1).try_cast("int").alias("low"), F.coalesce(F.nullif(F.regexp_extract(x, _ITEM, 2), F.lit("")), F.regexp_extract(x, _ITEM, 1)).try_cast("int").alias("high")),
    )
    good = F.forall(items, lambda x: F.coalesce((x["low"] <= x["high"]) & (x["high"] <= MOST), F.lit(False)))
    ids = F.flatten(F.transform(items, lambda x: F.sequence(x["low"], x["high"])))
    mask = F.transform(F.sequence(F.lit(0), F.array_max(ids)), lambda i: F.array_contains(ids, i))
    plain = (text != "") & (text != "-")
    return F.struct(
        F.when(text == "-", F.array().cast("array<boolean>")).when(plain & good, mask).alias("mask"),
        F.when(plain & ~good, F.lit("invalid shard mask")).alias("error"),
    )


def parse_text(text: str) -> list[bool] | None:
    """The same on the driver, for options; raises ValueError."""
    if text in ("", "-"):
        return None if text == "" else []
    ids: set[int] = set()
    for item in text.split(","):
        found = re.fullmatch(_ITEM, item)
        low, high = (int(found[1]), int(found[2] or found[1])) if found else (1, 0)
        if not low <= high <= MOST:
            raise ValueError(f"invalid shard mask: {text!r}")
        ids.update(range(low, high + 1))
    return [i in ids for i in range(max(ids) + 1)]


def passes(mask: Column, shard_id: Column) -> Column:
    return F.when(mask.isNull(), True).otherwise(F.coalesce(F.get(mask, shard_id.cast("int")), F.lit(False)))


def next_needed(mask: Column, block_type: Column, shard_id: Column, shard_filter: Column) -> Column:
    """The smallest shard after the row's own that the mask has and the filter lets pass; null if the block is complete."""
    start = F.when(block_type == SHARD, shard_id + 1).otherwise(F.lit(0)).cast("int")
    size = F.coalesce(F.size(mask), F.lit(0))
    ids = F.when(start < size, F.sequence(start, size - 1))
    return F.get(F.filter(ids, lambda i: F.get(mask, i) & passes(shard_filter, i)), F.lit(0))


def is_complete(mask: Column, block_type: Column, shard_id: Column, shard_filter: Column) -> Column:
    return next_needed(mask, block_type, shard_id, shard_filter).isNull()
