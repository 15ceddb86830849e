"""Message ids ``height`` or ``height.shard``, and the order of blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ANNOUNCEMENT, SHARD

_FORM = r"^([0-9]+)(?:\.([0-9]+))?$"
#: Largest unsigned number of 64 bits.
_MOST = "18446744073709551615"


def _unsigned(text: Column) -> Column:
    """A decimal(20,0), or null beyond 64 bits; the form is checked before."""
    number = text.try_cast("decimal(38,0)")
    return F.when(number <= F.lit(_MOST).cast("decimal(20,0)"), number.try_cast("decimal(20,0)"))


def parse(text: Column) -> Column:
    """struct<height, block_type, shard_id, error>: digits alone are an announcement, with a dot and digits a shard; anything else, or beyond 64 bits, is an error."""
    text = F.coalesce(text, F.lit(""))
    formed = text.rlike(_FORM)
    height = F.when(formed, _unsigned(F.substring_index(text, ".", 1)))
    part = F.when(F.contains(text, F.lit(".")), F.substring_index(text, ".", -1)).otherwise("")
    shard = F.when(formed & (part != ""), _unsigned(part))
    bad = height.isNull() | ((part != "") & shard.isNull())
    return F.struct(
        F.when(~bad, height).alias("height"),
        F.when(~bad, F.when(part == "", ANNOUNCEMENT).otherwise(SHARD)).cast("int").alias("block_type"),
        F.when(~bad, F.coalesce(shard, F.lit(0).cast("decimal(20,0)"))).alias("shard_id"),
        F.when(bad, F.lit("invalid message id")).alias("error"),
    )


def construct(height: Column, block_type: Column, shard_id: Column) -> Column:
    return F.concat_ws(".", height.cast("string"), F.when(block_type == SHARD, shard_id.cast("string")))


def order_key(height: Column, block_type: Column, shard_id: Column) -> Column:
    """Orders blocks by height, then announcements, shards (by shard) and unknown ones; equal keys are equal blocks."""
    return F.struct(height.alias("height"), block_type.alias("block_type"), F.when(block_type == SHARD, shard_id).otherwise(F.lit(0)).cast("long").alias("shard"))
