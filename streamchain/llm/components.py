"""Connected components of a table of links, by rounds of star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.checkpoint import cut, shared_folder

__all__ = ["components", "cut", "shared_folder"]


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Each node's larger neighbours (large star), or it and its smaller ones (small star), now hang on the smallest of all."""
    if large:
        around = links.union(links.select("b", "a")).toDF("node", "other")
        least = around.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
        moved = around.join(least, "node").filter("other > node").select(F.col("other").alias("a"), F.col("least").alias("b"))
    else:
        around = links.toDF("node", "other")  # a is the larger end
        least = around.groupBy("node").agg(F.min("other").alias("least"))
        moved = around.join(least, "node").select(F.col("other").alias("a"), F.col("least").alias("b")).union(least.select("node", "least"))
    return moved.filter("a <> b").distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """node, component (the smallest node that links reach) for every node of the links (a, b); links without an end or to oneself don't count.

    Alternates large and small stars until they change nothing: the rounds grow with the
    logarithm of the nodes. Links stay distributed, each round's are cut by a checkpoint, and
    only their count and a checksum reach the driver.
    """
    links = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a is not null and b is not null and a <> b").distinct())
    seen = None
    while True:
        links = cut(_star(_star(links, large=True), large=False))
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(links.select("b", "b").distinct())
