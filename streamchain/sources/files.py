"""Logs as Parquet tables, partitioned by stream and sorted by seq, so that seq ranges skip row groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """The same as it grows; the query's checkpoint holds what has been read."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


def write(log: DataFrame, path: str, segment: int = 1 << 20, mode: str = "errorifexists", placed: bool = False) -> None:
    """One file a stream and segment of seqs; or, where rows are ``placed`` already, a stream and task."""
    if not placed:
        log = log.withColumn("segment", F.expr(f"seq div {segment}")).repartition("stream_id", "segment").drop("segment")
    log.sortWithinPartitions("stream_id", "seq").write.mode(mode).partitionBy("stream_id").parquet(path)
