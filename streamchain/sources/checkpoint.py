"""Cutting lineage through the folder that a cluster's executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_ENDING: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where it names none, a folder of this machine, which only a local master's tasks reach: others must name one."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("executors share no folder: set spark.checkpoint.dir")
        context.setCheckpointDir(named or f"file://{tempfile.gettempdir()}/streamchain-checkpoints")
    folder = context.getCheckpointDir()
    if folder not in _ENDING:  # Spark's own folder of this application: what was cut goes when it ends
        _ENDING.add(folder)
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return folder


def own_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, which goes when the application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(at)
    system.deleteOnExit(at)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def cut(df: DataFrame) -> DataFrame:
    """The rows in the shared checkpoint folder, without lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
