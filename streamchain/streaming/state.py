"""What live operators with typed state share."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stored(spark: SparkSession) -> None:
    """Have state in RocksDB, which several state variables and timers need. Queries that are started again keep the store that they began with."""
    if "RocksDB" not in (spark.conf.get(_PROVIDER, "") or ""):
        spark.conf.set(_PROVIDER, _ROCKSDB)


def arm(handle: StatefulProcessorHandle, at_ms: int) -> None:
    """One timer a key: at this time, or earlier if one is set."""
    if not any(True for _ in handle.listTimers()):
        handle.registerTimer(at_ms)
