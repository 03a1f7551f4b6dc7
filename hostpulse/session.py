"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def pin(spark: SparkSession) -> SparkSession:
    """Bucket time in UTC whatever the machine's zone; leave sizing to the cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def open_session(app: str = "hostpulse", settings: dict[str, str] | None = None) -> SparkSession:
    """Session for the batch and live jobs.

    Shuffle width is not fixed here: adaptive execution merges small partitions
    and splits skewed ones at run time, and a job that needs another starting
    width passes it in ``settings``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # State per host and window grows with the number of hosts: keep it off the heap.
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return pin(builder.getOrCreate())
