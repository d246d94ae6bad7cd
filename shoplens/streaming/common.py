"""Shared pieces of the streaming jobs: triggers and state partitioning."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


def with_trigger(writer: DataStreamWriter, trigger: dict | None) -> DataStreamWriter:
    """``trigger`` as keyword arguments, e.g. {"processingTime": "3 seconds"} (T1);
    default ``availableNow`` (process what is there in bounded batches, then stop)."""
    return writer.trigger(**(trigger or {"availableNow": True}))


def start(writer: DataStreamWriter, spark: SparkSession, trigger: dict | None,
          state_partitions: int | None = None):
    """Start a query; ``state_partitions`` sets its shuffle / state-store partition
    count.  A streaming query clones the session when it starts and records
    the count in its checkpoint on the first run, so the session value is set
    only around ``start()`` and restored right after."""
    writer = with_trigger(writer, trigger)
    if not state_partitions:
        return writer.start()
    old = spark.conf.get(SHUFFLE_PARTITIONS)
    spark.conf.set(SHUFFLE_PARTITIONS, str(int(state_partitions)))
    try:
        return writer.start()
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, old)
