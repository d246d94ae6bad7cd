"""Streaming daily actives with keyed state in the JVM (T2): work and state per batch,
no reading of the stored table.

A streaming aggregation keyed by (device, day) keeps the earliest start-up; in
``update`` mode a batch emits the device-days that it changed, which replace the
stored row of their key (newest batch wins on read).  A device that comes again
later changes nothing and writes nothing new but its unchanged row; an earlier row
that arrives late replaces the first one, so the result is the batch operator's for
any order of arrival.  Grouping by the UTC day of the event time as well lets the
watermark drop the state of days that are over.

Rows without a device or a time are left out, as in ``streaming.dau``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.decode import decode_startup
from shoplens.operators import dau
from shoplens.sources import store
from shoplens.sources.schemas import STARTUP_COLUMNS
from shoplens.streaming.common import start as start_query


def first_seen(logs: DataFrame, watermark: str = "1 day") -> DataFrame:
    """``logs``: streaming StartUpLog rows -> the changed first rows of each (mid, logDate, UTC day)."""
    good = logs.where(F.col("mid").isNotNull() & F.col("logDate").isNotNull())
    timed = good.withColumn("event_time", F.timestamp_millis("ts")).withWatermark("event_time", watermark)
    rest = [c for c in STARTUP_COLUMNS if c not in (*dau.KEY, "ts")]
    best = F.min(F.struct("ts", *rest)).alias("first")
    days = timed.groupBy(F.window("event_time", "1 day").alias("day"), *dau.KEY).agg(best)
    return days.select(*dau.KEY, "first.*").select(*STARTUP_COLUMNS)


def start(lines: DataFrame, table_path: str, checkpoint: str, zone: str = "UTC", watermark: str = "1 day",
          trigger: dict | None = None, state_partitions: int | None = None):
    def process(batch: DataFrame, batch_id: int) -> None:
        store.write_batch(batch, table_path, batch_id, "logDate")

    writer = (first_seen(decode_startup(lines, zone), watermark).writeStream.outputMode("update")
              .foreachBatch(process).option("checkpointLocation", checkpoint))
    return start_query(writer, lines.sparkSession, trigger, state_partitions)


def read(spark: SparkSession, table_path: str, days: list[str] | None = None) -> DataFrame | None:
    """One row per (mid, logDate): the earliest of what the batches stored (a local day
    of another zone touches two UTC days)."""
    rows = (store.read_partitions(spark, table_path, "logDate", days) if days
            else store.read_rows(spark, table_path, "logDate"))
    return None if rows is None else dau.first_seen(rows.drop(store.BATCH).select(*STARTUP_COLUMNS))
