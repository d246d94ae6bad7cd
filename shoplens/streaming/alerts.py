"""Streaming coupon alerts (W1 + A5 + A8 + S10 / S11).

The windowed rule aggregates run as a stateful streaming aggregation with a
watermark (state is dropped once the watermark passes a window's end).  The
job runs in ``update`` mode and stores the aggregate row of every updated
(device, window, event type) in the folder of the window's day: a window that
later sees a click simply gets a newer row, and types are merged and the alert
filter is applied on read.  Readers take ``days`` (only those folders are listed):
  * ``read_alerts``      alerts of the latest state of each window
  * ``read_per_minute``  one document per mid || epoch-minute (A8 a / S10)
  * ``read_throttled``   alerts >= 60 s apart per device (A8 b / S11)
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.decode import decode_event
from shoplens.operators import alerts
from shoplens.sources import store
from shoplens.streaming.common import start as start_query


DAY = "day"


def day_of(ms: str) -> Column:
    """The UTC day of an epoch-ms column (zone independent)."""
    return F.date_format((F.lit("1970-01-01").cast("timestamp_ntz")
                          + F.make_dt_interval(secs=F.floor(F.col(ms) / 1000))), "yyyy-MM-dd")


def day_text(ms: int) -> str:
    """The same of a number."""
    return (datetime.date(1970, 1, 1) + datetime.timedelta(days=ms // 86_400_000)).isoformat()


def batch_writer(table_path: str):
    def process(batch: DataFrame, batch_id: int) -> None:
        store.write_batch(batch.withColumn(DAY, day_of("window_start")), table_path, batch_id, DAY)

    return process


def start(events: DataFrame, table_path: str, checkpoint: str, length: str = "5 minutes",
          slide: str | None = "1 minute", watermark: str = "10 minutes",
          trigger: dict | None = None, decoded: bool = False, state_partitions: int | None = None):
    """``events``: JSON event lines (column ``value``) or, with ``decoded``, EventLog rows."""
    ev = events if decoded else decode_event(events)
    state = alerts.type_state(ev, length, slide, watermark)
    writer = (state.writeStream.outputMode("update").foreachBatch(batch_writer(table_path))
              .option("checkpointLocation", checkpoint))
    return start_query(writer, events.sparkSession, trigger, state_partitions)


def read_state(spark: SparkSession, table_path: str, days: list[str] | None = None) -> DataFrame | None:
    """The newest aggregates of each window, of all days or of the given ones."""
    rows = (store.read_partitions(spark, table_path, DAY, days) if days
            else store.read_rows(spark, table_path, DAY))
    if rows is None:
        return None
    types = store.latest(rows.drop(DAY), [*alerts.TYPE_KEYS, "evid"]).drop(store.BATCH)
    return alerts.merge_types(types)


def read_alerts(spark: SparkSession, table_path: str, min_uids: int = 3,
                days: list[str] | None = None) -> DataFrame | None:
    state = read_state(spark, table_path, days)
    return None if state is None else alerts.alerts_from_state(state, min_uids)


def read_per_minute(spark: SparkSession, table_path: str, min_uids: int = 3,
                    days: list[str] | None = None) -> DataFrame | None:
    a = read_alerts(spark, table_path, min_uids, days)
    return None if a is None else alerts.per_minute(a)


def read_throttled(spark: SparkSession, table_path: str, gap_seconds: int = 60,
                   min_uids: int = 3, days: list[str] | None = None) -> DataFrame | None:
    a = read_alerts(spark, table_path, min_uids, days)
    return None if a is None else alerts.throttle(a, gap_seconds)


# ---- final alerts + throttle (A8 b as a streaming operator) -------

ALERT_SCHEMA = ("mid string, window_start long, window_end long, ts long, doc_id string, n_uids long, "
                "uids string, item_ids string, events string, n_events long")
#: Folder column of the final and throttled outputs.
OUT_SCHEMA = f"{ALERT_SCHEMA}, {DAY} string"


def start_final(events: DataFrame, out_path: str, checkpoint: str, length: str = "5 minutes",
                slide: str | None = "1 minute", watermark: str = "10 minutes",
                trigger: dict | None = None, decoded: bool = False, min_uids: int = 3,
                state_partitions: int | None = None, panes: bool = False):
    """Alerts of closed windows only (append mode): a window is emitted once,
    after the watermark passes its end, and never revised.  ``panes`` builds
    sliding windows from slide-sized panes (two chained aggregations), so a
    small slide does not copy every event into length/slide windows."""
    ev = events if decoded else decode_event(events)
    if panes and slide:
        state = alerts.pane_stream_state(ev, length, slide, watermark)
    else:
        state = alerts.final_state(ev, length, slide, watermark)
    final = alerts.alerts_from_state(state, min_uids)
    writer = (final.withColumn(DAY, day_of("window_start")).writeStream.outputMode("append")
              .format("parquet").partitionBy(DAY)
              .option("path", out_path).option("checkpointLocation", checkpoint))
    return start_query(writer, events.sparkSession, trigger, state_partitions)


def last_kept(spark: SparkSession, out_path: str, since_ms: int, batch_id: int) -> DataFrame | None:
    """(mid, last_ts): the last alert kept at ``since_ms`` or later, per device, by other batches.
    Only the folders from that day on are read; a device silent since then costs nothing."""
    rows = store.read_rows(spark, out_path, DAY)
    if rows is None:
        return None
    return (rows.where((F.col(DAY) >= day_text(since_ms)) & (F.col("ts") >= since_ms) & (F.col(store.BATCH) != batch_id))
            .groupBy("mid").agg(F.max("ts").alias("last_ts")))


def throttle_writer(out_path: str, gap_seconds: int = 60):
    """A micro-batch of alerts is throttled as a whole, by the batch operator, against what was
    kept before.  An alert older than the last kept one (a late micro-batch) is within the gap by
    definition and is dropped.  A replayed batch leaves out what it wrote itself.  Folders are
    the days of the alerts."""
    def process(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            first = rows.agg(F.min("ts")).first()[0]
            if first is None:
                return
            seed = last_kept(batch.sparkSession, out_path, first - 1000 * gap_seconds, batch_id)
            kept = alerts.throttle(rows, gap_seconds, seed)
            store.write_batch(kept.withColumn(DAY, day_of("ts")), out_path, batch_id, DAY)
        finally:
            rows.unpersist()

    return process


def start_throttle(spark: SparkSession, alerts_path: str, out_path: str, checkpoint: str,
                   gap_seconds: int = 60, trigger: dict | None = None,
                   state_partitions: int | None = None):
    """Streaming 60 s throttle (A8 b / S11).  Its state is the kept table itself, of which a batch
    reads the folders from its earliest alert on: nothing is held for silent devices,
    and no device's alerts are gathered (see ``operators.throttle``)."""
    src = spark.readStream.schema(OUT_SCHEMA).parquet(alerts_path).drop(DAY)
    writer = src.writeStream.foreachBatch(throttle_writer(out_path, gap_seconds)).option("checkpointLocation", checkpoint)
    return start_query(writer, spark, trigger, state_partitions)


def read_kept(spark: SparkSession, out_path: str, days: list[str] | None = None) -> DataFrame:
    """The alerts of ``start_final`` or ``start_throttle``; with ``days`` only those folders.
    A job that has kept none yet has no folder: no rows."""
    if not store.exists(spark, out_path):
        return spark.createDataFrame([], ALERT_SCHEMA)
    rows = spark.read.schema(OUT_SCHEMA).parquet(out_path)
    return (rows.where(F.col(DAY).isin(days)) if days else rows).drop(DAY, store.BATCH)
