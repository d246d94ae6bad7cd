"""Streaming daily actives (T2): first start-up per (device, day) across micro-batches.

Per micro-batch (``foreachBatch``):
  1. read the stored first-seen rows of only the days present in the batch
     (only those ``logDate`` folders are listed), excluding this batch's own
     folder so a replayed batch gives the same answer;
  2. anti-join the batch against them (the stronger dedup first), then keep
     the earliest row per (mid, logDate) inside the batch;
  3. write the result into ``logDate=<d>/batch=<id>`` (idempotent).
Across batches the first batch that sees a device wins; inside a batch, the
earliest ts.  The checkpoint makes the whole job exactly-once on restart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.decode import decode_startup
from shoplens.operators import dau
from shoplens.sources import store
from shoplens.streaming.common import start as start_query


def batch_writer(table_path: str, reject_path: str | None = None):
    """Rows without a device or a time (malformed JSON) go to ``reject_path``, one
    folder per batch, and never into the table.  The join of the batch with the
    stored days is left to the optimizer: AQE measures both sides and broadcasts
    the smaller one where it fits."""

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        good = F.col("mid").isNotNull() & F.col("logDate").isNotNull()
        logs = batch.persist()
        try:
            bad = logs.where(~good)
            if reject_path is not None:
                store.write_batch(bad, reject_path, batch_id, None)
            fresh = logs.where(good)
            # the batch's days: the folders that it touches are listed, no others
            days = [r[0] for r in fresh.select("logDate").distinct().limit(MAX_DAYS + 1).collect()]
            if len(days) > MAX_DAYS:  # corrupt times can name any day: read the whole table instead
                stored = store.read_rows(spark, table_path, "logDate")
            else:
                stored = store.read_partitions(spark, table_path, "logDate", days) if days else None
            if stored is not None:
                seen = stored.where(F.col(store.BATCH) != batch_id).select(*dau.KEY)
                fresh = dau.new_against(fresh, seen)
            store.write_batch(dau.first_seen(fresh), table_path, batch_id, "logDate")
        finally:
            logs.unpersist()

    return process


#: Days of one batch whose folders are listed one by one.
MAX_DAYS = 400


def start(lines: DataFrame, table_path: str, checkpoint: str, zone: str = "UTC",
          trigger: dict | None = None, state_partitions: int | None = None, reject_path: str | None = None):
    """Start the job on a stream of JSON start-up lines (column ``value``)."""
    logs = decode_startup(lines, zone)
    writer = (logs.writeStream.foreachBatch(batch_writer(table_path, reject_path))
              .option("checkpointLocation", checkpoint))
    return start_query(writer, lines.sparkSession, trigger, state_partitions)


def expiring_writer(table_path: str, ttl_hours: int = 24):
    """The seen sets of ``operators.dau.openings`` across micro-batches.  The table is the state:
    each row carries the set that it is in, so a batch reads the stored folders of its own days
    to know their last set and its members, and nothing else."""
    def process(batch: DataFrame, batch_id: int) -> None:
        good = F.col("mid").isNotNull() & F.col("logDate").isNotNull() & F.col("arrived").isNotNull()
        logs = batch.where(good).persist()
        try:
            days = [r[0] for r in logs.select("logDate").distinct().collect()]
            stored = store.read_partitions(batch.sparkSession, table_path, "logDate", days) if days else None
            if stored is not None:
                stored = stored.where(F.col(store.BATCH) != batch_id)
            known = None if stored is None else stored.groupBy("logDate").agg(F.max("opened").alias("opened"))
            sets = dau.openings(logs, 3600 * ttl_hours, known)
            store.write_batch(dau.first_per_set(logs, sets, stored), table_path, batch_id, "logDate")
        finally:
            logs.unpersist()

    return process


def start_expiring(logs: DataFrame, table_path: str, checkpoint: str, ttl_hours: int = 24,
                   trigger: dict | None = None, state_partitions: int | None = None):
    """``logs``: streaming StartUpLog rows with ``arrived``, the epoch ms of their arrival.  A device
    is new again once its day's seen set has died."""
    writer = (logs.writeStream.foreachBatch(expiring_writer(table_path, ttl_hours))
              .option("checkpointLocation", checkpoint))
    return start_query(writer, logs.sparkSession, trigger, state_partitions)


def read(spark: SparkSession, table_path: str, days: list[str] | None = None) -> DataFrame | None:
    """The DAU table (S5): one row per (mid, logDate) by construction; with
    ``days`` only those day folders are listed and read."""
    rows = (store.read_partitions(spark, table_path, "logDate", days) if days
            else store.read_rows(spark, table_path, "logDate"))
    return None if rows is None else rows.drop(store.BATCH)
