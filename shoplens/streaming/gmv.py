"""Streaming order table (S9): decoded orders written per batch into folders of
their create day (or month, for replays of long histories); read back newest
per order id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.decode import decode_binlog, decode_order
from shoplens.sources import store
from shoplens.streaming.common import start as start_query

PART = "part"


def batch_writer(table_path: str, grain: str = "day", merge: bool = False):
    """``grain``: ``day`` folders for live traffic (a batch touches a day or
    two), ``month`` for replays, where one batch spans years of days.

    ``merge`` rewrites the touched folders with each order's newest row; without it
    batches are appended and resolved by readers.  Either way ``read`` gives the same rows."""
    width = 10 if grain == "day" else 7

    def process(batch: DataFrame, batch_id: int) -> None:
        rows = store.positioned(batch).withColumn(PART, F.substring("create_date", 1, width))
        if not merge:
            store.write_batch(rows, table_path, batch_id, PART)
            return
        rows = rows.persist()  # read for its folders, then for its rows
        try:
            store.merge_batch(rows, table_path, batch_id, PART, ["id"])
        finally:
            rows.unpersist()

    return process


def start(lines: DataFrame, table_path: str, checkpoint: str, envelope: bool = False,
          trigger: dict | None = None, state_partitions: int | None = None, grain: str = "day",
          merge: bool = False):
    """Flat order JSON (from the router) or, with ``envelope``, binlog envelopes."""
    orders = decode_binlog(lines) if envelope else decode_order(lines)
    writer = (orders.writeStream.foreachBatch(batch_writer(table_path, grain, merge))
              .option("checkpointLocation", checkpoint))
    return start_query(writer, lines.sparkSession, trigger, state_partitions)


def read(spark: SparkSession, table_path: str, days: list[str] | None = None) -> DataFrame | None:
    """Newest row per order id; with ``days`` only the folders holding those
    days (day or month grain) are listed and read (an order keeps its
    create_date, so all its versions share a folder)."""
    if days:
        values = sorted({d[:10] for d in days} | {d[:7] for d in days})
        rows = store.read_partitions(spark, table_path, PART, values)
        rows = None if rows is None else rows.where(F.col("create_date").isin(days))
    else:
        rows = store.read_rows(spark, table_path, PART)
    if rows is None:
        return None
    return store.latest(rows.drop(PART), ["id"]).drop(store.BATCH)
