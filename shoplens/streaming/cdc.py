"""Streaming change router (F3 + F4 + D3 + S14): change events in, one flat
JSON object per routed row out, one folder (or topic) per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.operators import cdc
from shoplens.sources import schemas, streams


def start(change_lines: DataFrame, out: str, checkpoint: str, trigger: dict | None = None, compression: str = "none"):
    """``change_lines``: JSON change events (column ``value``).  ``out``: a folder (its files in
    ``compression``), or ``kafka://HOSTS`` to send each row to its table's topic."""
    changes = change_lines.select(F.from_json("value", schemas.CHANGE_EVENT).alias("c")).select("c.*")
    if out.startswith("kafka://"):
        return streams.topic_sink(cdc.route(changes), out[len("kafka://"):], checkpoint, trigger=trigger)
    return streams.routed_file_sink(cdc.route(changes), out, checkpoint, trigger, compression)


def read(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.text(out_path).select("topic", "value")
