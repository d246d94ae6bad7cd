"""Stream sources and sinks.

* JSON-line text files (S3): ``spark.read.text`` / ``readStream.text``; the
  value column is then decoded with ``shoplens.functions.decode``.
* Topics (S1, S2, S14): Spark's Kafka connector.  Its jar is not part of the
  local test image, so these are thin functions and the tests use file streams.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where a record stands in its source (struct at, part, block): file time, file and
#: block, or offset and partition.  It decides which write of a key is the last one.
POS = "pos"


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of line-JSON text as a single ``value`` column."""
    return spark.read.text(path)


def json_lines_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                      glob: str | None = None) -> DataFrame:
    """Streaming read of line-JSON text files (``value``, ``pos``); ``max_files_per_trigger``
    bounds a batch (T5)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    meta = F.col("_metadata")
    return reader.load(path).select("value", F.struct(
        F.unix_millis(meta["file_modification_time"]).alias("at"), meta["file_path"].alias("part"),
        meta["file_block_start"].alias("block")).alias(POS))


def topic_options(servers: str, topic: str, offsets: dict[int, int] | None = None,
                  max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Options of the topic source (S1, S2): given partitions start at their offset."""
    start = json.dumps({topic: {str(p): int(o) for p, o in offsets.items()}}) if offsets else "latest"
    out = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if max_offsets_per_trigger:
        out["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    return out


def topic_stream(spark: SparkSession, servers: str, topic: str,
                 offsets: dict[int, int] | None = None,
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Topic source (S1): from the latest offset, or from given per-partition
    offsets (S2) on the very first start; afterwards the checkpoint decides."""
    raw = (spark.readStream.format("kafka")
           .options(**topic_options(servers, topic, offsets, max_offsets_per_trigger)).load())
    # records of one key share a partition, in which the offset is their order
    return raw.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                      F.struct(F.col("offset").alias("at"), F.col("partition").cast("string").alias("part"),
                               F.lit(0).cast("long").alias("block")).alias(POS), "timestamp")


def topic_sink(df: DataFrame, servers: str, checkpoint: str, topic: str | None = None, trigger: dict | None = None):
    """Topic sink (S14): rows carry ``value`` and, without ``topic``, a ``topic`` column."""
    writer = (df.writeStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("checkpointLocation", checkpoint))
    if topic:
        writer = writer.option("topic", topic)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def routed_file_sink(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                     compression: str = "none"):
    """File analogue of the topic sink: rows (topic, value) as text lines, one
    folder per topic (``topic=<name>``), readable again by ``json_lines_stream``."""
    writer = (df.writeStream.format("text").partitionBy("topic").option("compression", compression)
              .option("path", path).option("checkpointLocation", checkpoint))
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()
