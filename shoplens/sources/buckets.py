"""Bucketed Parquet tables (S6, S9, S13): joins and groupings on the key without a shuffle.

``write`` lays a table out in a fixed number of buckets by a hash of its key, sorted by
it within a file.  Two tables with the same number of buckets of the same key type are
joined bucket by bucket: neither side is shuffled.  An equality on the key reads one bucket.

The schema, with the number of buckets at its key column, is kept beside the rows (``_schema``, a
Parquet file without rows), so a later session reads a table, also an empty one, from
its path alone.

A bucket is read by one task, whatever its size.  Where a key holds a large part of
all rows, ``read(..., by_bucket=False)`` gives the same rows as plain files, whose joins
shuffle and are split by AQE where they are skewed.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

BUCKETS = "buckets"
SCHEMA = "_schema"


def _name(path: str) -> str:
    return f"bucketed_{hashlib.sha256(path.encode()).hexdigest()[:16]}"


def write(rows: DataFrame, path: str, key: str, n: int | None = None) -> DataFrame:
    """Write ``rows`` to the new folder ``path`` in ``n`` buckets of ``key`` (default: the session's
    shuffle partitions, so that a join of two such tables runs in as many tasks as a
    shuffled one) and return the table.

    The rows meet in tasks by bucket first, so that a bucket is a file or a few, not one from
    every task; AQE splits a task that a hot key makes too large.
    """
    spark = rows.sparkSession
    n = n or int(spark.conf.get("spark.sql.shuffle.partitions"))
    marked = rows.withMetadata(key, {BUCKETS: n}).hint("rebalance", n, key)
    (marked.write.format("parquet").mode("errorifexists").option("path", path)
     .bucketBy(n, key).sortBy(key).saveAsTable(_name(path)))
    spark.createDataFrame([], marked.schema).coalesce(1).write.parquet(f"{path}/{SCHEMA}")
    return spark.table(_name(path))


def read(spark: SparkSession, path: str, by_bucket: bool = True) -> DataFrame:
    """The table that ``write`` left at ``path``, in this or another session."""
    fields = spark.read.parquet(f"{path}/{SCHEMA}").schema
    if not by_bucket:
        return spark.read.schema(fields).parquet(path)
    name = _name(path)
    if not spark.catalog.tableExists(name):
        key, n = next((f.name, f.metadata[BUCKETS]) for f in fields.fields if BUCKETS in f.metadata)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
                  f"INTO {n} BUCKETS LOCATION '{path}'")
    return spark.table(name)
