"""Keyed tables on Parquet, written per micro-batch.

Layout: ``<path>/<partition>=<value>/batch=<id>/part-*.parquet``.

* A batch writes only its own ``batch=<id>`` folders, with dynamic partition
  overwrite, so a replayed batch (after a lost executor or a restart from the
  checkpoint) replaces exactly what it wrote before: the write is idempotent.
* Nothing is ever overwritten while it is being read.
* Readers resolve keys on read: newest row per key by (batch, position in the
  source, order column), so of two writes of a key in one batch the later one wins.
  ``compact`` writes a resolved copy of the whole table to another path;
  ``merge_batch`` upserts instead of appending: it rewrites the folders that a
  micro-batch touches, and only those.
"""

from __future__ import annotations

import gzip

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "batch"
POS = "pos"


def positioned(batch: DataFrame) -> DataFrame:
    """``batch`` with its rows' order of arrival: the position in the source (if the
    rows carry one) and the row's place in the part of it that a task reads.  Call it
    on a micro-batch before anything that shuffles."""
    source = [F.col(POS)] if POS in batch.columns else []
    return batch.withColumn(POS, F.struct(*source, F.monotonically_increasing_id().alias("row")))


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def write_batch(df: DataFrame, path: str, batch_id: int, partition: str | None) -> None:
    """Write one micro-batch into its own batch folders (idempotent per batch id)."""
    out = df.withColumn(BATCH, F.lit(int(batch_id)).cast("long"))
    cols = [partition, BATCH] if partition else [BATCH]
    if partition:  # few files per folder: its rows meet in as many tasks as AQE finds them worth
        out = out.hint("rebalance", partition)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy(*cols).parquet(path))


def read_rows(spark: SparkSession, path: str, partition: str | None = None) -> DataFrame | None:
    """All stored rows.  ``partition`` (the folder column the writer used) is
    returned as text, as written, whatever type discovery infers from the
    folder names; ``batch`` is a long."""
    if not exists(spark, path):
        return None
    try:
        rows = spark.read.parquet(path)
    except AnalysisException as exc:  # folder holds no data file yet (only empty batches)
        if "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return None
        raise
    if partition:
        rows = rows.withColumn(partition, F.col(partition).cast("string"))
    return rows.withColumn(BATCH, F.col(BATCH).cast("long"))


def read_partitions(spark: SparkSession, path: str, partition: str,
                    values: list[str]) -> DataFrame | None:
    """Rows of only the given partition folders: the driver lists those
    folders, not the whole table (a streaming job reading its own table every
    micro-batch must not list months of folders each time)."""
    folders = [f"{path}/{partition}={v}" for v in values if exists(spark, f"{path}/{partition}={v}")]
    if not folders:
        return None
    try:
        rows = spark.read.option("basePath", path).parquet(*folders)
    except AnalysisException as exc:
        if "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return None
        raise
    return (rows.withColumn(partition, F.col(partition).cast("string"))
            .withColumn(BATCH, F.col(BATCH).cast("long")))


def latest(rows: DataFrame, key: list[str], order: list[str] | None = None) -> DataFrame:
    """Newest row per key: highest (batch, position, *order).  A partial aggregate, skew-safe."""
    order = [BATCH] + [c for c in (POS,) if c in rows.columns] + list(order or [])
    rest = [c for c in rows.columns if c not in key]
    pick = F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")
    return rows.groupBy(*key).agg(pick).select(*key, "_r.*").drop(POS)


#: Keys written more than once of which ``latest_rare`` sends every task a list.
RARE_KEYS = 100_000


def latest_rare(rows: DataFrame, key: list[str], order: list[str] | None = None) -> DataFrame:
    """``latest`` of stored rows, few of whose keys stand in several rows: only a hash per row is
    shuffled to find them, and only their rows are resolved.  With more of them than
    ``RARE_KEYS`` it is ``latest``."""
    spark = rows.sparkSession
    hashed = rows.withColumn("_h", F.xxhash64(*key))
    several = hashed.groupBy("_h").count().where("count > 1").select("_h").limit(RARE_KEYS + 1)
    found = [r[0] for r in several.collect()]
    if len(found) > RARE_KEYS:
        return latest(rows, key, order)
    if not found:
        return rows.select(*key, *[c for c in rows.columns if c not in key]).drop(POS)
    listed = F.broadcast(spark.createDataFrame([(h,) for h in found], "_h long"))
    resolved = latest(hashed.join(listed, "_h", "left_semi").drop("_h"), key, order)
    return hashed.join(listed, "_h", "left_anti").drop("_h").select(*rows.columns).drop(POS).unionByName(resolved)


def read_latest(spark: SparkSession, path: str, key: list[str],
                order: list[str] | None = None, partition: str | None = None) -> DataFrame | None:
    rows = read_rows(spark, path, partition)
    return None if rows is None else latest(rows, key, order).drop(BATCH)


def merge_batch(df: DataFrame, path: str, batch_id: int, partition: str, key: list[str],
                order: list[str] | None = None) -> None:
    """Upsert one micro-batch: every folder of ``partition`` that it touches is rewritten into
    ``batch=<id>`` with the newest row of each of its keys; no other folder is read or
    listed.  A key's rows must always fall in one folder.

    Of a folder, the batch before (a replay merges with it again, and readers
    that have begun may still read it) and this one stay; those before them are removed.
    So a folder holds at most two copies of its keys, however many batches touch it.  An
    empty batch writes nothing.
    """
    spark = df.sparkSession
    touched = [r[0] for r in df.select(partition).distinct().collect() if r[0] is not None]  # folders, not rows
    old = read_partitions(spark, path, partition, touched)
    new = df.withColumn(BATCH, F.lit(int(batch_id)).cast("long"))
    if old is not None:
        old = old.where(F.col(BATCH) < batch_id)
        new = new.unionByName(old, allowMissingColumns=True)  # no position there: an earlier batch, settled
    write_batch(latest(new, key, order), path, batch_id, partition)
    jvm = spark.sparkContext._jvm
    for value in touched:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{partition}={value}")
        fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found = [s.getPath() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        before = sorted((int(p.getName().split("=")[1]), p) for p in found if p.getName().startswith(f"{BATCH}="))
        for _, stale in [b for b in before if b[0] < batch_id][:-1]:
            fs.delete(stale, True)


def fill_up(spark: SparkSession, path: str, files: int) -> None:
    """Add empty ``.txt.gz`` files to the folder ``path`` until it has ``files`` part files."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = [s for s in fs.listStatus(top) if s.getPath().getName().startswith("part-")] if fs.exists(top) else []
    for k in range(len(there), files):
        out = fs.create(jvm.org.apache.hadoop.fs.Path(f"{path}/part-none-{k}.txt.gz"))
        out.write(gzip.compress(b""))
        out.close()


def folder_values(spark: SparkSession, path: str, partition: str) -> list[str]:
    """Values of the folder column, by one listing of the table's top folder."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(top)] if fs.exists(top) else []
    return [n.split("=", 1)[1] for n in names if n.startswith(f"{partition}=")]


def compact(spark: SparkSession, path: str, out_path: str, key: list[str], partition: str | None = None,
            order: list[str] | None = None) -> bool:
    """Resolve every key once and write the result to ``out_path`` (never to
    ``path``).  The copy keeps the ``batch`` column, so the same readers work
    on it; pointing readers at it is left to the operator."""
    rows = read_rows(spark, path, partition)
    if rows is None:
        return False
    writer = latest(rows, key, order).write.mode("overwrite")  # positions are settled by now
    if partition:
        writer = writer.partitionBy(partition)
    writer.parquet(out_path)
    return True
