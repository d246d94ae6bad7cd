"""Shared pieces of the llm operators: table access, lineage cuts, Arrow helpers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.session import checkpoint_root, discard, ship_by_value

#: Rows of one Arrow batch that a task holds at a time.  It bounds memory only:
#: every operator gives the same rows for any batch size.
BATCH_ROWS = 1000
#: Fold that classifiers never learn from: crc32(doc_id as text) mod 5 is 0.
HELD_OUT_FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


#: Shuffle files of a query are deleted as soon as it ends, not when the driver next collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, name: str, *replaced: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later jobs start from
    that table, so a lost executor never makes them recompute what came before.
    Tables in ``replaced`` (cuts that no later job reads) are deleted once it is written."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    drop_cuts(*replaced)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def drop_cuts(*tables: DataFrame) -> None:
    """Delete tables of ``cut`` that no later job reads."""
    for t in tables:
        discard(t.sparkSession, t.cut_path)


def slots(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fold that is only scored; a null id is never learned from."""
    fold = F.crc32(F.col(doc_id).cast("string").cast("binary")) % HELD_OUT_FOLDS
    return F.coalesce(fold == 0, F.lit(True))


def by_batch(df: DataFrame, columns: list[str], schema: str,
             fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> DataFrame:
    """``fn`` over Arrow batches of the named columns, without a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                out = fn(whole.slice(at, BATCH_ROWS))
                if out is not None and out.num_rows:
                    yield out

    return df.select(*columns).mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    return column.cast(pa.large_binary()).to_pylist()


ship_by_value(__name__)
