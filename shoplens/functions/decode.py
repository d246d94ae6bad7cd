"""Decoding of JSON records into typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.timefmt import create_date, create_hour, log_date, log_hour
from shoplens.sources import schemas


def _records(lines: DataFrame, column: str, schema) -> DataFrame:
    """The JSON fields of each record, and its position in the source if it has one."""
    rec = F.from_json(F.col(column), schema).alias("r")
    pos = [c for c in ("pos",) if c in lines.columns]
    return lines.select(rec, *pos).select("r.*", *pos)


def text_value(df: DataFrame, column: str = "value") -> DataFrame:
    """Value-only projection of a topic / text record."""
    return df.select(F.col(column).cast("string").alias("value"))


def decode_startup(lines: DataFrame, zone: str = "UTC", column: str = "value") -> DataFrame:
    """JSON start-up log to StartUpLog rows with logDate / logHour (D1 + P1)."""
    rec = F.from_json(F.col(column), schemas.STARTUP_LOG).alias("r")
    return with_log_time(lines.select(rec).select("r.*"), zone).select(*schemas.STARTUP_COLUMNS)


def decode_event(lines: DataFrame, zone: str = "UTC", column: str = "value") -> DataFrame:
    """JSON event log to EventLog rows (D1 + P1); numeric ids are kept as text."""
    rec = F.from_json(F.col(column), schemas.EVENT_LOG).alias("r")
    return with_log_time(lines.select(rec).select("r.*"), zone).select(*schemas.EVENT_COLUMNS)


def with_log_time(df: DataFrame, zone: str = "UTC", ts: str = "ts") -> DataFrame:
    return df.withColumn("logDate", log_date(ts, zone)).withColumn("logHour", log_hour(ts, zone))


def typed_order(rows: DataFrame) -> DataFrame:
    """Order rows with text values to OrderInfo: total_amount double, create_date/hour.

    Empty strings are null; a bad number becomes null instead of failing the
    batch; a missing create_time keeps the row with null date / hour.
    """
    text_cols = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "string"]
    out = rows.select(*[F.nullif(F.col(c), F.lit("")).alias(c) if c in text_cols else F.col(c)
                        for c in rows.columns])
    return (out.withColumn("total_amount", F.col("total_amount").try_cast("double"))
            .withColumn("create_date", create_date("create_time"))
            .withColumn("create_hour", create_hour("create_time")))


def decode_order(lines: DataFrame, column: str = "value") -> DataFrame:
    """Flat order JSON (from the change router) to OrderInfo rows (D1 + P2)."""
    return typed_order(_records(lines, column, schemas.ORDER_INFO_RAW))


def decode_order_detail(lines: DataFrame, column: str = "value") -> DataFrame:
    return _records(lines, column, schemas.ORDER_DETAIL)


def decode_user(lines: DataFrame, column: str = "value") -> DataFrame:
    return _records(lines, column, schemas.USER_INFO)


def decode_binlog(lines: DataFrame, column: str = "value", first_only: bool = False) -> DataFrame:
    """Binlog envelope to order rows.

    Every element of ``data`` becomes a row (``posexplode``); ``first_only``
    keeps element 0 only, as the original job did.  Fields are read by name.
    """
    pos = [c for c in ("pos",) if c in lines.columns]
    env = lines.select(F.from_json(F.col(column), schemas.BINLOG_ENVELOPE).alias("e"), *pos)
    rows = env.select(
        *pos,
        F.col("e.table").alias("src_table"), F.col("e.type").alias("src_type"),
        F.col("e.isDdl").alias("src_is_ddl"), F.col("e.id").alias("src_id"),
        F.posexplode("e.data").alias("src_pos", "r"),
    )
    if first_only:
        rows = rows.where(F.col("src_pos") == 0)
    meta = ["src_table", "src_type", "src_is_ddl", "src_id", "src_pos", *pos]
    return typed_order(rows.select(*meta, "r.*"))


def flatten_columns(columns: Column) -> Column:
    """After-image (name, value) pairs to one flat JSON object (D3).

    ``columns.name`` / ``columns.value`` pull the two fields out as arrays
    without a lambda, so the map is built by generated code."""
    return F.to_json(F.map_from_arrays(columns.getField("name"), columns.getField("value")))


def to_json_row(df: DataFrame, alias: str = "value") -> DataFrame:
    """Whole row to JSON text."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(alias))


def alert_doc_id(mid: Column | str, ts_ms: Column | str) -> Column:
    """Alert document id: mid followed by the epoch minute, no separator."""
    m = F.col(mid) if isinstance(mid, str) else mid
    t = F.col(ts_ms) if isinstance(ts_ms, str) else ts_ms
    return F.concat(m, F.floor(t / F.lit(60000)).cast("long").cast("string"))
