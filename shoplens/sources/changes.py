"""Change events and binlog envelopes derived from the driver tables.

The driver tables are snapshots; these functions turn them into the change
feed the capture client would have produced, so the routing and decoding
operators run over data that grows with the tables:
  order_info  INSERT for every order, plus an UPDATE for every finished ('F') order
  order_detail INSERT for every line
  user_info   INSERT for every customer, plus an UPDATE (user_level 'VIP') for
              customers with c_acctbal > 5000
  sku_info    INSERT for every part (a table the router does not forward)
  TRANSACTIONEND entries (not ROWDATA) after every order
All values are text, as the capture client sends them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.sources.tables import birthday, gender, table, users

VIP_BALANCE = 5000.0


def _txt(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _money(name: str) -> Column:
    return _txt(F.col(name).cast("decimal(18,2)"))


def _columns(pairs: list[tuple[str, Column]]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), _txt(v).alias("value")) for n, v in pairs])


def order_columns() -> list[tuple[str, Column]]:
    return [
        ("id", F.col("o_orderkey")),
        ("user_id", F.col("o_custkey")),
        ("order_status", F.col("o_orderstatus")),
        ("total_amount", _money("o_totalprice")),
        ("create_time", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")),
    ]


def line_columns() -> list[tuple[str, Column]]:
    line_id = F.concat_ws("-", *[F.col(c).cast("string") for c in
                                 ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    return [
        ("id", line_id),
        ("order_id", F.col("l_orderkey")),
        ("sku_id", F.col("l_partkey")),
        ("sku_name", F.col("p_name")),
        ("order_price", _money("l_extendedprice")),
        ("sku_num", _money("l_quantity")),
    ]


def user_columns(level: Column | None = None) -> list[tuple[str, Column]]:
    return [
        ("id", F.col("c_custkey")),
        ("login_name", F.col("c_name")),
        ("user_level", F.col("c_mktsegment") if level is None else level),
        ("birthday", birthday()),
        ("gender", gender()),
    ]


def _entry(df: DataFrame, table_name: str, event: str, pairs) -> DataFrame:
    return df.select(
        F.lit(table_name).alias("table"), F.lit("ROWDATA").alias("entryType"),
        F.lit(event).alias("eventType"),
        F.array(F.struct(_columns(pairs).alias("afterColumns"))).alias("rows"),
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    c = table(spark, sf_dir, "customer")
    p = table(spark, sf_dir, "part")
    li = li.join(p.select("p_partkey", "p_name"), li.l_partkey == F.col("p_partkey"), "left")
    parts = [
        _entry(o, "order_info", "INSERT", order_columns()),
        _entry(o.where(F.col("o_orderstatus") == "F"), "order_info", "UPDATE", order_columns()),
        _entry(li, "order_detail", "INSERT", line_columns()),
        _entry(c, "user_info", "INSERT", user_columns()),
        _entry(c.where(F.col("c_acctbal") > VIP_BALANCE), "user_info", "UPDATE",
               user_columns(F.lit("VIP"))),
        _entry(p, "sku_info", "INSERT", [("id", F.col("p_partkey")), ("sku_name", F.col("p_name"))]),
        o.select(F.lit("order_info").alias("table"), F.lit("TRANSACTIONEND").alias("entryType"),
                 F.lit(None).cast("string").alias("eventType"),
                 F.lit(None).cast("array<struct<afterColumns:array<struct<name:string,value:string>>>>")
                 .alias("rows")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User records in arrival order (``offset``): the insert, then any update.
    One scan of customer; no join."""
    u = users(spark, sf_dir, with_balance=True)
    base = u.withColumn("offset", F.col("id").cast("long") * 2)
    upd = (base.where(F.col("c_acctbal") > VIP_BALANCE)
           .withColumn("user_level", F.lit("VIP")).withColumn("offset", F.col("offset") + 1))
    return base.unionByName(upd).drop("c_acctbal")


def binlog_envelopes(spark: SparkSession, sf_dir: str, rows_per_envelope: int = 2) -> DataFrame:
    """Binlog JSON text: consecutive order keys share an envelope of at most
    ``rows_per_envelope`` rows (a bounded group, so no key can grow it)."""
    o = table(spark, sf_dir, "orders")
    row = F.struct(*[_txt(v).alias(n) for n, v in order_columns()])
    grouped = (o.groupBy(F.floor(F.col("o_orderkey") / rows_per_envelope).alias("txn"))
               .agg(F.collect_list(row).alias("data")))
    env = grouped.select(
        "data",
        F.lit("shop").alias("database"), F.lit("order_info").alias("table"),
        F.lit("INSERT").alias("type"), F.col("txn").alias("id"), F.lit(False).alias("isDdl"),
    )
    return env.select(F.to_json(F.struct(*env.columns)).alias("value"))
