"""Driver tables and their mapping onto the retail records.

Mapping (fixed rules of this project):
  start-up log  <- events:   mid = 'mid_' || user_id, uid = user_id, type = event_type
  event log     <- events:   mid = 'mid_' || (user_id div 10), uid = user_id,
                              itemid = props.k, evid: signup -> coupon, click -> clickItem
  order         <- orders:   id = o_orderkey, user_id = o_custkey, total_amount = o_totalprice,
                              order_status = o_orderstatus, create_time = o_orderdate
  purchase order<- events:   purchases as orders (the orders table only has midnight times)
  order line    <- lineitem: id = orderkey-linenumber-partkey-suppkey, sku_id = l_partkey,
                              sku_name = part.p_name, order_price = l_extendedprice, sku_num = l_quantity
  user          <- customer: gender = M for even c_custkey else F,
                              birthday = 1950-01-01 + (c_custkey * 37) % 18000 days,
                              user_level = c_mktsegment, login_name = c_name
Only the columns a plan uses are read: every mapping is a projection, so
Catalyst prunes the Parquet scan to the referenced columns.  Join keys (order,
user ids) stay numeric here; the sale-detail output casts them to text, the
record type the JSON feeds carry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.timefmt import log_date, log_hour, ms_from_ntz

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# fixed values of the mapping
MID_PREFIX = "mid_"
USERS_PER_DEVICE = 10  # so the devices of the event log grow with the data
EVID_RENAME = {"signup": "coupon", "click": "clickItem"}
BIRTHDAY_BASE = "1950-01-01"
BIRTHDAY_STEP = 37
BIRTHDAY_SPAN = 18000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(col: str):
    return F.col(col).cast("string")


def startup_logs(spark: SparkSession, sf_dir: str, zone: str = "UTC") -> DataFrame:
    e = table(spark, sf_dir, "events")
    ts = ms_from_ntz("ts")
    null = F.lit(None).cast("string")
    return e.select(
        F.concat(F.lit(MID_PREFIX), _s("user_id")).alias("mid"),
        _s("user_id").alias("uid"),
        null.alias("appid"), null.alias("area"), null.alias("os"), null.alias("ch"),
        F.col("event_type").alias("type"),
        null.alias("vs"),
        log_date(ts, zone).alias("logDate"),
        log_hour(ts, zone).alias("logHour"),
        ts.alias("ts"),
    )


def evid(col: str = "event_type"):
    out = F.col(col)
    for src, dst in EVID_RENAME.items():
        out = F.when(F.col(col) == src, F.lit(dst)).otherwise(out)
    return out


def event_logs(spark: SparkSession, sf_dir: str, zone: str = "UTC") -> DataFrame:
    e = table(spark, sf_dir, "events")
    ts = ms_from_ntz("ts")
    null = F.lit(None).cast("string")
    return e.select(
        F.concat(F.lit(MID_PREFIX), F.floor(F.col("user_id") / USERS_PER_DEVICE).cast("string")).alias("mid"),
        _s("user_id").alias("uid"),
        null.alias("appid"), null.alias("area"), null.alias("os"),
        F.lit("event").alias("type"),
        evid().alias("evid"),
        null.alias("pgid"), null.alias("npgid"),
        F.get_json_object("props", "$.k").alias("itemid"),
        log_date(ts, zone).alias("logDate"),
        log_hour(ts, zone).alias("logHour"),
        ts.alias("ts"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows (typed OrderInfo subset) from the orders table."""
    o = table(spark, sf_dir, "orders")
    ct = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return o.select(
        F.col("o_orderkey").alias("id"),        # keys stay numeric: cheaper joins and
        F.col("o_custkey").alias("user_id"),    # not-null filters reach the scan
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("total_amount"),
        ct.alias("create_time"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("create_date"),
        F.date_format("o_orderdate", "HH").alias("create_hour"),
    )


def purchase_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase events as orders: they carry real hours and share days with the logs."""
    e = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return e.select(
        _s("event_id").alias("id"),
        _s("user_id").alias("user_id"),
        F.lit("purchase").alias("order_status"),
        F.col("value").alias("total_amount"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("create_time"),
        F.date_format("ts", "yyyy-MM-dd").alias("create_date"),
        F.date_format("ts", "HH").alias("create_hour"),
    )


def _cheapest() -> list[Column]:
    """The smallest (price, quantity) of a group, in numeric buffers: one decimal orders
    both, so the aggregate hashes instead of sorting the raw rows."""
    price, quantity = (F.col(c).cast("decimal(18,2)") for c in ("l_extendedprice", "l_quantity"))
    both = price * F.lit(10**13).cast("decimal(14,0)") + quantity
    return [F.min_by("l_extendedprice", both).alias("l_extendedprice"), F.min_by("l_quantity", both).alias("l_quantity")]


def order_lines(spark: SparkSession, sf_dir: str, names: str = "after") -> DataFrame:
    """Order lines with sku names; one row per line id.

    A repeated line id (l_orderkey, l_linenumber, l_partkey, l_suppkey) keeps
    the row with the smallest (l_extendedprice, l_quantity).  Keys and tie-break
    stay numeric until after the aggregate (text ids are built once per output
    row); the aggregate is partial, so a line id repeated a billion times reaches
    the shuffle as one row per task.

    ``names``: when the part join takes place.  ``after`` the aggregate, so fewer
    rows are joined; ``before`` it, for keyword searches: the name (fixed by
    l_partkey) is then a grouping column, so a filter on it is pushed below the
    aggregate into the part scan and only matching lines are aggregated;
    ``none``: no join, the name is null.
    """
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    # part grows with the data, so no broadcast hint: the planner broadcasts it
    # only when its measured size is under the threshold (AQE re-checks at run time)
    same_part = F.col("l_partkey") == F.col("p_partkey")
    if names == "before":
        lines = li.join(part, same_part, "left").groupBy(*key, "p_name").agg(*_cheapest())
    else:
        lines = li.groupBy(*key).agg(*_cheapest())
        lines = lines.join(part, same_part, "left") if names == "after" else lines.withColumn(
            "p_name", F.lit(None).cast("string"))
    return lines.select(
        F.concat_ws("-", *[_s(c) for c in key]).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("p_name").alias("sku_name"),
        _s("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("order_price"),
        F.lit(None).cast("string").alias("img_url"),
        F.col("l_quantity").cast("decimal(18,2)").cast("string").alias("sku_num"),
    )


def birthday() -> Column:
    day = F.date_add(F.lit(BIRTHDAY_BASE).cast("date"), ((F.col("c_custkey") * BIRTHDAY_STEP) % BIRTHDAY_SPAN).cast("int"))
    return F.date_format(day, "yyyy-MM-dd")


def gender() -> Column:
    return F.when(F.col("c_custkey") % 2 == 0, F.lit("M")).otherwise(F.lit("F"))


def users(spark: SparkSession, sf_dir: str, with_balance: bool = False) -> DataFrame:
    """User dimension from customers; ``with_balance`` also returns c_acctbal."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("login_name"),
        F.col("c_mktsegment").alias("user_level"),
        birthday().alias("birthday"),
        gender().alias("gender"),
        *([F.col("c_acctbal")] if with_balance else []),
    )
