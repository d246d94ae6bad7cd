"""Order x order line x user: the sale-detail wide table.

J1  order_line_status   full outer join of orders and lines with a match status
J2  sale_lines          orders x lines (inner: the net result of the late-tolerant join)
J3  with_users          left lookup of the user; a missing user gives age 0, null gender / level
S13 latest_users        newest record per user id
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.text import age_years
from shoplens.sources.schemas import SALE_DETAIL
from shoplens.sources.store import POS


def order_line_status(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Full outer join on order id with status matched / order_only / detail_only.

    Built as lines LEFT JOIN orders (matched / detail_only) plus orders LEFT
    ANTI the distinct line order ids (order_only) instead of one full outer
    sort-merge join: AQE can split a hot order id on the streamed (lines)
    side of a left join but not in a full outer join, and the anti join runs
    against pre-aggregated distinct keys, so no key lands whole in one task.
    Orders are unique per id, so the left join never multiplies lines.
    """
    o = orders.select(F.col("id").alias("order_id"), "order_status")
    d = lines.select(F.col("id").alias("order_detail_id"), "order_id", "sku_id")
    with_order = (d.join(o.withColumn("_has_order", F.lit(True)), "order_id", "left")
                  .select("order_id", "order_detail_id", "order_status", "sku_id",
                          F.when(F.col("_has_order"), F.lit("matched"))
                          .otherwise(F.lit("detail_only")).alias("match")))
    line_keys = d.select("order_id").distinct()
    order_only = (o.join(line_keys, "order_id", "left_anti")
                  .select("order_id", F.lit(None).cast("string").alias("order_detail_id"),
                          "order_status", F.lit(None).cast("string").alias("sku_id"),
                          F.lit("order_only").alias("match")))
    return with_order.unionByName(order_only).withColumn("order_id", F.col("order_id").cast("string"))


def sale_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Merge of order and line into the sale-detail columns without the user (P5)."""
    o = orders.select(
        F.col("id").alias("order_id"), "order_status", "create_time",
        F.col("create_date").alias("dt"), "user_id",
    )
    d = lines.select(
        F.col("id").alias("order_detail_id"), "order_id", "sku_id", "sku_name",
        F.coalesce(F.col("order_price").try_cast("double"), F.lit(0.0)).alias("sku_price"),
    )
    return o.join(d, "order_id", "inner")


def with_users(lines: DataFrame, users: DataFrame, as_of: Column | str | None = None,
               per: str | None = None) -> DataFrame:
    """Left lookup of the user dimension (J3) and age in whole years.

    ``as_of`` is the date ages are taken at; None uses the order day (the
    original computed age at processing time, i.e. close to the order time).
    The user side is unique per id, so the join never multiplies rows.  A hot
    user id on the left is split by AQE's skew-join handling.

    ``per``: a column by which ``lines`` are partitioned already and whose values have a user or
    few (the order id).  Users are then looked up for its values and joined by it, so
    the lines themselves are not shuffled.
    """
    u = users.select(
        F.col("id").alias("user_id"),
        F.col("gender").alias("user_gender"),
        F.col("user_level"),
        F.try_to_date("birthday").alias("_birthday"),  # a malformed birthday gives age 0, not a failed batch
    )
    if per is None:
        j = lines.join(u, "user_id", "left")
    else:
        asked = lines.select(per, "user_id").groupBy(per, "user_id").agg(F.lit(1).alias("_n")).drop("_n")
        found = asked.join(u, "user_id").groupBy(per).agg(F.collect_list(F.struct(*u.columns)).alias("_users"))
        own = F.filter("_users", lambda x: x["user_id"] == F.col("user_id"))
        j = (lines.join(found, per, "left").withColumn("_u", F.explode_outer(own))
             .select(*lines.columns, *[F.col(f"_u.{c}").alias(c) for c in u.columns if c != "user_id"]))
    ref = F.try_to_date("dt") if as_of is None else (F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of)
    age = F.coalesce(age_years(F.col("_birthday"), ref), F.lit(0)).cast("int")
    out = j.withColumn("user_age", age)
    kept = [c for c in (POS,) if c in lines.columns]  # a stream's pairs keep their times
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SALE_DETAIL.fields], *kept)


def sale_detail(orders: DataFrame, lines: DataFrame, users: DataFrame,
                as_of: Column | str | None = None) -> DataFrame:
    return with_users(sale_lines(orders, lines), users, as_of)


def dedup_by_id(df: DataFrame, key: str | list[str] = "order_detail_id", order: str | None = None) -> DataFrame:
    """Keyed-sink semantics: one row per id, the newest by ``order`` (ties: the greatest
    row); without ``order`` the rows are equal but for chance and the smallest stays."""
    keys = [key] if isinstance(key, str) else key
    cols = [c for c in df.columns if c not in (*keys, order)]
    if order:
        pick = F.max(F.struct(F.col(order), *cols))
    else:
        pick = F.min(F.struct(*cols))
    return df.groupBy(*keys).agg(pick.alias("r")).select(*keys, "r.*").select(*df.columns)


def latest_users(user_changes: DataFrame, order: str = "offset") -> DataFrame:
    """Newest record per user id (S13): last write wins, partial aggregation."""
    cols = [c for c in user_changes.columns if c not in ("id", order)]
    newest = F.max_by(F.struct(*cols), F.col(order)).alias("u")
    return user_changes.groupBy("id").agg(newest).select("id", "u.*")
