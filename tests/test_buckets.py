"""Bucketed tables: joins by bucket, bucket pruning, reopening, hot keys."""

import pytest
from pyspark.sql import functions as F

from shoplens.operators import sales
from shoplens.plans import catalog
from shoplens.sources import buckets, tables

SF = "/root/testdata/sf0.001"
THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "-1")
    yield
    spark.conf.set(THRESHOLD, old)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_joins_and_lookups_of_bucketed_tables_do_not_shuffle(spark, scratch, no_broadcast):
    root = scratch("buckets")
    orders = buckets.write(tables.orders(spark, SF), f"{root}/orders", "id", 8)
    lines = buckets.write(tables.order_lines(spark, SF), f"{root}/lines", "order_id", 8)
    status = sales.order_line_status(orders, lines)
    assert "Exchange" not in plan(status) and "SortMergeJoin" in plan(status)
    assert "Exchange" in plan(catalog.q_order_full_outer(spark, SF))
    assert rows(status) == rows(catalog.q_order_full_outer(spark, SF))

    joined = sales.sale_lines(orders, lines)
    assert "Exchange" not in plan(joined)
    by_user = buckets.write(joined, f"{root}/sale", "user_id", 8)
    users = buckets.write(tables.users(spark, SF), f"{root}/users", "id", 8)
    detail = sales.with_users(by_user, users)
    assert "Exchange" not in plan(detail) and "SortMergeJoin" in plan(detail)
    assert rows(detail) == rows(catalog.q_sale_detail_wide(spark, SF))
    # the newest row of a key: grouped within its bucket as well
    assert "Exchange" not in plan(sales.dedup_by_id(lines.withColumnRenamed("order_id", "k"), "k"))


def test_key_equality_reads_one_bucket(spark, scratch):
    path = f"{scratch('buckets')}/orders"
    orders = buckets.write(tables.orders(spark, SF), path, "id", 8)
    old = spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # so that the plan shows it
    try:
        one = orders.where(F.col("id") == 77)
        assert "SelectedBucketsCount: 1 out of 8" in plan(one)
        assert one.count() == 1
    finally:
        spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", old)


def test_another_session_reads_a_table_from_its_path(spark, scratch, no_broadcast):
    path = f"{scratch('buckets')}/orders"
    written = buckets.write(tables.orders(spark, SF), path, "id", 8)
    expected = rows(written)
    spark.sql(f"DROP TABLE {buckets._name(path)}")  # as a new session's catalog: the files stay
    again = buckets.read(spark, path)
    assert rows(again) == expected
    assert "Exchange" not in plan(again.join(again.select("id").distinct(), "id"))
    assert rows(buckets.read(spark, path, by_bucket=False)) == expected


def test_null_keys_hot_keys_and_empty_tables(spark, scratch, no_broadcast):
    root = scratch("buckets")
    lines = spark.range(3000).select(
        F.col("id").cast("string").alias("id"), F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 3 == 0, 7)
        .otherwise(F.col("id")).alias("order_id"), F.lit("s").alias("sku_id"))
    orders = spark.range(100).select("id", F.lit("F").alias("order_status"))
    expected = rows(sales.order_line_status(orders, lines))
    o = buckets.write(orders, f"{root}/o", "id", 4)
    for by_bucket in (True, False):
        if by_bucket:
            buckets.write(lines, f"{root}/l", "order_id", 4)
        assert rows(sales.order_line_status(o, buckets.read(spark, f"{root}/l", by_bucket))) == expected
    empty = buckets.write(lines.where("false"), f"{root}/e", "order_id", 4)
    assert sales.order_line_status(o, empty).count() == 100
    for by_bucket in (True, False):
        assert sales.order_line_status(o, buckets.read(spark, f"{root}/e", by_bucket)).count() == 100
