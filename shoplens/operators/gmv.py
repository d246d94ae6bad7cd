"""Gross merchandise value per day and per hour (A3, A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gmv_total(orders: DataFrame) -> DataFrame:
    """sum(total_amount) per create_date (A3); a day without orders has no row."""
    return orders.groupBy("create_date").agg(F.sum("total_amount").alias("order_amount"))


def gmv_hours(orders: DataFrame) -> DataFrame:
    """cast(sum(total_amount) as double) per (create_date, create_hour) (A4)."""
    return (orders.groupBy("create_date", "create_hour")
            .agg(F.sum("total_amount").cast("double").alias("order_amount")))
