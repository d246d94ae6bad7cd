"""User-level queries (Q1-Q4) returning DataFrames.

Single-day forms take a ``date``: the day filter is a plain predicate, so it
reaches the Parquet scan (and prunes ``logDate=`` / ``create_date=``
directories of the stored tables).  ``*_all_days`` forms answer for every day
in one plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.operators import dau as dau_ops
from shoplens.operators import gmv as gmv_ops
from shoplens.operators import search

# fixed values: the three rows of the totals answer (id, name)
TOTAL_ROWS = [
    ("dau", "新增日活"),
    ("new_mid", "新增设备"),
    ("order_amount", "新增交易额"),
]
NEW_MID_PLACEHOLDER = 233.0


# Q4: the four base queries -------------------------------------------------

def dau_total(dau_rows: DataFrame, date: str) -> DataFrame:
    """count(*) of the day's first-seen rows (A1); 0 when the day has none."""
    return dau_rows.where(F.col("logDate") == date).agg(F.count(F.lit(1)).alias("dau"))


def dau_hours(dau_rows: DataFrame, date: str) -> DataFrame:
    return dau_ops.dau_hours(dau_rows.where(F.col("logDate") == date)).drop("logDate")


def gmv_total(order_rows: DataFrame, date: str) -> DataFrame:
    """sum(total_amount) of the day; null when the day has no order (A3)."""
    return order_rows.where(F.col("create_date") == date).agg(F.sum("total_amount").alias("order_amount"))


def gmv_hours(order_rows: DataFrame, date: str) -> DataFrame:
    return gmv_ops.gmv_hours(order_rows.where(F.col("create_date") == date)).drop("create_date")


# Q1 -------------------------------------------------------------------------

def realtime_total(spark: SparkSession, dau_rows: DataFrame, order_rows: DataFrame,
                   date: str) -> DataFrame:
    """Three rows (id, name, value): dau, new_mid placeholder, order amount (null -> 0)."""
    d = dau_total(dau_rows, date).select(F.col("dau").cast("double").alias("v"))
    g = gmv_total(order_rows, date).select(F.coalesce("order_amount", F.lit(0.0)).alias("v"))
    (id_dau, name_dau), (id_mid, name_mid), (id_amt, name_amt) = TOTAL_ROWS
    return (d.select(F.lit(id_dau).alias("id"), F.lit(name_dau).alias("name"), F.col("v").alias("value"))
            .unionByName(spark.range(1).select(F.lit(id_mid).alias("id"), F.lit(name_mid).alias("name"),
                                               F.lit(NEW_MID_PLACEHOLDER).alias("value")))
            .unionByName(g.select(F.lit(id_amt).alias("id"), F.lit(name_amt).alias("name"),
                                  F.col("v").alias("value"))))


def realtime_total_all_days(dau_rows: DataFrame, order_rows: DataFrame) -> DataFrame:
    """Q1 for every day that has start-ups or orders: (date, id, name, value)."""
    d = dau_ops.dau_total(dau_rows).withColumnRenamed("logDate", "date")
    g = gmv_ops.gmv_total(order_rows).withColumnRenamed("create_date", "date")
    days = d.join(g, "date", "full_outer")
    (id_dau, name_dau), (id_mid, name_mid), (id_amt, name_amt) = TOTAL_ROWS
    entries = F.array(
        F.struct(F.lit(id_dau).alias("id"), F.lit(name_dau).alias("name"),
                 F.coalesce(F.col("dau").cast("double"), F.lit(0.0)).alias("value")),
        F.struct(F.lit(id_mid).alias("id"), F.lit(name_mid).alias("name"),
                 F.lit(NEW_MID_PLACEHOLDER).alias("value")),
        F.struct(F.lit(id_amt).alias("id"), F.lit(name_amt).alias("name"),
                 F.coalesce(F.col("order_amount"), F.lit(0.0)).alias("value")),
    )
    return days.select("date", F.inline(entries))


# Q2 -------------------------------------------------------------------------

def _hourly(kind: str, dau_rows: DataFrame, order_rows: DataFrame) -> DataFrame:
    if kind == "dau":
        return (dau_ops.dau_hours(dau_rows)
                .select(F.col("logDate").alias("date"), F.col("logHour").alias("hour"),
                        F.col("dau").cast("double").alias("value")))
    if kind == "order_amount":
        return (gmv_ops.gmv_hours(order_rows)
                .select(F.col("create_date").alias("date"), F.col("create_hour").alias("hour"),
                        F.col("order_amount").alias("value")))
    raise ValueError(f"unknown id {kind!r}")


def realtime_hours(kind: str, dau_rows: DataFrame, order_rows: DataFrame, date: str) -> DataFrame:
    """hour -> value for ``date`` (today) and the day before (yesterday).

    ``dau`` returns start-up counts by hour, ``order_amount`` order value by
    hour; any other id gives no rows.
    """
    if kind not in ("dau", "order_amount"):
        return dau_rows.sparkSession.createDataFrame([], "day string, hour string, value double")
    yesterday = F.date_format(F.date_sub(F.to_date(F.lit(date)), 1), "yyyy-MM-dd")
    h = _hourly(kind, dau_rows, order_rows)
    h = h.where((F.col("date") == F.lit(date)) | (F.col("date") == yesterday))
    return h.select(F.when(F.col("date") == F.lit(date), F.lit("today")).otherwise(F.lit("yesterday"))
                    .alias("day"), "hour", "value")


def realtime_hours_all_days(kind: str, dau_rows: DataFrame, order_rows: DataFrame) -> DataFrame:
    """Q2 for every day: (date, hour, today, yesterday).

    Each hourly value plays two roles - today's value of its own day and
    yesterday's value of the next day - so one union and one aggregation
    replace a self join (the hourly table is computed once).
    """
    h = _hourly(kind, dau_rows, order_rows)
    roles = F.array(
        F.struct(F.col("date").alias("date"), F.col("value").alias("today"),
                 F.lit(None).cast("double").alias("yesterday")),
        F.struct(F.date_format(F.date_add(F.try_to_date("date"), 1), "yyyy-MM-dd").alias("date"),
                 F.lit(None).cast("double").alias("today"), F.col("value").alias("yesterday")),
    )
    both = h.select("hour", F.inline(roles))
    return both.groupBy("date", "hour").agg(F.max("today").alias("today"), F.max("yesterday").alias("yesterday"))


# Q3 -------------------------------------------------------------------------

def sale_detail(sale_rows: DataFrame, date: str, start: int, size: int, keyword: str,
                exact: bool = True) -> dict[str, DataFrame]:
    """Search answer for one day: ``total``, ``stat`` (share charts) and ``detail`` (page).

    ``start`` is a row offset; the page is ordered by order_detail_id.  With
    ``exact=False`` the age shares count only the top ``size`` age facets.
    """
    spark = sale_rows.sparkSession
    rows = search.keyword_rows(sale_rows, keyword, date)
    day = spark.range(1).select(F.lit(date).alias("dt"))
    answer = search.shares(rows)
    if not exact:
        ages = search.age_shares(rows, exact=False, top_n=size)
        answer = answer.drop("under_20", "from_20_to_30", "over_30").join(ages.drop("total"), "dt")
    # a day without matches still answers: shares 0 / 100 / 0 and 0 / 0
    empty = {"total": 0, "under_20": 0.0, "from_20_to_30": 100.0, "over_30": 0.0, "male": 0.0, "female": 0.0}
    answer = day.join(answer, "dt", "left").select("dt", *[F.coalesce(c, F.lit(v)).alias(c) for c, v in empty.items()])
    total = answer.select("dt", F.col("total").cast("long").alias("total"))
    detail = search.page(rows, start, size).orderBy("row_no")
    return {"total": total, "stat": search.stats(answer), "detail": detail}


def search_answer(sale_rows: DataFrame, date: str, start: int, size: int, keyword: str, exact: bool = True) -> DataFrame:
    """The same answer as one row, computed together: dt, total, stat (both charts: title and
    options) and detail (the page's rows).  A day without matches answers with none."""
    rows = search.keyword_rows(sale_rows, keyword, date)
    found = search.answer(rows, start, size, exact=exact)
    empty = {"total": 0, "under_20": 0.0, "from_20_to_30": 100.0, "over_30": 0.0, "male": 0.0, "female": 0.0}
    day = sale_rows.sparkSession.range(1).select(F.lit(date).alias("dt"))
    detail = found.schema["detail"].dataType.simpleString()
    whole = day.join(found, "dt", "left").select(
        "dt", *[F.coalesce(c, F.lit(v)).alias(c) for c, v in empty.items()],
        F.coalesce("detail", F.expr(f"cast(array() as {detail})")).alias("detail"))
    charts = search.stats(whole, by=["dt", "total", "detail"])
    return (charts.groupBy("dt").agg(F.first("total").cast("long").alias("total"),
                                     F.reverse(F.array_sort(F.collect_list(F.struct("title", "options")))).alias("stat"),
                                     F.first("detail").alias("detail")))
