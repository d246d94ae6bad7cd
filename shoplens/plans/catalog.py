"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the
whole driver tables.  Parameters are fixed here once; the DuckDB twins of
these plans live in ``shoplens.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.decode import to_json_row
from shoplens.functions.timefmt import ms_from_ntz
from shoplens.operators import alerts, cdc, dau, gmv, sales, search
from shoplens.plans import api
from shoplens.session import scratch_dir
from shoplens.sources import buckets, changes, store, tables
from shoplens.streaming import alerts as stored
from shoplens.streaming import words

# query parameters (fixed)
ZONE = "UTC"
SPLIT_HOUR = "12"               # dau_anti_join: morning rows form the seen set
NIGHT_END = "01"                # dau_anti_join_mid: rows of the first hour form the seen set
ALERT_LENGTH = "8 hours"        # shorter windows give few alerts on the small tables
ALERT_SLIDE = "1 hour"
SLIDING_LENGTH = "1 day"        # alert_sliding and what follows from it: 24 windows an event
MIN_UIDS = 3
LATE_MS = 30 * 3_600_000        # dau_expiring: lateness of the late rows
SET_SECONDS = 86_400            # dau_expiring: life of a day's seen set
WORD_WINDOW = "3 hours"
KEYWORD = "red"
KEYWORD_TWO_TOKENS = "red bolt"
PAGE_OFFSET = 2
PAGE_SIZE = 5
GENDER_TOP = 2
DAY = "2024-01-15"              # realtime_total_day
SALE_DAY = "1996-03-13"         # sale_detail_day
ALERT_DAYS = ["2024-01-10", "2024-01-11"]  # alert_days: the folders that are read
AGES_AS_OF = "2000-01-01"       # sale_detail_user_left: ages at this day, not at the order day


def _r2(col: str):
    return F.round(F.col(col), 2).alias(col)


# ---- DAU -------------------------------------------------------------------

def q_dau_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    return dau.first_seen(tables.startup_logs(spark, sf, ZONE))


def q_dau_total(spark: SparkSession, sf: str) -> DataFrame:
    return dau.dau_total(q_dau_first_seen(spark, sf))


def q_dau_hours(spark: SparkSession, sf: str) -> DataFrame:
    return dau.dau_hours(q_dau_first_seen(spark, sf))


def q_dau_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    logs = tables.startup_logs(spark, sf, ZONE)
    morning = logs.where(F.col("logHour") < SPLIT_HOUR)
    afternoon = logs.where(F.col("logHour") >= SPLIT_HOUR)
    return dau.first_seen(dau.new_against(afternoon, morning))


# ---- GMV and dashboard totals ------------------------------------------------

def q_dau_anti_join_mid(spark: SparkSession, sf: str) -> DataFrame:
    """Processing-day form (J5): a device that was seen after midnight on any day is not new."""
    logs = tables.startup_logs(spark, sf, ZONE)
    night = logs.where(F.col("logHour") < NIGHT_END)
    return dau.first_seen(dau.new_against(logs.where(F.col("logHour") >= NIGHT_END), night, by="mid"))


def late_startups(spark: SparkSession, sf: str) -> DataFrame:
    """Start-up logs with an arrival time: a seventh of them arrive 30 hours late."""
    logs = tables.startup_logs(spark, sf, ZONE)
    return logs.withColumn("arrived", F.col("ts") + F.when(F.col("ts") % 7 == 0, LATE_MS).otherwise(0))


SET_COLUMNS = ["mid", "logDate", "logHour", "type", "ts", "arrived", "opened"]


def q_dau_expiring(spark: SparkSession, sf: str) -> DataFrame:
    """First arrivals per seen set (T2): a day's set dies a day after it was opened."""
    logs = late_startups(spark, sf)
    return dau.first_per_set(logs, dau.openings(logs, SET_SECONDS)).select(*SET_COLUMNS)


def q_gmv_total(spark: SparkSession, sf: str) -> DataFrame:
    return gmv.gmv_total(tables.orders(spark, sf)).select("create_date", _r2("order_amount"))


def q_gmv_hours(spark: SparkSession, sf: str) -> DataFrame:
    g = gmv.gmv_hours(tables.purchase_orders(spark, sf))
    return g.select("create_date", "create_hour", _r2("order_amount"))


def q_realtime_total(spark: SparkSession, sf: str) -> DataFrame:
    out = api.realtime_total_all_days(q_dau_first_seen(spark, sf), tables.purchase_orders(spark, sf))
    return out.select("date", "id", "name", _r2("value"))


def q_realtime_total_day(spark: SparkSession, sf: str) -> DataFrame:
    """The totals of one day, by an equality on the text date (F1)."""
    out = api.realtime_total(spark, q_dau_first_seen(spark, sf), tables.purchase_orders(spark, sf), DAY)
    return out.select("id", "name", _r2("value"))


def q_realtime_hours(spark: SparkSession, sf: str) -> DataFrame:
    return api.realtime_hours_all_days("dau", q_dau_first_seen(spark, sf),
                                       tables.purchase_orders(spark, sf))


def q_realtime_hours_gmv(spark: SparkSession, sf: str) -> DataFrame:
    out = api.realtime_hours_all_days("order_amount", q_dau_first_seen(spark, sf),
                                      tables.purchase_orders(spark, sf))
    return out.select("date", "hour", _r2("today"), _r2("yesterday"))


# ---- change capture ------------------------------------------------------------

def q_cdc_route(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.route(changes.change_log(spark, sf))


def q_cdc_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.flatten(changes.change_log(spark, sf))


def q_canal_explode(spark: SparkSession, sf: str) -> DataFrame:
    rows = cdc.orders_from_binlog(changes.binlog_envelopes(spark, sf))
    return rows.select("id", "user_id", "order_status", "total_amount", "create_time",
                       "create_date", "create_hour", F.col("src_type").alias("type"))


# ---- sale detail -----------------------------------------------------------------

def q_order_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    return sales.order_line_status(tables.orders(spark, sf), tables.order_lines(spark, sf, names="none"))


def q_sale_detail_wide(spark: SparkSession, sf: str) -> DataFrame:
    return sales.sale_detail(tables.orders(spark, sf), tables.order_lines(spark, sf),
                             tables.users(spark, sf))


def q_sale_detail_user_left(spark: SparkSession, sf: str) -> DataFrame:
    return sales.sale_detail(tables.orders(spark, sf), tables.order_lines(spark, sf), tables.users(spark, sf),
                             as_of=AGES_AS_OF)


def q_sale_detail_day(spark: SparkSession, sf: str) -> DataFrame:
    """The sale rows of one day, by an exact term."""
    return q_sale_detail_wide(spark, sf).where(F.col("dt") == SALE_DAY)


def q_user_json(spark: SparkSession, sf: str) -> DataFrame:
    """The newest record of every user as JSON text."""
    return to_json_row(q_user_latest(spark, sf))


def q_order_full_outer_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """J1 from stored tables: orders and lines, both in buckets of the order id, joined bucket by bucket."""
    root = scratch_dir(spark, "bucketed-orders")
    return sales.order_line_status(
        buckets.write(tables.orders(spark, sf), f"{root}/orders", "id"),
        buckets.write(tables.order_lines(spark, sf, names="none"), f"{root}/lines", "order_id"))


def q_sale_detail_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """J3 from stored tables: sale lines and users, both in buckets of the user id."""
    root = scratch_dir(spark, "bucketed-sales")
    pairs = sales.sale_lines(tables.orders(spark, sf), tables.order_lines(spark, sf))
    return sales.with_users(buckets.write(pairs, f"{root}/sale", "user_id"),
                            buckets.write(tables.users(spark, sf), f"{root}/users", "id"))


def q_user_latest(spark: SparkSession, sf: str) -> DataFrame:
    return sales.latest_users(changes.user_changes(spark, sf)).select(
        F.col("id").cast("string").alias("id"), "login_name", "user_level", "birthday", "gender")


# ---- search ------------------------------------------------------------------------

def _matches(spark: SparkSession, sf: str, keyword: str = KEYWORD) -> DataFrame:
    rows = sales.sale_detail(tables.orders(spark, sf), tables.order_lines(spark, sf, names="before"),
                             tables.users(spark, sf))
    return search.keyword_rows(rows, keyword)


def q_keyword_match(spark: SparkSession, sf: str) -> DataFrame:
    return _matches(spark, sf, KEYWORD_TWO_TOKENS)


def q_facet_gender(spark: SparkSession, sf: str) -> DataFrame:
    f = search.facet(_matches(spark, sf), "user_gender", GENDER_TOP)
    return f.withColumn("rank", F.col("rank").cast("long"))


def q_facet_age(spark: SparkSession, sf: str) -> DataFrame:
    f = search.facet(_matches(spark, sf), "user_age", PAGE_SIZE)
    return f.withColumn("rank", F.col("rank").cast("long"))


def q_age_shares(spark: SparkSession, sf: str) -> DataFrame:
    return search.age_shares(_matches(spark, sf))


def q_gender_shares(spark: SparkSession, sf: str) -> DataFrame:
    return search.gender_shares(_matches(spark, sf))


def q_search_stat(spark: SparkSession, sf: str) -> DataFrame:
    """The two share charts of the search answer (Q3), one row per day, chart and option."""
    charts = search.stats(search.shares(_matches(spark, sf)))
    return charts.select("dt", "title", F.posexplode("options").alias("pos", "o")).select(
        "dt", "title", F.col("pos").cast("long").alias("place"), "o.name", "o.value")


def q_search_answer(spark: SparkSession, sf: str) -> DataFrame:
    """The whole search answer of every day (Q3) from one read: total, shares, facets, page."""
    found = search.answer(_matches(spark, sf), PAGE_OFFSET, PAGE_SIZE, top_genders=GENDER_TOP)

    def text(facet: str):
        return F.concat_ws(",", F.transform(facet, lambda x: F.concat_ws(":", x["value"].cast("string"), x["doc_count"].cast("string"))))

    page = F.concat_ws(",", F.transform("detail", lambda r: F.concat_ws("/", r["order_detail_id"], r["user_id"], r["sku_id"])))
    return found.select("dt", F.col("total").cast("long").alias("total"), "under_20", "from_20_to_30", "over_30", "male", "female",
                        text("genders").alias("genders"), text("ages").alias("ages"), page.alias("page"))


def q_sale_detail_page(spark: SparkSession, sf: str) -> DataFrame:
    p = search.page(_matches(spark, sf), PAGE_OFFSET, PAGE_SIZE)
    return p.withColumn("row_no", F.col("row_no").cast("long"))


# ---- alerts ----------------------------------------------------------------------------

def _events(spark: SparkSession, sf: str) -> DataFrame:
    return tables.event_logs(spark, sf, ZONE)


def q_alert_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.window_alerts(_events(spark, sf), ALERT_LENGTH, None, MIN_UIDS)


def q_alert_sliding(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.window_alerts(_events(spark, sf), SLIDING_LENGTH, ALERT_SLIDE, MIN_UIDS)


def q_alert_trailing(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.trailing_alerts(_events(spark, sf), ALERT_LENGTH, MIN_UIDS)


def q_alert_days(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts stored in folders of their day (S12), of which two days' are read."""
    path = f"{scratch_dir(spark, 'alert-days')}/alerts"
    rows = (alerts.window_alerts(_events(spark, sf), ALERT_LENGTH, ALERT_SLIDE, MIN_UIDS)
            .withColumn(stored.DAY, stored.day_of("window_start")))
    store.write_batch(rows, path, 0, stored.DAY)
    return stored.read_kept(spark, path, ALERT_DAYS)


def q_word_window(spark: SparkSession, sf: str) -> DataFrame:
    """Words of the event log per tumbling window (W3) in event time."""
    e = tables.table(spark, sf, "events").select(F.col("ts").alias("t"), F.col("event_type").alias("value"))
    out = words.word_counts(e, WORD_WINDOW, "t")
    return out.select(ms_from_ntz("window_start").alias("window_start"), ms_from_ntz("window_end").alias("window_end"),
                      "word", "n")


def q_alert_per_minute(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.per_minute(q_alert_sliding(spark, sf))


def q_alert_throttle_60s(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.throttle(q_alert_sliding(spark, sf), 60)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dau_first_seen": q_dau_first_seen,
    "dau_total": q_dau_total,
    "dau_hours": q_dau_hours,
    "dau_anti_join": q_dau_anti_join,
    "dau_anti_join_mid": q_dau_anti_join_mid,
    "dau_expiring": q_dau_expiring,
    "gmv_total": q_gmv_total,
    "gmv_hours": q_gmv_hours,
    "realtime_total": q_realtime_total,
    "realtime_total_day": q_realtime_total_day,
    "realtime_hours": q_realtime_hours,
    "realtime_hours_gmv": q_realtime_hours_gmv,
    "cdc_route": q_cdc_route,
    "cdc_flatten": q_cdc_flatten,
    "canal_explode": q_canal_explode,
    "order_full_outer": q_order_full_outer,
    "sale_detail_wide": q_sale_detail_wide,
    "sale_detail_user_left": q_sale_detail_user_left,
    "sale_detail_day": q_sale_detail_day,
    "user_json": q_user_json,
    "alert_days": q_alert_days,
    "order_full_outer_bucketed": q_order_full_outer_bucketed,
    "sale_detail_bucketed": q_sale_detail_bucketed,
    "user_latest": q_user_latest,
    "keyword_match": q_keyword_match,
    "facet_gender": q_facet_gender,
    "facet_age": q_facet_age,
    "age_shares": q_age_shares,
    "gender_shares": q_gender_shares,
    "sale_detail_page": q_sale_detail_page,
    "search_stat": q_search_stat,
    "search_answer": q_search_answer,
    "alert_tumbling": q_alert_tumbling,
    "alert_sliding": q_alert_sliding,
    "alert_trailing": q_alert_trailing,
    "alert_per_minute": q_alert_per_minute,
    "alert_throttle_60s": q_alert_throttle_60s,
    "word_window": q_word_window,
}

# streaming twins: same answers through the streaming jobs (same oracle as the batch query)
STREAM_TWINS = {
    "dau_first_seen_stream": "dau_first_seen",
    "dau_state_stream": "dau_first_seen",
    "gmv_total_stream": "gmv_total",
    "alert_tumbling_stream": "alert_tumbling",
    "alert_sliding_stream": "alert_sliding",
    "sale_detail_stream": "sale_detail_wide",
    "cdc_route_stream": "cdc_route",
    "alert_throttle_stream": "alert_throttle_60s",
    "user_latest_stream": "user_latest",
    "cached_pairs_stream": "cached_pairs",
    "dau_expiring_stream": "dau_expiring",
}


def _twins() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from shoplens.plans import twins

    return {"cached_pairs": twins.cached_pairs} | twins.TWINS


QUERIES.update(_twins())
