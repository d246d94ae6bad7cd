"""Command-line entry points: the streaming jobs and the dashboard answers.

    python -m shoplens.apps dau        --source DIR|kafka://HOSTS/TOPIC --table T --checkpoint C
    python -m shoplens.apps gmv        --source ... --table T --checkpoint C [--envelope]
    python -m shoplens.apps alerts     --source ... --table T --checkpoint C [--length "5 minutes" --slide "1 minute"] [--final]
    python -m shoplens.apps throttle   --alerts DIR --out DIR --checkpoint C [--gap 60]
    python -m shoplens.apps users      --source ... --table T --checkpoint C
    python -m shoplens.apps sale-detail --orders ... --lines ... --users-table T --table T --checkpoint C
    python -m shoplens.apps router     --source ... --out DIR|kafka://HOSTS --checkpoint C
    python -m shoplens.apps alert-search --table T --days D[,D] [--form all|per-minute|throttled|kept]
    python -m shoplens.apps realtime-total --dau-table T --order-table T --date D
    python -m shoplens.apps realtime-hours --dau-table T --order-table T --id dau|order_amount --date D
    python -m shoplens.apps sale-search --table T --date D --startpage N --size N --keyword K
    python -m shoplens.apps compact --table T --out T2 --key id [--partition part]

Streaming jobs run until stopped (``--trigger 3s`` micro-batches) or, with
``--once``, process what is available and stop.  Dashboard answers are a few
rows (3 totals, 48 hourly values, one page), printed as JSON.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.decode import decode_order, decode_order_detail, decode_user
from shoplens.session import get_spark
from shoplens.sources import streams


def _offsets(text: str | None) -> dict[int, int] | None:
    """``0:15,1:27`` -> {0: 15, 1: 27}: where each partition of the topic starts."""
    return {int(p): int(o) for p, o in (x.split(":") for x in text.split(","))} if text else None


def _source(spark: SparkSession, spec: str, max_per_trigger: int | None, offsets: str | None = None) -> DataFrame:
    if spec.startswith("kafka://"):
        hosts, topic = spec[len("kafka://"):].split("/", 1)
        return streams.topic_stream(spark, hosts, topic, _offsets(offsets), max_per_trigger)
    return streams.json_lines_stream(spark, spec, max_files_per_trigger=max_per_trigger)


def _trigger(args) -> dict:
    return {"availableNow": True} if args.once else {"processingTime": args.trigger}


def _with_ts(rows: DataFrame, ts_field: str | None) -> DataFrame:
    """Event time of a change row: a given epoch-ms field, else arrival time."""
    if ts_field:
        return rows.withColumn("ts", F.col(ts_field).try_cast("long"))
    return rows.withColumn("ts", F.unix_millis(F.current_timestamp()))


def run_job(spark: SparkSession, args):
    from shoplens.streaming import alerts, cdc, dau, dau_state, gmv, sales

    trig = _trigger(args)
    if args.cmd == "dau" and args.state:
        return dau_state.start(_source(spark, args.source, args.max_per_trigger, args.offsets), args.table,
                               args.checkpoint, args.zone, trigger=trig, state_partitions=args.state_partitions)
    if args.cmd == "dau":
        return dau.start(_source(spark, args.source, args.max_per_trigger, args.offsets), args.table, args.checkpoint,
                         args.zone, trig, state_partitions=args.state_partitions, reject_path=args.rejects)
    if args.cmd == "gmv":
        return gmv.start(_source(spark, args.source, args.max_per_trigger, args.offsets), args.table, args.checkpoint,
                         args.envelope, trig, state_partitions=args.state_partitions, grain=args.grain)
    if args.cmd == "alerts":
        src = _source(spark, args.source, args.max_per_trigger, args.offsets)
        if args.final:  # closed windows only, appended once each (input of `throttle`)
            return alerts.start_final(src, args.table, args.checkpoint, args.length, args.slide,
                                      args.watermark, trig, state_partitions=args.state_partitions,
                                      panes=args.panes)
        return alerts.start(src, args.table, args.checkpoint, args.length, args.slide, args.watermark, trig,
                            state_partitions=args.state_partitions)
    if args.cmd == "throttle":
        return alerts.start_throttle(spark, args.alerts, args.out, args.checkpoint, args.gap, trig,
                                     state_partitions=args.state_partitions)
    if args.cmd == "users":
        users = decode_user(_source(spark, args.source, args.max_per_trigger, args.offsets))
        return sales.start_users(users, args.table, args.checkpoint, trig, state_partitions=args.state_partitions)
    if args.cmd == "sale-detail":
        orders = _with_ts(decode_order(_source(spark, args.orders, args.max_per_trigger)), args.ts_field)
        lines = _with_ts(decode_order_detail(_source(spark, args.lines, args.max_per_trigger)), args.ts_field)
        def users(ids):  # re-read every micro-batch: users written meanwhile are seen
            u = sales.read_users(spark, args.users_table, ids)
            if u is None:
                u = spark.createDataFrame([], "id string, login_name string, user_level string, "
                                              "birthday string, gender string")
            return u

        return sales.start(orders, lines, users, args.table, args.checkpoint, args.bound, args.watermark,
                           None, trig, args.grain, state_partitions=args.state_partitions)
    if args.cmd == "router":
        return cdc.start(_source(spark, args.source, args.max_per_trigger, args.offsets), args.out, args.checkpoint, trig)
    raise ValueError(args.cmd)


def answer(spark: SparkSession, args) -> object:
    from shoplens.plans import api
    from shoplens.streaming import dau, gmv, sales

    if args.cmd in ("realtime-total", "realtime-hours"):
        import datetime as _dt

        days = [args.date]
        if args.cmd == "realtime-hours":
            days.append((_dt.date.fromisoformat(args.date) - _dt.timedelta(days=1)).isoformat())
        d = dau.read(spark, args.dau_table, days)
        o = gmv.read(spark, args.order_table, days)
        if d is None:
            d = spark.createDataFrame([], "mid string, logDate string, logHour string")
        if o is None:
            o = spark.createDataFrame([], "id string, total_amount double, create_date string, create_hour string")
        if args.cmd == "realtime-total":
            return [r.asDict() for r in api.realtime_total(spark, d, o, args.date).collect()]
        rows = api.realtime_hours(args.id, d, o, args.date).collect()
        out: dict[str, dict[str, float]] = {"yesterday": {}, "today": {}}
        for r in rows:
            out[r.day][r.hour] = r.value
        return out
    if args.cmd == "alert-search":
        from shoplens.streaming import alerts

        days = args.days.split(",")
        read = {"all": alerts.read_alerts, "per-minute": alerts.read_per_minute, "throttled": alerts.read_throttled}
        rows = (alerts.read_kept(spark, args.table, days) if args.form == "kept"
                else read[args.form](spark, args.table, days=days))
        if rows is None:
            return {"total": 0, "detail": []}
        page = rows.orderBy("ts", "mid", "window_start").offset(args.start).limit(args.size)
        return {"total": rows.count(), "detail": [r.asDict() for r in page.collect()]}
    if args.cmd == "compact":
        from shoplens.sources import store

        done = store.compact(spark, args.table, args.out, args.key.split(","), args.partition,
                             args.order.split(",") if args.order else None)
        return {"compacted": done, "out": args.out}
    if args.cmd == "sale-search":
        table = sales.read(spark, args.table, args.date)
        if table is None:
            return {"total": 0, "stat": [], "detail": []}
        res = api.sale_detail(table, args.date, args.startpage, args.size, args.keyword, not args.facet_top_only)
        stat = [{"title": r.title, "options": [o.asDict() for o in r.options]} for r in res["stat"].collect()]
        detail = [r.asDict() for r in res["detail"].drop("row_no").collect()]
        return {"total": res["total"].first().total, "stat": stat, "detail": detail}
    raise ValueError(args.cmd)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="shoplens.apps")
    sub = p.add_subparsers(dest="cmd", required=True)

    def job(name: str) -> argparse.ArgumentParser:
        s = sub.add_parser(name)
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--trigger", default="5 seconds")
        s.add_argument("--once", action="store_true", help="process what is available, then stop")
        s.add_argument("--max-per-trigger", type=int, default=None)
        s.add_argument("--state-partitions", type=int, default=None,
                       help="shuffle / state partitions of the query (fixed at first start)")
        s.add_argument("--offsets", default=None,
                       help="topic sources, first start only: partition:offset[,...] instead of the latest")
        return s

    s = job("dau")
    s.add_argument("--source", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--zone", default="UTC")
    s.add_argument("--state", action="store_true", help="keep the seen devices in Spark's state, not in the table")
    s.add_argument("--rejects", default=None, help="folder for rows without a device or a time")
    s = job("gmv")
    s.add_argument("--source", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--envelope", action="store_true")
    s.add_argument("--grain", default="day", choices=["day", "month"])
    s = job("alerts")
    s.add_argument("--source", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--length", default="5 minutes")
    s.add_argument("--slide", default="1 minute")
    s.add_argument("--watermark", default="10 minutes")
    s.add_argument("--final", action="store_true", help="append closed windows only")
    s.add_argument("--panes", action="store_true",
                   help="with --final: sliding windows from slide-sized panes (small slides)")
    s = job("throttle")
    s.add_argument("--alerts", required=True, help="output folder of `alerts --final`")
    s.add_argument("--out", required=True)
    s.add_argument("--gap", type=int, default=60)
    s = job("users")
    s.add_argument("--source", required=True)
    s.add_argument("--table", required=True)
    s = job("sale-detail")
    s.add_argument("--orders", required=True)
    s.add_argument("--lines", required=True)
    s.add_argument("--users-table", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--bound", type=int, default=100)
    s.add_argument("--watermark", default="100 seconds")
    s.add_argument("--grain", default="day", choices=["day", "month"])
    s.add_argument("--ts-field", default=None, help="epoch-ms field of the records (default: arrival time)")
    s = job("router")
    s.add_argument("--source", required=True)
    s.add_argument("--out", required=True)

    for name in ("realtime-total", "realtime-hours"):
        s = sub.add_parser(name)
        s.add_argument("--dau-table", required=True)
        s.add_argument("--order-table", required=True)
        s.add_argument("--date", required=True)
        if name == "realtime-hours":
            s.add_argument("--id", required=True)
    s = sub.add_parser("alert-search", help="one page of the alerts of some days")
    s.add_argument("--table", required=True)
    s.add_argument("--days", required=True, help="days of the windows' start, yyyy-MM-dd[,...]")
    s.add_argument("--form", default="all", choices=["all", "per-minute", "throttled", "kept"],
                   help="kept: the output of `alerts --final` or `throttle`")
    s.add_argument("--start", type=int, default=0)
    s.add_argument("--size", type=int, default=20)
    s = sub.add_parser("compact", help="write the newest row per key of a keyed table to a new path")
    s.add_argument("--table", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--key", required=True, help="comma-separated key columns")
    s.add_argument("--partition", default=None, help="folder column of the table, if any")
    s.add_argument("--order", default=None, help="extra order columns after the batch id")
    s = sub.add_parser("sale-search")
    s.add_argument("--table", required=True)
    s.add_argument("--date", required=True)
    s.add_argument("--startpage", type=int, default=0)
    s.add_argument("--size", type=int, default=10)
    s.add_argument("--keyword", required=True)
    s.add_argument("--facet-top-only", action="store_true",
                   help="age shares from the top `size` age facets only (original behaviour)")
    return p


JOBS = {"dau", "gmv", "alerts", "throttle", "users", "sale-detail", "router"}


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    args = parser().parse_args(argv)
    spark = spark or get_spark(app=f"shoplens-{args.cmd}")
    if args.cmd in JOBS:
        q = run_job(spark, args)
        q.awaitTermination()
        return q
    out = answer(spark, args)
    print(json.dumps(out, ensure_ascii=False, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
