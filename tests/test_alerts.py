from shoplens.operators import alerts

COLS = "mid string, uid string, evid string, itemid string, ts long"

# F-2: rows keyed by their own mid
F2 = [
    ("mid_108", "416", "coupon", "9", 1638432453698),
    ("mid_108", "313", "coupon", "24", 1638432453698),
    ("mid_108", "222", "coupon", "38", 1638432453698),
    ("mid_313", "123", "coupon", "32", 1638432453699),
    ("mid_386", "1111", "coupon", "9", 1638467970000),
    ("mid_386", "2222", "coupon", "9", 1638467970000),
    ("mid_386", "3333", "coupon", "9", 1638467970000),
    ("mid_110", "1111", "clickItem", "9", 1638432453698),
]


def ev(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_f2_two_alerts(spark):
    out = sorted(alerts.window_alerts(ev(spark, F2), "5 minutes").collect(), key=lambda r: r.mid)
    assert [(r.mid, r.uids, r.item_ids, r.events, r.n_events, r.ts, r.doc_id) for r in out] == [
        ("mid_108", "222,313,416", "24,38,9", "coupon x3", 3, 1638432453698, "mid_10827307207"),
        ("mid_386", "1111,2222,3333", "9", "coupon x3", 3, 1638467970000, "mid_38627307799"),
    ]


def test_click_inside_window_suppresses_outside_does_not(spark):
    base = [r for r in F2 if r[0] == "mid_386"]
    inside = base + [("mid_386", "1", "clickItem", "5", 1638467970000 + 1000)]
    outside = base + [("mid_386", "1", "clickItem", "5", 1638467970000 + 10 * 60_000)]
    assert alerts.window_alerts(ev(spark, inside), "5 minutes").count() == 0
    assert alerts.window_alerts(ev(spark, outside), "5 minutes").count() == 1
    # the trailing form: a click after the coupons does not undo alerts already raised
    trail = alerts.trailing_alerts(ev(spark, inside), "5 minutes").collect()
    assert {r.evid for r in trail} == {"coupon"}


def test_events_without_time_are_in_no_window(spark):
    rows = F2 + [("mid_9", str(k), "coupon", "1", None) for k in range(3)]
    for slide in (None, "1 minute", "7 seconds"):  # plain, panes, window() copies
        got = alerts.window_alerts(ev(spark, rows), "5 minutes", slide)
        assert {r.mid for r in got.collect()} == {"mid_108", "mid_386"}
    assert {r.mid for r in alerts.trailing_alerts(ev(spark, rows), "5 minutes").collect()} == {"mid_108", "mid_386"}


def test_event_list_counts_every_type(spark):
    rows = F2[4:7] + [("mid_386", "7", "view", "1", 1638467970001), ("mid_386", "7", "addCart", None, 1638467970002),
                      ("mid_386", "8", "view", "2", 1638467970003)]
    for slide in (None, "1 minute"):
        assert {r.events for r in alerts.window_alerts(ev(spark, rows), "5 minutes", slide).collect()} <= {
            "addCart x1,coupon x3,view x2", "coupon x3"}
    assert alerts.window_alerts(ev(spark, rows), "5 minutes").first().events == "addCart x1,coupon x3,view x2"


def test_two_uids_or_one_uid_thrice_is_no_alert(spark):
    two = [("m", "1", "coupon", "1", 1000), ("m", "2", "coupon", "1", 2000), ("m", "2", "coupon", "1", 3000)]
    same = [("m", "1", "coupon", "1", 1000), ("m", "1", "coupon", "2", 2000), ("m", "1", "coupon", "3", 3000)]
    assert alerts.window_alerts(ev(spark, two), "5 minutes").count() == 0
    assert alerts.window_alerts(ev(spark, same), "5 minutes").count() == 0


def test_null_uid_counts_as_member(spark):
    rows = [("m", "1", "coupon", "1", 1000), ("m", "2", "coupon", "1", 2000), ("m", None, "coupon", None, 3000)]
    out = alerts.window_alerts(ev(spark, rows), "5 minutes").collect()
    assert len(out) == 1 and out[0].n_uids == 3


def test_sliding_and_trailing_windows(spark):
    base = 1_700_000_000_000
    rows = [("m", str(i), "coupon", "1", base + i * 60_000) for i in range(3)]
    sliding = alerts.window_alerts(ev(spark, rows), "5 minutes", "1 minute").collect()
    # every 5-minute window (1-minute slide) holding all three coupons alerts
    assert len(sliding) >= 1 and all(r.n_uids == 3 for r in sliding)
    trailing = alerts.trailing_alerts(ev(spark, rows), "5 minutes").collect()
    assert [r.ts for r in trailing] == [base + 120_000]
    # 3 coupons spread over 6 minutes never sit inside one 5-minute trailing window
    wide = [("m", str(i), "coupon", "1", base + i * 180_000) for i in range(3)]
    assert alerts.trailing_alerts(ev(spark, wide), "5 minutes").count() == 0


def _alert_rows(spark, rows):
    return spark.createDataFrame(rows, "mid string, window_start long, window_end long, ts long, doc_id string")


def test_throttle_59_and_60_seconds(spark):
    t0 = 1_638_467_970_000
    rows = [("a", 0, 1, t0, "x"), ("a", 1, 2, t0 + 59_000, "x"),
            ("b", 0, 1, t0, "y"), ("b", 1, 2, t0 + 60_000, "y")]
    kept = alerts.throttle(_alert_rows(spark, rows), 60).collect()
    assert sorted((r.mid, r.ts) for r in kept) == [("a", t0), ("b", t0), ("b", t0 + 60_000)]


def test_throttle_uses_whole_seconds_and_chain(spark):
    t0 = 1_000_000_000_999
    # 59.002 s apart in ms but 60 whole seconds apart: kept, as in the original rule
    rows = [("a", 0, 1, t0, "x"), ("a", 1, 2, t0 + 59_002, "x"), ("a", 2, 3, t0 + 100_000, "x"),
            ("a", 3, 4, t0 + 130_000, "x")]
    kept = [r.ts for r in alerts.throttle(_alert_rows(spark, rows), 60).orderBy("ts").collect()]
    assert kept == [t0, t0 + 59_002, t0 + 130_000]


def test_throttle_seed_from_earlier_batches(spark):
    t0 = 1_638_467_970_000
    rows = [("a", 0, 1, t0 + 30_000, "x"), ("a", 1, 2, t0 + 61_000, "x")]
    seed = spark.createDataFrame([("a", t0)], "mid string, last_ts long")
    kept = [r.ts for r in alerts.throttle(_alert_rows(spark, rows), 60, seed).collect()]
    assert kept == [t0 + 61_000]


def test_per_minute_latest_window_wins(spark):
    rows = [("a", 0, 10, 60_000, "a1"), ("a", 5, 15, 60_500, "a1"), ("a", 5, 15, 120_000, "a2")]
    out = sorted((r.doc_id, r.window_start) for r in alerts.per_minute(_alert_rows(spark, rows)).collect())
    assert out == [("a1", 5), ("a2", 5)]


def test_stream_alerts_equal_batch(spark, scratch):
    from shoplens.plans import catalog, twins

    sf = "/root/testdata/sf0.01"
    a = sorted(tuple(r) for r in catalog.q_alert_tumbling(spark, sf).collect())
    b = sorted(tuple(r) for r in twins.alert_tumbling_stream(spark, sf).select(
        *catalog.q_alert_tumbling(spark, sf).columns).collect())
    assert a == b and len(a) > 20


def test_streaming_throttle_with_keyed_state(spark, scratch):
    import time

    from shoplens.streaming import alerts as alert_stream

    root = scratch("throttle")
    t0 = 1_638_467_970_000
    cols = alert_stream.ALERT_SCHEMA
    first = [("a", 0, 1, t0, "x", 3, "", "", "", 3), ("a", 1, 2, t0 + 59_000, "x", 3, "", "", "", 3),
             ("b", 0, 1, t0, "y", 3, "", "", "", 3)]
    second = [("a", 2, 3, t0 + 60_000, "x", 3, "", "", "", 3), ("b", 1, 2, t0 + 30_000, "y", 3, "", "", "", 3)]
    spark.createDataFrame(first, cols).write.mode("append").parquet(f"{root}/alerts")

    def run():
        q = alert_stream.start_throttle(spark, f"{root}/alerts", f"{root}/kept", f"{root}/ckpt")
        q.awaitTermination()
        assert q.exception() is None

    run()
    time.sleep(0.05)
    spark.createDataFrame(second, cols).write.mode("append").parquet(f"{root}/alerts")
    run()
    got = sorted((r.mid, r.ts) for r in spark.read.parquet(f"{root}/kept").collect())
    # a: t0 kept, +59 s dropped, +60 s (next batch, state carried) kept; b: +30 s dropped
    assert got == [("a", t0), ("a", t0 + 60_000), ("b", t0)]


def test_final_alerts_append_mode(spark, scratch):
    import json

    from shoplens.streaming import alerts as alert_stream
    from tests.conftest import write_lines

    root = scratch("final")
    base = 1_700_000_000_000
    rows = [{"mid": "m", "uid": str(i), "evid": "coupon", "itemid": "1", "ts": base + i * 1000} for i in range(3)]
    # a much later event moves the watermark past the first window so it closes
    rows.append({"mid": "n", "uid": "9", "evid": "view", "itemid": "1", "ts": base + 3_600_000})
    write_lines(f"{root}/in", [json.dumps(r) for r in rows[:3]], "a.json")
    from shoplens.sources import streams

    def run():
        q = alert_stream.start_final(streams.json_lines_stream(spark, f"{root}/in", 1), f"{root}/out",
                                     f"{root}/ckpt", length="5 minutes", slide=None, watermark="1 minute")
        q.awaitTermination()
        assert q.exception() is None

    run()
    import time

    time.sleep(0.05)
    write_lines(f"{root}/in", [json.dumps(rows[3])], "b.json")
    run()
    out = spark.read.parquet(f"{root}/out").collect()
    assert [(r.mid, r.n_uids) for r in out] == [("m", 3)]


def _direct(events, length, slide, min_uids):
    """Sliding windows by copying every event into each of its windows."""
    return alerts.alerts_from_state(alerts.window_state(events, length, slide), min_uids)


def test_swept_sliding_windows_equal_the_window_function(spark):
    from pyspark.sql import functions as F

    from shoplens.plans import catalog

    ev = catalog._events(spark, "/root/testdata/sf0.01")
    ev = ev.withColumn("mid", F.nullif((F.col("uid").cast("int") % 10).cast("string"), F.lit("3")))  # dense devices, one null
    for length, slide in (("5 minutes", "5 seconds"), ("1 hour", "15 minutes"), ("10 minutes", "1 minute")):
        swept = alerts.window_alerts(ev, length, slide, 2)
        a, b = (sorted((tuple(r) for r in df.collect()), key=str) for df in (swept, _direct(ev, length, slide, 2)))
        assert a == b and len(a) > 0 and any(r[0] is None for r in a), (length, slide)


def test_swept_rows_do_not_grow_with_length_over_slide(spark):
    from pyspark.sql import functions as F

    from shoplens.operators import sweep
    from shoplens.plans import catalog

    ev = catalog._events(spark, "/root/testdata/sf0.01").withColumn("mid", (F.col("uid").cast("int") % 10).cast("string"))
    made = []
    for panes in (12, 120):  # of a window of two hours
        over = sweep.Sweep(panes, panes)
        marks = alerts._marks(ev, F.floor(F.col("ts") / F.lit(7_200_000 // panes))).where("uid is not null")
        accounts = over.activity(marks, ["uid"])
        made.append((marks.count(), accounts.count(), over.changes(accounts, {"n": F.lit(True)}).count()))
    assert made[0][0] == made[1][0] < made[1][2] < 1.2 * made[0][2] < 4 * made[0][0], made


def test_no_set_over_a_window_in_swept_plans(spark):
    from shoplens.plans import catalog

    for q in (catalog.q_alert_trailing, catalog.q_alert_sliding):
        plan = q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.splitlines() if " Window [" in line or "+- Window" in line]
        assert windows and not any("collect_" in line for line in windows)


def test_trailing_rule_on_one_dense_device(spark):
    """100,000 events of one device inside a window or two, against a two-pointer sweep."""
    from collections import Counter, deque

    span, base = 300_000, 1_700_000_000_000
    ev = spark.range(100_000).selectExpr(
        "'m' as mid", "cast(id % 3 as string) as uid", "if(id % 9000 = 4000, 'clickItem', if(id % 50 = 0, 'coupon', 'view')) as evid",
        "cast(id % 7 as string) as itemid", f"{base} + id * 6 as ts")
    rows = ev.orderBy("ts").collect()
    held, uids, types, want = deque(), Counter(), Counter(), []
    for r in rows:
        held.append(r)
        types[r.evid] += 1
        uids[r.uid] += r.evid == "coupon"
        while held[0].ts <= r.ts - span:
            old = held.popleft()
            types[old.evid] -= 1
            uids[old.uid] -= old.evid == "coupon"
        if sum(n > 0 for n in uids.values()) >= 3 and not types["clickItem"]:
            want.append((r.ts, ",".join(f"{t} x{n}" for t, n in sorted(types.items()) if n)))
    for split in (1, 8):
        got = sorted((r.ts, r.events) for r in alerts.trailing_alerts(ev, "5 minutes", 3, split).collect())
        assert got == want and (split > 1 or 0 < len(got))


def test_streaming_panes_equal_batch_windows(spark, scratch):
    import json
    import time

    from shoplens.sources import streams
    from shoplens.streaming import alerts as alert_stream
    from tests.conftest import write_lines

    root = scratch("panes")
    base = 1_700_000_000_000
    rows = [{"mid": "m", "uid": str(i % 4), "evid": "coupon", "itemid": str(i), "ts": base + i * 7_000}
            for i in range(40)]
    rows += [{"mid": "m", "uid": "x", "evid": "clickItem", "itemid": "1", "ts": base + 200_000}]
    rows += [{"mid": "k", "uid": str(i), "evid": "coupon", "itemid": "2", "ts": base + 50_000 + i} for i in range(3)]
    write_lines(f"{root}/in", [json.dumps(r) for r in rows], "a.json")
    time.sleep(0.05)
    # a late-enough event closes every window above
    write_lines(f"{root}/in", [json.dumps({"mid": "z", "uid": "1", "evid": "view", "itemid": "1",
                                           "ts": base + 3_600_000})], "b.json")
    q = alert_stream.start_final(streams.json_lines_stream(spark, f"{root}/in", 1), f"{root}/out",
                                 f"{root}/ckpt", length="1 minute", slide="10 seconds",
                                 watermark="30 seconds", panes=True, state_partitions=4)
    q.awaitTermination()
    assert q.exception() is None
    got = sorted(tuple(r) for r in spark.read.parquet(f"{root}/out").select(
        "mid", "window_start", "window_end", "ts", "n_uids", "uids", "item_ids", "n_events").collect())
    ev = spark.createDataFrame([(r["mid"], r["uid"], r["evid"], r["itemid"], r["ts"]) for r in rows], COLS)
    want = sorted(tuple(r) for r in alerts.window_alerts(ev, "1 minute", "10 seconds").select(
        "mid", "window_start", "window_end", "ts", "n_uids", "uids", "item_ids", "n_events").collect())
    assert got == want and len(want) > 0


def test_stream_sliding_panes_equal_batch(spark):
    from shoplens.plans import catalog, twins

    sf = "/root/testdata/sf0.01"
    batch = catalog.q_alert_sliding(spark, sf)
    a = sorted(tuple(r) for r in batch.collect())
    b = sorted(tuple(r) for r in twins.alert_sliding_stream(spark, sf).select(*batch.columns).collect())
    assert a == b and len(a) > 50


def test_sliding_queries_hold_a_whole_day(spark, scratch):
    """Three accounts of a device within 20 hours: windows of a day alert, in batch and as a stream."""
    from shoplens.plans import catalog, twins

    sf = scratch("day-windows")
    at = "timestamp_ntz'2024-01-10 00:40:00' + make_dt_interval(0, id * 10)"
    spark.range(3).selectExpr("id as event_id", "id as user_id", "'signup' as event_type", f"{at} as ts", "'{\"k\": 1}' as props").write.parquet(
        f"{sf}/events.parquet")
    batch = catalog.q_alert_sliding(spark, sf)
    rows = sorted(tuple(r) for r in batch.collect())
    assert len(rows) == 4 and {r[2] - r[1] for r in batch.select("mid", "window_start", "window_end").collect()} == {86_400_000}
    assert sorted(tuple(r) for r in twins.alert_sliding_stream(spark, sf).select(*batch.columns).collect()) == rows
    assert catalog.q_alert_per_minute(spark, sf).count() == 1
    kept = catalog.q_alert_throttle_60s(spark, sf)
    assert kept.count() == 1 == twins.alert_throttle_stream(spark, sf).count()
    assert catalog.q_alert_days(spark, sf).count() == 0  # windows of 8 hours, as its own SQL has them


def test_pane_stream_keeps_no_row_per_window(spark, scratch):
    """A pane goes to a few groups of windows, not to each of 24 windows; null accounts, items, types
    and devices count as in batch."""
    import json
    import random

    from shoplens.sources import streams
    from shoplens.streaming import alerts as alert_stream
    from tests.conftest import write_lines

    rnd, hour, base = random.Random(3), 3_600_000, 1_700_006_400_000
    rows = [(rnd.choice(["m", "k", None]), rnd.choice(["a", "b", "c", "d", None]), rnd.choice(["coupon", "coupon", "coupon", "view", None]),
             rnd.choice(["1", "2", None]), base + rnd.randrange(90 * hour)) for _ in range(60)]
    rows.append(("k", "a", "clickItem", "1", base + 20 * hour))
    path = scratch("groups")
    lines = [json.dumps(dict(zip(("mid", "uid", "evid", "itemid", "ts"), r))) for r in [*rows, ("z", "1", "view", "1", base + 150 * hour)]]
    write_lines(f"{path}/in", lines, "a.json")
    q = alert_stream.start_final(streams.json_lines_stream(spark, f"{path}/in", 1), f"{path}/out", f"{path}/ckpt",
                                 length="24 hours", slide="1 hour", watermark="1 minute", panes=True, state_partitions=2)
    q.awaitTermination()
    assert q.exception() is None
    held = [[s["numRowsUpdated"] for s in p["stateOperators"]] for p in q.recentProgress]
    assert max(map(sum, held)) <= len(rows) * (alerts.GROUP_SHARE + 2)
    kept = ev(spark, rows)
    columns = ["mid", "window_start", "window_end", "ts", "n_uids", "uids", "item_ids", "events", "n_events"]
    want = sorted(map(str, map(tuple, _direct(kept, "24 hours", "1 hour", 3).select(*columns).collect())))
    got = sorted(map(str, map(tuple, spark.read.parquet(f"{path}/out").select(*columns).collect())))
    assert got == want and len(got) > 24
