import random

from pyspark.sql import functions as F

from shoplens.operators import throttle

COLS = "mid string, window_start long, window_end long, ts long, doc_id string"


def brute(rows, gap=60, seed=None):
    out, last = [], dict(seed or {})
    for r in sorted(rows, key=lambda r: (r[0], r[3], r[1])):
        s = r[3] // 1000
        if r[0] not in last or s - last[r[0]] >= gap:
            out.append(r)
            last[r[0]] = s
    return sorted(out)


def test_chunked_throttle_matches_brute_force_across_midnights(spark):
    rnd = random.Random(7)
    day = 86_400_000
    rows = []
    for mid in ("a", "b", "c"):
        t = 19_000 * day - 200_000
        for i in range(400):
            t += rnd.choice([1_000, 5_000, 20_000, 59_000, 60_000, 61_000, 3_600_000, 86_000_000])
            rows.append((mid, i, i + 1, t, f"{mid}{i}"))
    df = spark.createDataFrame(rows, COLS)
    want = brute(rows)
    got = sorted(tuple(r) for r in throttle.throttle(df, 60, chunk_seconds=3_600).collect())
    assert got == want
    got_day = sorted(tuple(r) for r in throttle.throttle(df, 60).collect())
    assert got_day == want


def test_chunked_throttle_with_seed(spark):
    t0 = 1_638_467_970_000
    rows = [("a", 0, 1, t0 + 30_000, "x"), ("a", 1, 2, t0 + 61_000, "x"), ("b", 0, 1, t0, "y")]
    seed = spark.createDataFrame([("a", t0)], "mid string, last_ts long")
    got = sorted((r.mid, r.ts) for r in throttle.throttle(spark.createDataFrame(rows, COLS), 60, seed).collect())
    assert got == [("a", t0 + 61_000), ("b", t0)]


def test_null_device_is_a_device_like_any_other(spark):
    t0 = 1_638_467_970_000
    rows = [(None, 0, 1, t0, "x"), (None, 1, 2, t0 + 30_000, "y"), (None, 2, 3, t0 + 60_000, "z"), ("a", 0, 1, t0, "w")]
    df = spark.createDataFrame(rows, COLS)
    got = sorted((r.doc_id, r.ts) for r in throttle.throttle(df, 60).collect())
    assert got == [("w", t0), ("x", t0), ("z", t0 + 60_000)]
    seed = spark.createDataFrame([(None, t0)], "mid string, last_ts long")
    assert sorted(r.doc_id for r in throttle.throttle(df, 60, seed).collect()) == ["w", "z"]


def test_streaming_throttle_does_not_depend_on_arrow_chunks(spark, scratch):
    from shoplens.streaming import alerts as stream

    t0 = 1_638_467_970_000
    rnd = random.Random(3)
    rows = [("m", t0 + 1000 * s) for s in (120, 60, 0)] + [(f"m{k % 3}", t0 + 1000 * rnd.randrange(4000)) for k in range(300)]
    rows = [(m, k, k + 1, ts, f"{m}{k}", 3, "a", "b", "coupon x3", 3) for k, (m, ts) in enumerate(rows)]
    want = {r[4] for r in brute([(r[0], r[1], r[2], r[3], r[4]) for r in rows])}
    df = spark.createDataFrame(rows, stream.ALERT_SCHEMA).withColumn(stream.DAY, stream.day_of("window_start"))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for limit in (1, 10_000):
            spark.conf.set(key, str(limit))
            root = scratch("throttle-chunks")
            df.orderBy(F.rand(limit)).coalesce(1).write.parquet(f"{root}/in")
            q = stream.start_throttle(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", state_partitions=2)
            q.awaitTermination()
            assert {r.doc_id for r in stream.read_kept(spark, f"{root}/out").collect()} == want
    finally:
        spark.conf.set(key, before)


def test_ten_years_of_one_device_equal_the_fold(spark):
    """An alert every 37 s on average for some days of each year: chunks of an hour make a deep tree."""
    rnd = random.Random(11)
    rows, t = [], 1_400_000_000_000
    for year in range(10):
        for _ in range(300):
            t += rnd.choice([3_000, 20_000, 59_000, 61_000, 3_599_000, 43_000_000])
            rows.append(("m", t, t + 1, t, f"{t}"))
        t += 300 * 86_400_000
    df = spark.createDataFrame(rows, COLS)
    want = brute(rows)
    for chunk in (3_600, 86_400):
        assert sorted(tuple(r) for r in throttle.throttle(df, 60, chunk_seconds=chunk).collect()) == want


def test_no_array_of_all_chunks_of_a_device(spark):
    """A device with alerts on 3,000 days: a node holds FAN children at most, a map few pieces."""
    day = 86_400
    rows = [("+m", k, [k * day, k * day + 30, k * day + day - 1]) for k in range(3_000)]
    maps = spark.createDataFrame(rows, "device string, at long, secs array<long>").select(
        "device", "at", throttle.chunk_map("secs", F.col("at") * day + 60, 60).alias("map"))
    first = throttle._up(maps, 0)
    assert first.agg(F.max(F.size("children")), F.count("*")).first()[:] == (throttle.FAN, 12)
    composed = first.select(throttle._node_map("children").alias("map"))
    assert composed.agg(F.max(F.size("map"))).first()[0] <= 61
    assert throttle.entries(maps).count() == 3_000


def test_maps_compose_like_running_one_after_the_other(spark):
    rnd = random.Random(2)
    rows = []
    for k in range(40):
        a = sorted(rnd.sample(range(0, 200), rnd.randrange(1, 30)))
        b = sorted(rnd.sample(range(200, 400), rnd.randrange(1, 30)))
        rows.append((a, b, rnd.choice([-1000, rnd.randrange(-70, 0)])))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>, entry long")
    m = [throttle.chunk_map(c, F.lit(lo + 60), 60) for c, lo in (("a", 0), ("b", 200))]
    got = [r[0] for r in df.select(throttle.passed(F.col("entry"), throttle.composed(*m))).collect()]
    want = []
    for a, b, last in rows:
        for s in a + b:
            last = s if s - last >= 60 else last
        want.append(last)
    assert got == want


def _alerts(spark, rows):
    """Stream input rows of (mid, ts)."""
    from shoplens.streaming import alerts as stream

    full = [(m, ts - 1000, ts + 1000, ts, f"{m}{ts}", 3, "a", "b", "coupon x3", 3) for m, ts in rows]
    return spark.createDataFrame(full, stream.ALERT_SCHEMA).withColumn(stream.DAY, stream.day_of("window_start"))


def test_throttle_batches_read_only_the_days_they_can_touch(spark, scratch):
    from shoplens.streaming import alerts as stream

    root, day = scratch("throttle-days"), 86_400_000
    t0 = 19_700 * day
    write = stream.throttle_writer(f"{root}/out", 60)
    write(_alerts(spark, [("a", t0), ("silent", t0 + 5)]), 0)
    write(_alerts(spark, [("a", t0 + 9 * day), ("b", t0 + 9 * day + 30_000)]), 1)
    seed = stream.last_kept(spark, f"{root}/out", t0 + 9 * day, 7)
    assert {r.mid for r in seed.collect()} == {"a", "b"}  # nothing of the device silent since day 0
    assert "PartitionFilters: [isnotnull(day" in seed._jdf.queryExecution().toString()
    write(_alerts(spark, [("a", t0 + 8 * day), ("b", t0 + 9 * day + 89_000), ("b", t0 + 9 * day + 90_000)]), 2)
    write(_alerts(spark, [("a", t0 + 8 * day), ("b", t0 + 9 * day + 89_000), ("b", t0 + 9 * day + 90_000)]), 2)  # replayed
    got = sorted((r.mid, r.ts - t0) for r in stream.read_kept(spark, f"{root}/out").collect())
    # a: the late alert of day 8 comes after the one kept on day 9, so it is dropped
    assert got == [("a", 0), ("a", 9 * day), ("b", 9 * day + 30_000), ("b", 9 * day + 90_000), ("silent", 5)]


def test_a_million_alerts_of_one_device(spark, scratch):
    from shoplens.streaming import alerts as stream

    root, t0 = scratch("throttle-million"), 1_638_467_970_000
    df = spark.range(1_000_000).selectExpr(
        "'m' as mid", f"{t0} + id * 7000 as ts").selectExpr(
        "mid", "ts - 1000 as window_start", "ts + 1000 as window_end", "ts", "cast(ts as string) as doc_id", "3L as n_uids",
        "'a' as uids", "'b' as item_ids", "'c' as events", "3L as n_events")
    df.withColumn(stream.DAY, stream.day_of("window_start")).repartition(4).write.parquet(f"{root}/in")
    stream.start_throttle(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt").awaitTermination()
    kept = stream.read_kept(spark, f"{root}/out")
    # every 9th alert: 63 s is the first distance of 60 s or more
    assert kept.agg(F.count("*"), F.min("ts"), F.max(F.col("ts") - t0)).first()[:] == (111_112, t0, 111_111 * 63_000)
