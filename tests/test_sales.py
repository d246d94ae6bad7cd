import json
import time

from pyspark.sql import functions as F

from shoplens.functions.decode import decode_order, decode_order_detail, decode_user
from shoplens.operators import gmv, sales
from shoplens.plans import api
from shoplens.streaming import sales as sale_stream
from tests.conftest import write_lines

ORDERS = [
    {"id": "1", "user_id": "111", "order_status": "1001", "total_amount": "53087.0",
     "create_time": "2020-06-20 16:12:39", "consignee": ""},
    {"id": "2", "user_id": "222", "order_status": "1002", "total_amount": "53087.0",
     "create_time": "2020-06-20 16:12:39", "consignee": ""},
]
LINES = [
    {"id": "1002", "order_id": "1", "sku_id": "5", "sku_name": "phone", "order_price": "244.0", "sku_num": "2"},
    {"id": "1002", "order_id": "3", "sku_id": "5", "sku_name": "phone", "order_price": "244.0", "sku_num": "2"},
]


def df_of(spark, recs):
    return spark.createDataFrame([(json.dumps(r),) for r in recs], "value string")


def orders(spark, recs=ORDERS):
    return decode_order(df_of(spark, recs))


def lines(spark, recs=LINES):
    return decode_order_detail(df_of(spark, recs))


def users(spark, recs=()):
    return decode_user(spark.createDataFrame([(json.dumps(r),) for r in recs] or [("{}",)], "value string")) \
        .where("id is not null")


def test_full_outer_status(spark):
    out = sorted((r.order_id, r.match) for r in sales.order_line_status(orders(spark), lines(spark)).collect())
    assert out == [("1", "matched"), ("2", "order_only"), ("3", "detail_only")]


def test_sale_detail_unknown_user(spark):
    rows = sales.sale_detail(orders(spark), lines(spark), users(spark)).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.order_detail_id, r.order_id, r.user_id, r.sku_id, r.sku_price, r.dt) == (
        "1002", "1", "111", "5", 244.0, "2020-06-20")
    assert (r.user_age, r.user_gender, r.user_level) == (0, None, None)


def test_sale_detail_known_user_age(spark):
    u = users(spark, [{"id": "111", "login_name": "x", "user_level": "2", "birthday": "2000-06-21", "gender": "F"}])
    r = sales.sale_detail(orders(spark), lines(spark), u).first()
    # 7304 days // 365 = 20: whole 365-day years, leap days ignored (the original arithmetic)
    assert (r.user_age, r.user_gender, r.user_level) == (20, "F", "2")
    r2 = sales.sale_detail(orders(spark), lines(spark), u, as_of="2030-06-21").first()
    assert r2.user_age == 30


def test_malformed_birthday_is_age_zero(spark):
    u = users(spark, [{"id": "111", "login_name": "x", "user_level": "2", "birthday": "n/a", "gender": "F"}])
    r = sales.sale_detail(orders(spark), lines(spark), u).first()
    assert (r.user_age, r.user_gender) == (0, "F")


def test_gmv(spark):
    o = orders(spark)
    assert [tuple(x) for x in gmv.gmv_total(o).collect()] == [("2020-06-20", 106174.0)]
    assert [tuple(x) for x in gmv.gmv_hours(o).collect()] == [("2020-06-20", "16", 106174.0)]
    assert api.gmv_total(o, "2020-06-21").first().order_amount is None
    tot = {r.id: r.value for r in api.realtime_total(spark, o.limit(0).select(F.lit("2020-06-20").alias("logDate")),
                                                      o, "2020-06-20").collect()}
    assert tot == {"dau": 0.0, "new_mid": 233.0, "order_amount": 106174.0}


def test_latest_users(spark):
    df = spark.createDataFrame([("1", "a", 0), ("1", "b", 2), ("2", "c", 1)], "id string, user_level string, offset long")
    assert sorted(tuple(r) for r in sales.latest_users(df).collect()) == [("1", "b"), ("2", "c")]


def _with_ts(recs, ts):
    return [dict(r, ts=ts) for r in recs]


def _run_join(spark, root, feeds):
    """Feed (orders, lines) files in the given order; one restart per step."""
    from pyspark.sql import types as T
    from shoplens.sources import schemas, streams
    from shoplens.plans.twins import _typed_with_ts

    order_schema = T.StructType(schemas.ORDER_INFO_RAW.fields + [T.StructField("ts", T.LongType())])
    line_schema = T.StructType(schemas.ORDER_DETAIL.fields + [T.StructField("ts", T.LongType())])
    for step, (o_recs, l_recs) in enumerate(feeds):
        write_lines(f"{root}/o", [json.dumps(r) for r in o_recs] or ["{}"], f"{step}.json")
        write_lines(f"{root}/l", [json.dumps(r) for r in l_recs] or ["{}"], f"{step}.json")
        time.sleep(0.05)
        os_ = (streams.json_lines_stream(spark, f"{root}/o").select(F.from_json("value", order_schema).alias("r"))
               .select("r.*").where("id is not null"))
        ls_ = (streams.json_lines_stream(spark, f"{root}/l").select(F.from_json("value", line_schema).alias("r"))
               .select("r.*").where("id is not null"))
        q = sale_stream.start(_typed_with_ts(os_), ls_, users(spark), f"{root}/t", f"{root}/c")
        q.awaitTermination()
        assert q.exception() is None
    out = sale_stream.read(spark, f"{root}/t")
    return [] if out is None else sorted((r.order_id, r.order_detail_id) for r in out.collect())


ORDER3 = {"id": "3", "user_id": "333", "order_status": "1001", "total_amount": "1.0",
          "create_time": "2020-06-20 16:14:18"}
T0 = 1_592_640_759_000


def test_late_join_within_bound(spark, scratch):
    line3 = [LINES[1]]
    # line first, its order 99 s later in a later batch: joined
    got = _run_join(spark, scratch("j1"), [([], _with_ts(line3, T0)), (_with_ts([ORDER3], T0 + 99_000), [])])
    assert got == [("3", "1002")]
    # order first, the line 99 s later: joined
    got = _run_join(spark, scratch("j2"), [(_with_ts([ORDER3], T0), []), ([], _with_ts(line3, T0 + 99_000))])
    assert got == [("3", "1002")]


def test_late_join_beyond_bound(spark, scratch):
    line3 = [LINES[1]]
    got = _run_join(spark, scratch("j3"), [([], _with_ts(line3, T0)), (_with_ts([ORDER3], T0 + 101_000), [])])
    assert got == []
    got = _run_join(spark, scratch("j4"), [(_with_ts([ORDER3], T0), []), ([], _with_ts(line3, T0 + 101_000))])
    assert got == []


def test_stream_sale_detail_equals_batch(spark):
    from shoplens.plans import catalog, twins

    sf = "/root/testdata/sf0.001"
    a = sorted(tuple(r) for r in catalog.q_sale_detail_wide(spark, sf).collect())
    b = sorted(tuple(r) for r in twins.sale_detail_stream(spark, sf).collect())
    assert a == b and len(a) > 0


def test_users_are_found_under_any_number_of_folders(spark, scratch):
    from shoplens.streaming import sales as stream

    path = f"{scratch('users')}/t"
    assert stream.read_users(spark, path, spark.createDataFrame([("1",)], "id string")) is None
    kind = "id string, login_name string"
    stream.users_writer(path, 4)(spark.createDataFrame([(str(k), "old") for k in range(40)], kind), 0)
    stream.users_writer(path, 16)(spark.createDataFrame([(str(k), "new") for k in range(0, 40, 2)], kind), 1)
    want = {str(k): "old" if k % 2 else "new" for k in range(40)}
    assert {r.id: r.login_name for r in stream.read_users(spark, path).collect()} == want
    some = spark.createDataFrame([("2",), ("3",), ("38",), ("none",)], "id string")
    assert {r.id: r.login_name for r in stream.read_users(spark, path, some).collect()} == {k: want[k] for k in ("2", "3", "38")}


def test_pairs_are_written_without_a_shuffle_of_the_lines(spark, scratch):
    """The feeds are compressed, and neither the batch writer nor the reader shuffles whole rows."""
    import glob

    from shoplens.operators import sales
    from shoplens.plans import twins

    root = scratch("lean")
    rows = spark.range(0, 40_000, 1, 4).selectExpr("id", "id * 10 as ts", "cast(null as string) as note")
    files = twins.write_feed(rows, f"{root}/feed", "ts")
    made = glob.glob(f"{root}/feed/part-*")
    assert len(made) == twins.CHUNKS * files and all(f.endswith(".txt.gz") for f in made)
    got = spark.read.json(f"{root}/feed")
    assert got.count() == 40_000 and got.agg(F.sum("id")).first()[0] == sum(range(40_000))

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = spark.createDataFrame(
            [("1", f"1-{k}", "F", "", "u1" if k < 3 else "u9", "s", "n", 1.0, "2020-06-20") for k in range(5)] + [("2", "2-1", "F", "", None, "s", "n", 1.0, "2020-06-20")],
            "order_id string, order_detail_id string, order_status string, create_time string, user_id string, sku_id string, "
            "sku_name string, sku_price double, dt string").repartition("order_id")
        dim = spark.createDataFrame([("u1", "M", "VIP", "1990-01-01"), ("u1", "F", "", "bad"), ("u2", "F", "", "")],
                                    "id string, gender string, user_level string, birthday string")
        by_order, plain = sales.with_users(lines, dim, per="order_id"), sales.with_users(lines, dim)
        assert sorted(map(str, by_order.collect())) == sorted(map(str, plain.collect())) and by_order.count() == 9
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_rare_repeats_resolve_as_all_rows_would(spark, scratch):
    from shoplens.sources import store

    rows = [(f"k{k}", k, 0) for k in range(50)] + [("k3", 100, 1), ("k3", 101, 0), (None, 7, 0), (None, 8, 1)]
    df = spark.createDataFrame(rows, "order_detail_id string, v int, batch long")
    for keys in (store.RARE_KEYS, 0):
        old, store.RARE_KEYS = store.RARE_KEYS, keys
        try:
            got = sorted(map(tuple, store.latest_rare(df, ["order_detail_id"], ["v"]).collect()), key=str)
        finally:
            store.RARE_KEYS = old
        assert got == sorted(map(tuple, store.latest(df, ["order_detail_id"], ["v"]).collect()), key=str) and len(got) == 51


def test_a_line_under_two_orders_is_kept_once_the_newest(spark, scratch):
    from shoplens.sources import store

    root = scratch("twice")
    kind = ("pos struct<order_ms:long,line_ms:long>, order_id string, order_status string, create_time string, dt string, user_id string, "
            "order_detail_id string, sku_id string, sku_name string, sku_price double")

    def pair(order, status, ms):
        return ((ms, ms), order, status, "2020-06-20 00:00:00", "2020-06-20", "u", "d", "s", "n", 1.0)

    pairs = spark.createDataFrame([pair("1", "late", 9), pair("2", "early", 5), pair("1", "late", 9), pair("1", "old", 2)], kind)
    sale_stream.batch_writer(f"{root}/t", users=users(spark))(pairs, 0)
    assert store.read_rows(spark, f"{root}/t", "part").count() == 2
    assert [(r.order_id, r.order_status) for r in sale_stream.read(spark, f"{root}/t").collect()] == [("1", "late")]


def test_micro_batches_do_not_grow_with_the_feed(spark, scratch, monkeypatch):
    """A feed is cut into more chunks of time, not larger ones; both sides of a join at the same times."""
    import glob
    import os

    from shoplens.plans import twins

    sf = "/root/testdata/sf0.001"
    whole = sorted(tuple(r) for r in twins.late_join_stream(spark, sf).collect())
    monkeypatch.setattr(twins, "CHUNK_ROWS", 1_000)
    # most rows in a tenth of the time, and none in some of the rest
    rows = spark.range(0, 20_000, 1, 4).selectExpr("id", "if(id < 15000, id, 100000 + 10 * id) as ts").repartition(4)
    at = twins.edges(rows, "ts")
    files = twins.write_feed(rows, f"{(root := scratch('grown'))}/feed", "ts", at=at)
    made = sorted(glob.glob(f"{root}/feed/part-*"), key=os.path.getmtime)
    assert len(at) == 19 and len(made) == 20 * files
    spans = []
    for k in range(20):
        lo, hi, n = spark.read.schema("ts long").json(made[k * files:(k + 1) * files]).selectExpr("min(ts)", "max(ts)", "count(*)").first()
        assert 0 < n < 1_200 and (not spans or lo > spans[-1])
        spans.append(hi)
    one = spark.range(10).selectExpr("id", "cast(7 as long) as ts")  # all but one chunk of it are empty
    files = twins.write_feed(one, f"{root}/one", "ts", at=[3, 5, 9])
    assert len(glob.glob(f"{root}/one/part-*")) == 4 * files and spark.read.json(f"{root}/one").count() == 10

    twins.BATCH_SECONDS.clear()
    assert sorted(tuple(r) for r in twins.late_join_stream(spark, sf).collect()) == whole
    assert len(twins.BATCH_SECONDS) > twins.CHUNKS
