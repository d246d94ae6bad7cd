import json

from pyspark.sql import functions as F

from shoplens.functions import decode
from shoplens.operators import cdc

# F-1 start-up log rows (mid, uid, ts) with their Asia/Shanghai date and hour
F1 = [
    ("mid_236", "336", 1638186135913),
    ("mid_428", "368", 1638186136624),
    ("mid_395", "336", 1638186136825),
    ("mid_50", "346", 1638186137036),
    ("mid_748", "41", 1638186137237),
]


def startup_json(mid, uid, ts, area="beijing"):
    return json.dumps({"area": area, "uid": uid, "os": "ios", "ch": "appstore", "appid": "shop",
                       "mid": mid, "type": "startup", "vs": "1.1.2", "ts": ts})


def test_startup_decode_in_zone(spark):
    lines = spark.createDataFrame([(startup_json(*r),) for r in F1], "value string")
    out = decode.decode_startup(lines, zone="Asia/Shanghai").collect()
    assert {(r.mid, r.logDate, r.logHour) for r in out} == {(m, "2021-11-29", "19") for m, _, _ in F1}
    utc = decode.decode_startup(lines, zone="UTC").collect()
    assert {r.logHour for r in utc} == {"11"}


def test_session_zone_does_not_change_dates(spark):
    lines = spark.createDataFrame([(startup_json(*F1[0]),)], "value string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        r = decode.decode_startup(lines, zone="Asia/Shanghai").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (r.logDate, r.logHour) == ("2021-11-29", "19")


def test_event_numbers_kept_as_text(spark):
    raw = json.dumps({"mid": "mid_108", "uid": "416", "evid": "coupon", "itemid": 9, "pgid": 15,
                      "npgid": 30, "ts": 1638432453698})
    r = decode.decode_event(spark.createDataFrame([(raw,)], "value string")).first()
    assert (r.itemid, r.pgid, r.npgid) == ("9", "15", "30")


ORDER = {"id": "1", "user_id": "111", "order_status": "1001", "total_amount": "53087.0",
         "create_time": "2020-06-20 16:12:39", "consignee": "", "province_id": "9"}


def test_order_decode_quoted_numbers_and_empty_strings(spark):
    bad = dict(ORDER, id="2", total_amount="n/a", create_time=None)
    df = spark.createDataFrame([(json.dumps(ORDER),), (json.dumps(bad),)], "value string")
    rows = {r.id: r for r in decode.decode_order(df).collect()}
    assert rows["1"].total_amount == 53087.0
    assert (rows["1"].create_date, rows["1"].create_hour) == ("2020-06-20", "16")
    assert rows["1"].consignee is None
    assert rows["2"].total_amount is None and rows["2"].create_date is None


def envelope(data, typ="INSERT", is_ddl=False):
    return json.dumps({
        "data": data, "database": "shop", "table": "order_info", "type": typ, "es": 1, "ts": 2,
        "id": 3, "isDdl": is_ddl, "old": None, "sql": "",
        "mysqlType": {"id": "bigint", "total_amount": "decimal(10,2)"},
        "sqlType": {"id": -5, "total_amount": 3},
    })


def test_create_time_without_time_part(spark):
    from shoplens.functions.timefmt import create_date, create_hour

    df = spark.createDataFrame([("2020-06-20",), ("2020-06-20 16:12:39",), (None,), ("",)], "ct string")
    got = [tuple(r) for r in df.select(create_date("ct"), create_hour("ct")).collect()]
    assert got == [("2020-06-20", None), ("2020-06-20", "16"), (None, None), ("", None)]


def test_binlog_envelope_every_element(spark):
    one = dict(ORDER, id="3", user_id="204")
    two = dict(ORDER, id="4", user_id="205", create_time="2020-06-21 01:02:03")
    df = spark.createDataFrame([(envelope([one, two]),)], "value string")
    rows = sorted(decode.decode_binlog(df).collect(), key=lambda r: r.id)
    assert [(r.id, r.user_id, r.create_date, r.create_hour, r.total_amount) for r in rows] == [
        ("3", "204", "2020-06-20", "16", 53087.0), ("4", "205", "2020-06-21", "01", 53087.0)]
    first = decode.decode_binlog(df, first_only=True).collect()
    assert [r.id for r in first] == ["3"]


def test_binlog_filter_options(spark):
    df = spark.createDataFrame([(envelope([ORDER], typ="UPDATE"),), (envelope([ORDER], is_ddl=True),),
                                (envelope([ORDER]),)], "value string")
    assert cdc.orders_from_binlog(df).count() == 3
    assert cdc.orders_from_binlog(df, only_inserts=True).count() == 1


def test_flatten_columns_and_row_json(spark):
    df = spark.createDataFrame([([("id", "1"), ("name", "a\"b")],)],
                               "cols array<struct<name:string,value:string>>")
    v = df.select(decode.flatten_columns(F.col("cols")).alias("v")).first().v
    assert json.loads(v) == {"id": "1", "name": "a\"b"}
    j = decode.to_json_row(spark.createDataFrame([(1, "x")], "a int, b string")).first().value
    assert json.loads(j) == {"a": 1, "b": "x"}


def test_doc_id(spark):
    df = spark.createDataFrame([("mid_108", 1638432453698), ("mid_386", 1638467970000)], "mid string, ts long")
    ids = [r.d for r in df.select(decode.alert_doc_id("mid", "ts").alias("d")).collect()]
    assert ids == ["mid_10827307207", "mid_38627307799"]
