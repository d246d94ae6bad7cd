import time

from pyspark.sql import functions as F

from shoplens.functions.decode import decode_startup
from shoplens.operators import dau
from shoplens.plans import api
from shoplens.sources import streams
from shoplens.streaming import dau_state, words
from tests.conftest import write_lines
from tests.test_decode import F1, startup_json


def test_state_variant_of_streaming_dau(spark, scratch):
    root = scratch("dau-state")
    write_lines(f"{root}/in", [startup_json(*r) for r in F1], "a.json")

    def run():
        q = dau_state.start(streams.json_lines_stream(spark, f"{root}/in", 1), f"{root}/t", f"{root}/c",
                            "Asia/Shanghai", state_partitions=2)
        q.awaitTermination()
        assert q.exception() is None

    run()
    time.sleep(0.05)
    # the same rows, a new device, and an earlier row of a known one
    late = [startup_json("mid_1", "7", 1638186139000), startup_json("mid_236", "9", 1638186130000), "not json"]
    write_lines(f"{root}/in", [startup_json(*r) for r in F1] + late, "b.json")
    run()
    got = dau_state.read(spark, f"{root}/t", ["2021-11-29"])
    assert sorted(r.mid for r in got.collect()) == sorted([m for m, _, _ in F1] + ["mid_1"])
    assert got.where("mid = 'mid_236'").first().ts == 1638186130000  # the earliest, however late it came


def test_word_window(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:01", "a b a"), ("2024-01-01 00:00:02", "b"),
                                ("2024-01-01 00:00:04", "a")], "t string, value string")
    df = df.withColumn("t", F.to_timestamp("t"))
    got = sorted((r.word, r.n) for r in words.word_counts(df, "3 seconds", "t").collect())
    assert got == [("a", 1), ("a", 2), ("b", 2)]


def test_single_day_api(spark):
    logs = decode_startup(spark.createDataFrame([(startup_json(*r),) for r in F1], "value string"), "Asia/Shanghai")
    first = dau.first_seen(logs)
    assert api.dau_total(first, "2021-11-29").first().dau == 5
    assert api.dau_total(first, "2021-11-30").first().dau == 0
    assert [tuple(r) for r in api.dau_hours(first, "2021-11-29").collect()] == [("19", 5)]
    orders = spark.createDataFrame(
        [("1", 10.0, "2021-11-29", "19"), ("2", 5.0, "2021-11-28", "19"), ("3", 1.0, "2021-11-28", "07")],
        "id string, total_amount double, create_date string, create_hour string")
    assert [tuple(r) for r in api.gmv_hours(orders, "2021-11-28").orderBy("create_hour").collect()] == [
        ("07", 1.0), ("19", 5.0)]
    hours = sorted(tuple(r) for r in api.realtime_hours("order_amount", first, orders, "2021-11-29").collect())
    assert hours == [("today", "19", 10.0), ("yesterday", "07", 1.0), ("yesterday", "19", 5.0)]
    assert sorted(tuple(r) for r in api.realtime_hours("dau", first, orders, "2021-11-29").collect()) == [
        ("today", "19", 5.0)]
    assert api.realtime_hours("other", first, orders, "2021-11-29").count() == 0
