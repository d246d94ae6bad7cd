import json
import time

from shoplens.functions.decode import text_value
from shoplens.operators import gmv, sales
from shoplens.sources import streams
from shoplens.streaming import gmv as gmv_stream
from tests.conftest import write_lines
from tests.test_decode import envelope


def order(i, amount, ct="2020-06-20 16:12:39"):
    return {"id": str(i), "user_id": "1", "order_status": "1001", "total_amount": str(amount), "create_time": ct}


def _run(spark, src, table, ckpt, envelope_mode=False):
    q = gmv_stream.start(streams.json_lines_stream(spark, src, 1), table, ckpt, envelope=envelope_mode)
    q.awaitTermination()
    assert q.exception() is None


def test_order_table_stream_newest_wins(spark, scratch):
    root = scratch("gmv")
    write_lines(f"{root}/in", [json.dumps(order(1, "53087.0")), json.dumps(order(2, "53087.0"))], "a.json")
    _run(spark, f"{root}/in", f"{root}/t", f"{root}/c")
    time.sleep(0.05)
    # order 2 re-sent with a new amount; order 3 on the next day
    write_lines(f"{root}/in", [json.dumps(order(2, "100.0")),
                               json.dumps(order(3, "7.5", "2020-06-21 01:00:00"))], "b.json")
    _run(spark, f"{root}/in", f"{root}/t", f"{root}/c")
    table = gmv_stream.read(spark, f"{root}/t")
    assert sorted(tuple(r) for r in gmv.gmv_total(table).collect()) == [
        ("2020-06-20", 53187.0), ("2020-06-21", 7.5)]
    assert sorted(tuple(r) for r in gmv.gmv_hours(table).collect()) == [
        ("2020-06-20", "16", 53187.0), ("2020-06-21", "01", 7.5)]


def test_order_table_from_binlog_envelopes(spark, scratch):
    root = scratch("gmv-env")
    write_lines(f"{root}/in", [envelope([order(5, "1.5"), order(6, "2.5")])], "a.json")
    _run(spark, f"{root}/in", f"{root}/t", f"{root}/c", envelope_mode=True)
    table = gmv_stream.read(spark, f"{root}/t")
    assert [tuple(r) for r in gmv.gmv_total(table).collect()] == [("2020-06-20", 4.0)]


def test_value_projection_and_keyed_dedup(spark):
    df = spark.createDataFrame([(b"{}", 1)], "value binary, k int")
    assert text_value(df).columns == ["value"] and text_value(df).first().value == "{}"
    rows = spark.createDataFrame([("1", "b", 2), ("1", "a", 1), ("2", "c", 0)],
                                 "order_detail_id string, v string, n long")
    assert sorted(tuple(r) for r in sales.dedup_by_id(rows).collect()) == [("1", "a", 1), ("2", "c", 0)]
    assert sorted(tuple(r) for r in sales.dedup_by_id(rows, order="n").collect()) == [("1", "b", 2), ("2", "c", 0)]


def test_compact_keeps_newest_rows(spark, scratch):
    from shoplens import apps

    root = scratch("gmv-compact")
    write_lines(f"{root}/in", [json.dumps(order(1, "5.0")), json.dumps(order(2, "1.0"))], "a.json")
    _run(spark, f"{root}/in", f"{root}/t", f"{root}/c")
    time.sleep(0.05)
    write_lines(f"{root}/in", [json.dumps(order(2, "3.0"))], "b.json")
    _run(spark, f"{root}/in", f"{root}/t", f"{root}/c")
    out = apps.main(["compact", "--table", f"{root}/t", "--out", f"{root}/t2", "--key", "id",
                     "--partition", "part"], spark)
    assert out["compacted"]
    want = sorted((r.id, r.total_amount) for r in gmv_stream.read(spark, f"{root}/t").collect())
    got = sorted((r.id, r.total_amount) for r in gmv_stream.read(spark, f"{root}/t2").collect())
    assert got == want == [("1", 5.0), ("2", 3.0)]


def test_last_write_of_a_key_in_one_batch_wins(spark, scratch):
    """Two versions of an order in one micro-batch, in both orders, in one and in two files,
    with 1 and 8 shuffle partitions."""
    import json
    import os

    from shoplens.sources import streams
    from shoplens.streaming import gmv as gmv_stream
    from tests.conftest import write_lines

    def line(amount):
        return json.dumps({"id": "1", "user_id": "u", "total_amount": str(amount), "create_time": "2021-01-01 10:00:00"})

    before = spark.conf.get("spark.sql.shuffle.partitions")
    filler = [json.dumps({"id": str(k), "total_amount": "1", "create_time": "2021-01-01 10:00:00"}) for k in range(2, 30)]
    try:
        for parts in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            for k, (first, last) in enumerate(((10, 20), (20, 10))):
                for files in (1, 2):
                    root = scratch(f"lww-{parts}-{k}-{files}")
                    if files == 1:
                        write_lines(f"{root}/in", [line(first), *filler, line(last)], "a.json")
                    else:  # the older file has the later name
                        write_lines(f"{root}/in", [line(first), *filler], "z.json")
                        write_lines(f"{root}/in", [line(last)], "a.json")
                        os.utime(f"{root}/in/z.json", (1_700_000_000, 1_700_000_000))
                    q = gmv_stream.start(streams.json_lines_stream(spark, f"{root}/in"), f"{root}/t", f"{root}/c")
                    q.awaitTermination()
                    row = gmv_stream.read(spark, f"{root}/t").where("id = '1'").first()
                    assert row.total_amount == last, (parts, k, files)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_resent_line_keeps_the_newest_order_version(spark):
    from shoplens.operators import sales

    df = spark.createDataFrame([("7", "1001", 1), ("7", "1002", 2), ("8", "5", 9), ("8", "4", 9)],
                               "order_detail_id string, order_status string, pos int")
    for parts in (1, 8):
        got = {r.order_detail_id: r.order_status for r in sales.dedup_by_id(df.repartition(parts), order="pos").collect()}
        assert got == {"7": "1002", "8": "5"}


def _files(path):
    import os

    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")}


def test_merge_rewrites_only_the_folders_a_batch_touches(spark, scratch):
    from pyspark.sql import functions as F

    from shoplens.functions.decode import decode_order
    from shoplens.sources import store

    root = scratch("gmv-merge")
    merged, appended = gmv_stream.batch_writer(f"{root}/m", merge=True), gmv_stream.batch_writer(f"{root}/a")

    def send(batch_id, *orders):
        lines = spark.createDataFrame([(json.dumps(o),) for o in orders], "value string")
        for write in (merged, appended):
            write(decode_order(lines), batch_id)

    def same():
        a, m = (sorted(tuple(r) for r in gmv_stream.read(spark, f"{root}/{t}").collect()) for t in "am")
        assert a == m
        return len(m)

    day2, day3 = "2020-06-21 01:00:00", "2020-06-22 01:00:00"
    send(0, order(1, 1), order(2, 2), order(3, 3, day2))
    send(1, order(1, 10), order(1, 11), order(4, 4))  # the later one of a batch wins
    before = _files(f"{root}/m")
    for _ in range(2):  # the second time as a replay
        send(2, order(5, 5), order(2, 20))
        assert same() == 5
    after = _files(f"{root}/m")
    untouched = {f: t for f, t in before.items() if "2020-06-21" in f}
    assert untouched and untouched.items() <= after.items()
    assert not any("2020-06-22" in f for f in after)
    send(3, order(6, 6, day3))
    for k in range(4, 8):
        send(k, order(1, k), order(7, k, day3))
    assert same() == 7
    folders = {f.split("/part=")[1].split("/part-")[0] for f in _files(f"{root}/m")}
    assert folders == {"2020-06-20/batch=6", "2020-06-20/batch=7", "2020-06-21/batch=0", "2020-06-22/batch=6", "2020-06-22/batch=7"}
    stored = store.read_rows(spark, f"{root}/m", "part").where(F.col("batch") == 7)
    assert stored.groupBy("id").count().where("count > 1").count() == 0
    empty = decode_order(spark.createDataFrame([], "value string"))
    merged(empty, 8)
    assert same() == 7
