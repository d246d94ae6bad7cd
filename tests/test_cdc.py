import json

from shoplens.operators import cdc

SCHEMA = ("table string, entryType string, eventType string, "
          "rows array<struct<afterColumns:array<struct<name:string,value:string>>>>")


def rows(*pairs_list):
    return [([{"name": k, "value": v} for k, v in pairs],) for pairs in pairs_list]


def test_route_inserts_of_three_tables_only(spark):
    data = [
        ("order_info", "ROWDATA", "INSERT", [{"afterColumns": [{"name": "id", "value": "1"},
                                                               {"name": "total_amount", "value": "53087.0"}]},
                                             {"afterColumns": [{"name": "id", "value": "2"}]}]),
        ("order_detail", "ROWDATA", "INSERT", [{"afterColumns": [{"name": "id", "value": "1002"},
                                                                 {"name": "order_id", "value": "1"}]}]),
        ("user_info", "ROWDATA", "INSERT", [{"afterColumns": [{"name": "id", "value": "111"},
                                                              {"name": "gender", "value": ""}]}]),
        ("order_info", "ROWDATA", "UPDATE", [{"afterColumns": [{"name": "id", "value": "1"}]}]),
        ("order_info", "ROWDATA", "DELETE", [{"afterColumns": [{"name": "id", "value": "1"}]}]),
        ("sku_info", "ROWDATA", "INSERT", [{"afterColumns": [{"name": "id", "value": "5"}]}]),
        ("order_info", "TRANSACTIONEND", None, None),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    out = sorted((r.topic, r.value) for r in cdc.route(df).collect())
    expected = [
        (cdc.TOPIC_ORDER, {"id": "1", "total_amount": "53087.0"}),
        (cdc.TOPIC_ORDER, {"id": "2"}),
        (cdc.TOPIC_ORDER_DETAIL, {"id": "1002", "order_id": "1"}),
        (cdc.TOPIC_USER_INFO, {"id": "111", "gender": ""}),
    ]
    key = lambda tv: (tv[0], json.dumps(tv[1], sort_keys=True))
    assert sorted(((t, json.loads(v)) for t, v in out), key=key) == sorted(expected, key=key)
    flat = cdc.flatten(df).collect()
    assert len(flat) == 7  # every ROWDATA row, whatever table or type


def test_custom_routes(spark):
    data = [("user_info", "ROWDATA", "INSERT", [{"afterColumns": [{"name": "id", "value": "1"}]}]),
            ("order_info", "ROWDATA", "INSERT", [{"afterColumns": [{"name": "id", "value": "2"}]}])]
    df = spark.createDataFrame(data, SCHEMA)
    out = cdc.route(df, routes={"user_info": "USERS_ONLY"}).collect()
    assert [(r.topic, r.value) for r in out] == [("USERS_ONLY", '{"id":"1"}')]


def test_routed_stream_writes_compressed_feeds(spark):
    import glob

    from shoplens.plans import catalog, twins
    from shoplens.session import checkpoint_root

    sf = "/root/testdata/sf0.001"
    seen = set(glob.glob(f"{checkpoint_root(spark)}/twin-cdc-*"))
    got = sorted(tuple(r) for r in twins.cdc_route_stream(spark, sf).collect())
    assert got == sorted(tuple(r) for r in catalog.q_cdc_route(spark, sf).collect())
    root, = set(glob.glob(f"{checkpoint_root(spark)}/twin-cdc-*")) - seen
    files = glob.glob(f"{root}/feed/part-*") + glob.glob(f"{root}/out/topic=*/part-*")
    assert files and all(f.endswith(".txt.gz") for f in files)
