"""Explicit record schemas (nothing is inferred).

Numbers that arrive quoted in the change feed (``"53087.0"``) are declared as
strings and converted with ``try_cast`` after decoding, because ``from_json``
returns null for a quoted number read as a double.
"""

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, S, True) for n in names]


# start-up log: ts is epoch milliseconds; logDate / logHour are derived
STARTUP_LOG = T.StructType(
    _strings("mid", "uid", "appid", "area", "os", "ch", "type", "vs")
    + [T.StructField("ts", L, True)]
)
STARTUP_COLUMNS = ["mid", "uid", "appid", "area", "os", "ch", "type", "vs", "logDate", "logHour", "ts"]

# event log: pgid / npgid / itemid arrive as JSON numbers but are kept as text
EVENT_LOG = T.StructType(
    _strings("mid", "uid", "appid", "area", "os", "type", "evid", "pgid", "npgid", "itemid")
    + [T.StructField("ts", L, True)]
)
EVENT_COLUMNS = [
    "mid", "uid", "appid", "area", "os", "type", "evid", "pgid", "npgid", "itemid",
    "logDate", "logHour", "ts",
]

# order row as it arrives from the change feed: every value is text
ORDER_INFO_RAW = T.StructType(
    _strings(
        "id", "province_id", "consignee", "order_comment", "consignee_tel", "order_status",
        "payment_way", "user_id", "img_url", "total_amount", "expire_time",
        "delivery_address", "create_time", "operate_time", "tracking_no",
        "parent_order_id", "out_trade_no", "trade_body",
    )
)
ORDER_COLUMNS = [f.name for f in ORDER_INFO_RAW.fields] + ["create_date", "create_hour"]

ORDER_DETAIL = T.StructType(
    _strings("id", "order_id", "sku_name", "sku_id", "order_price", "img_url", "sku_num")
)

USER_INFO = T.StructType(_strings("id", "login_name", "user_level", "birthday", "gender"))

# wide sale-detail document (12 columns); user_age 0 / sku_price 0.0 are defaults
SALE_DETAIL = T.StructType(
    _strings("order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id",
             "user_gender")
    + [T.StructField("user_age", T.IntegerType(), False)]
    + _strings("user_level")
    + [T.StructField("sku_price", T.DoubleType(), False)]
    + _strings("sku_name", "dt")
)
SALE_DETAIL_COLUMNS = [f.name for f in SALE_DETAIL.fields]

# binlog envelope: one transaction, several rows in ``data``
BINLOG_ENVELOPE = T.StructType([
    T.StructField("data", T.ArrayType(ORDER_INFO_RAW), True),
    T.StructField("database", S, True),
    T.StructField("table", S, True),
    T.StructField("type", S, True),
    T.StructField("es", L, True),
    T.StructField("ts", L, True),
    T.StructField("id", L, True),
    T.StructField("isDdl", T.BooleanType(), True),
    T.StructField("old", T.ArrayType(T.MapType(S, S)), True),
    T.StructField("sql", S, True),
    T.StructField("mysqlType", T.MapType(S, S), True),
    T.StructField("sqlType", T.MapType(S, T.IntegerType()), True),
])

# change event from the capture client: after-image columns as (name, value)
COLUMN_VALUE = T.StructType([T.StructField("name", S, True), T.StructField("value", S, True)])
CHANGE_EVENT = T.StructType([
    T.StructField("table", S, True),
    T.StructField("entryType", S, True),
    T.StructField("eventType", S, True),
    T.StructField("rows", T.ArrayType(T.StructType([
        T.StructField("afterColumns", T.ArrayType(COLUMN_VALUE), True)
    ])), True),
])
