"""DuckDB SQL twins of the registered queries (same column names and values).

The driver tables are pre-registered as views; each string is self-contained.
"""

from __future__ import annotations

STARTUP = """
startup AS (
  SELECT 'mid_' || CAST(user_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid,
         CAST(NULL AS VARCHAR) AS appid, CAST(NULL AS VARCHAR) AS area, CAST(NULL AS VARCHAR) AS os,
         CAST(NULL AS VARCHAR) AS ch, event_type AS type, CAST(NULL AS VARCHAR) AS vs,
         strftime(ts, '%Y-%m-%d') AS logDate, strftime(ts, '%H') AS logHour, (epoch_us(ts) // 1000) AS ts
  FROM events)"""

FIRST_SEEN = STARTUP + """,
first_seen AS (
  SELECT mid, uid, appid, area, os, ch, type, vs, logDate, logHour, ts FROM (
    SELECT *, row_number() OVER (PARTITION BY mid, logDate ORDER BY ts, type, logHour) AS rn
    FROM startup) WHERE rn = 1)"""

PURCHASES = """
purchases AS (
  SELECT CAST(event_id AS VARCHAR) AS id, value AS total_amount,
         strftime(ts, '%Y-%m-%d') AS create_date, strftime(ts, '%H') AS create_hour
  FROM events WHERE event_type = 'purchase')"""

EVENT_LOG = """
ev AS (
  SELECT 'mid_' || CAST(user_id // 10 AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid,
         CASE event_type WHEN 'signup' THEN 'coupon' WHEN 'click' THEN 'clickItem' ELSE event_type END AS evid,
         json_extract_string(props, '$.k') AS itemid, (epoch_us(ts) // 1000) AS ts
  FROM events)"""

ORDERS = """
o AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderstatus AS order_status,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time,
         strftime(o_orderdate, '%Y-%m-%d') AS dt, CAST(o_custkey AS VARCHAR) AS user_id
  FROM orders)"""

LINES = """
l AS (
  SELECT order_detail_id, order_id, CAST(l_partkey AS VARCHAR) AS sku_id, p_name AS sku_name,
         coalesce(TRY_CAST(order_price AS DOUBLE), 0.0) AS sku_price
  FROM (
    SELECT *, row_number() OVER (PARTITION BY order_detail_id
                                 ORDER BY l_extendedprice, l_quantity) AS rn
    FROM (
      SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                       CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS order_detail_id,
             CAST(l_orderkey AS VARCHAR) AS order_id, l_partkey, l_extendedprice, l_quantity,
             CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS order_price
      FROM lineitem)) x
  LEFT JOIN part p ON p.p_partkey = x.l_partkey
  WHERE rn = 1)"""

USERS = """
u_all AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS login_name, c_mktsegment AS user_level,
         CAST(DATE '1950-01-01' + CAST((c_custkey * 37) % 18000 AS INTEGER) AS DATE) AS bday,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, c_acctbal
  FROM customer)"""


def _sale_detail(as_of: str = "CAST(o.dt AS DATE)") -> str:
    return ORDERS + "," + LINES + "," + USERS + f""",
u AS (SELECT * FROM u_all),
sd AS (
  SELECT l.order_detail_id, o.order_id, o.order_status, o.create_time, o.user_id, l.sku_id,
         u.gender AS user_gender,
         CAST(coalesce(trunc(date_diff('day', u.bday, {as_of}) / 365.0), 0) AS INTEGER) AS user_age,
         u.user_level, l.sku_price, l.sku_name, o.dt
  FROM o JOIN l ON o.order_id = l.order_id
  LEFT JOIN u ON u.id = o.user_id)"""


SD_COLS = ("order_detail_id, order_id, order_status, create_time, user_id, sku_id, user_gender, "
           "user_age, user_level, sku_price, sku_name, dt")


def _matches(keyword_tokens: list[str]) -> str:
    arr = ", ".join(f"'{t}'" for t in keyword_tokens)
    return _sale_detail() + f""",
m AS (SELECT * FROM sd
      WHERE list_has_all(regexp_extract_all(lower(sku_name), '[\\p{{L}}\\p{{N}}]+'), [{arr}]))"""


def _alert_select(src: str, keys: str, group: str) -> str:
    return f"""
  SELECT {keys}, ts, mid || CAST(CAST(floor(ts / 60000) AS BIGINT) AS VARCHAR) AS doc_id,
         CAST(len(uid_set) AS BIGINT) AS n_uids, array_to_string(uid_set, ',') AS uids,
         array_to_string(item_set, ',') AS item_ids,
         array_to_string([t || ' x' || CAST(types[t] AS VARCHAR) for t in list_sort(map_keys(types))], ',') AS events,
         CAST(n_events AS BIGINT) AS n_events
  FROM (
    SELECT {group},
           list_sort(list_distinct(list(CASE WHEN evid = 'coupon' THEN coalesce(uid, '') END))) AS uid_set,
           list_sort(list_distinct(list(CASE WHEN evid = 'coupon' THEN coalesce(itemid, '') END))) AS item_set,
           histogram(evid) AS types,
           count(*) AS n_events, max(CASE WHEN evid = 'clickItem' THEN 1 ELSE 0 END) AS clicked,
           min(ts) AS ts
    FROM {src} GROUP BY {group})
  WHERE len(uid_set) >= 3 AND clicked = 0"""


TUMBLING = "WITH " + EVENT_LOG + """,
w AS (SELECT *, CAST(floor(ts / 28800000) * 28800000 AS BIGINT) AS window_start FROM ev),
w2 AS (SELECT *, window_start + 28800000 AS window_end FROM w)
""" + _alert_select("w2", "mid, window_start, window_end", "mid, window_start, window_end")


def _sliding(hours: int) -> str:
    return EVENT_LOG + f""",
w AS (
  SELECT ev.*, CAST(floor(ts / 3600000) * 3600000 - i * 3600000 AS BIGINT) AS window_start
  FROM ev, range(0, {hours}) AS r(i)),
w2 AS (SELECT *, window_start + {hours * 3600000} AS window_end FROM w),
sliding AS (""" + _alert_select("w2", "mid, window_start, window_end", "mid, window_start, window_end") + ")"


SLIDING_CTE = _sliding(24)
SLIDING = "WITH " + SLIDING_CTE + "\nSELECT * FROM sliding"

TRAILING = "WITH " + EVENT_LOG + """,
t AS (
  SELECT mid, evid, ts,
    list_sort(list_distinct(list(CASE WHEN evid = 'coupon' THEN coalesce(uid, '') END) OVER win)) AS uid_set,
    list_sort(list_distinct(list(CASE WHEN evid = 'coupon' THEN coalesce(itemid, '') END) OVER win)) AS item_set,
    list(evid) OVER win AS types,
    count(*) OVER win AS n_events,
    max(CASE WHEN evid = 'clickItem' THEN 1 ELSE 0 END) OVER win AS clicked
  FROM ev
  WINDOW win AS (PARTITION BY mid ORDER BY ts RANGE BETWEEN 28799999 PRECEDING AND CURRENT ROW))
SELECT mid, evid, ts, mid || CAST(CAST(floor(ts / 60000) AS BIGINT) AS VARCHAR) AS doc_id,
       CAST(len(uid_set) AS BIGINT) AS n_uids, array_to_string(uid_set, ',') AS uids,
       array_to_string(item_set, ',') AS item_ids,
       array_to_string([y || ' x' || CAST(len(list_filter(types, lambda z: z = y)) AS VARCHAR)
                        for y in list_sort(list_distinct(types))], ',') AS events,
       CAST(n_events AS BIGINT) AS n_events
FROM t WHERE len(uid_set) >= 3 AND clicked = 0"""

PER_MINUTE = "WITH " + SLIDING_CTE + """
SELECT doc_id, mid, window_start, window_end, ts, n_uids, uids, item_ids, events, n_events
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY window_start DESC, window_end DESC) AS rn
      FROM sliding) WHERE rn = 1"""

THROTTLE = "WITH RECURSIVE " + SLIDING_CTE + """,
n AS (SELECT *, row_number() OVER (PARTITION BY mid ORDER BY ts, window_start) AS seq FROM sliding),
nx AS (
  SELECT x.mid, x.seq,
         (SELECT min(y.seq) FROM n y
          WHERE y.mid = x.mid AND floor(y.ts / 1000) - floor(x.ts / 1000) >= 60 AND y.seq > x.seq) AS nxt
  FROM n x),
walk(mid, seq) AS (
  SELECT mid, seq FROM n WHERE seq = 1
  UNION ALL
  SELECT nx.mid, nx.nxt FROM walk JOIN nx ON nx.mid = walk.mid AND nx.seq = walk.seq
  WHERE nx.nxt IS NOT NULL)
SELECT n.mid, n.window_start, n.window_end, n.ts, n.doc_id, n.n_uids, n.uids, n.item_ids,
       n.events, n.n_events
FROM n JOIN walk ON n.mid = walk.mid AND n.seq = walk.seq"""


def _json_obj(pairs: list[tuple[str, str]]) -> str:
    return "CAST(json_object(" + ", ".join(f"'{k}', coalesce({v}, '')" for k, v in pairs) + ") AS VARCHAR)"


ORDER_PAIRS = [
    ("id", "CAST(o_orderkey AS VARCHAR)"),
    ("user_id", "CAST(o_custkey AS VARCHAR)"),
    ("order_status", "o_orderstatus"),
    ("total_amount", "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"),
    ("create_time", "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"),
]
LINE_PAIRS = [
    ("id", "concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
           "CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR))"),
    ("order_id", "CAST(l_orderkey AS VARCHAR)"),
    ("sku_id", "CAST(l_partkey AS VARCHAR)"),
    ("sku_name", "p_name"),
    ("order_price", "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)"),
    ("sku_num", "CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR)"),
]


def _user_pairs(level: str = "c_mktsegment") -> list[tuple[str, str]]:
    return [("id", "CAST(c_custkey AS VARCHAR)"), ("login_name", "c_name"), ("user_level", level),
            ("birthday", "strftime(DATE '1950-01-01' + CAST((c_custkey * 37) % 18000 AS INTEGER), '%Y-%m-%d')"),
            ("gender", "CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END")]


LINES_AND_PARTS = "lineitem LEFT JOIN part ON l_partkey = p_partkey"


CDC_ROUTE = f"""
SELECT 'ORDER_INFO' AS topic, {_json_obj(ORDER_PAIRS)} AS value FROM orders
UNION ALL SELECT 'ORDER_DETAIL', {_json_obj(LINE_PAIRS)} FROM {LINES_AND_PARTS}
UNION ALL SELECT 'USER_INFO', {_json_obj(_user_pairs())} FROM customer"""

CDC_FLATTEN = f"""
SELECT 'order_info' AS "table", 'INSERT' AS eventType, {_json_obj(ORDER_PAIRS)} AS value FROM orders
UNION ALL SELECT 'order_info', 'UPDATE', {_json_obj(ORDER_PAIRS)} FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'order_detail', 'INSERT', {_json_obj(LINE_PAIRS)} FROM {LINES_AND_PARTS}
UNION ALL SELECT 'user_info', 'INSERT', {_json_obj(_user_pairs())} FROM customer
UNION ALL SELECT 'user_info', 'UPDATE', {_json_obj(_user_pairs("'VIP'"))} FROM customer WHERE c_acctbal > 5000
UNION ALL SELECT 'sku_info', 'INSERT', {_json_obj([("id", "CAST(p_partkey AS VARCHAR)"), ("sku_name", "p_name")])} FROM part"""

CANAL_EXPLODE = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
       o_orderstatus AS order_status,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total_amount,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time,
       strftime(o_orderdate, '%Y-%m-%d') AS create_date, strftime(o_orderdate, '%H') AS create_hour,
       'INSERT' AS type
FROM orders"""

ORACLE: dict[str, str] = {
    "dau_first_seen": "WITH " + FIRST_SEEN + "\nSELECT * FROM first_seen",
    "dau_total": "WITH " + FIRST_SEEN + "\nSELECT logDate, count(*) AS dau FROM first_seen GROUP BY logDate",
    "dau_hours": "WITH " + FIRST_SEEN
    + "\nSELECT logDate, logHour, count(*) AS dau FROM first_seen GROUP BY logDate, logHour",
    "dau_anti_join": "WITH " + STARTUP + """,
seen AS (SELECT DISTINCT mid, logDate FROM startup WHERE logHour < '12'),
pm AS (SELECT s.* FROM startup s WHERE s.logHour >= '12'
       AND NOT EXISTS (SELECT 1 FROM seen WHERE seen.mid = s.mid AND seen.logDate = s.logDate))
SELECT mid, uid, appid, area, os, ch, type, vs, logDate, logHour, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY mid, logDate ORDER BY ts, type, logHour) AS rn FROM pm)
WHERE rn = 1""",
    "dau_anti_join_mid": "WITH " + STARTUP + """,
seen AS (SELECT DISTINCT mid FROM startup WHERE logHour < '01'),
pm AS (SELECT s.* FROM startup s WHERE s.logHour >= '01' AND NOT EXISTS (SELECT 1 FROM seen WHERE seen.mid = s.mid))
SELECT mid, uid, appid, area, os, ch, type, vs, logDate, logHour, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY mid, logDate ORDER BY ts, type, logHour) AS rn FROM pm)
WHERE rn = 1""",
    "dau_expiring": "WITH RECURSIVE " + STARTUP + """,
came AS (SELECT *, ts + CASE WHEN ts % 7 = 0 THEN 108000000 ELSE 0 END AS arrived FROM startup),
sets(logDate, opened) AS (
  SELECT logDate, min(arrived) FROM came GROUP BY logDate
  UNION ALL
  SELECT c.logDate, min(c.arrived) FROM sets s JOIN came c ON c.logDate = s.logDate AND c.arrived >= s.opened + 86400000
  GROUP BY c.logDate, s.opened),
member AS (
  SELECT c.*, max(s.opened) AS opened FROM came c JOIN sets s ON s.logDate = c.logDate AND s.opened <= c.arrived GROUP BY ALL)
SELECT mid, logDate, logHour, type, ts, arrived, opened FROM (
  SELECT *, row_number() OVER (PARTITION BY mid, logDate, opened ORDER BY arrived, ts, uid, type) AS rn FROM member)
WHERE rn = 1""",
    "gmv_total": """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS create_date, round(sum(o_totalprice), 2) AS order_amount
FROM orders GROUP BY 1""",
    "gmv_hours": "WITH " + PURCHASES + """
SELECT create_date, create_hour, round(CAST(sum(total_amount) AS DOUBLE), 2) AS order_amount
FROM purchases GROUP BY 1, 2""",
    "realtime_total": "WITH " + FIRST_SEEN + "," + PURCHASES + """,
d AS (SELECT logDate AS date, count(*) AS dau FROM first_seen GROUP BY 1),
g AS (SELECT create_date AS date, sum(total_amount) AS amt FROM purchases GROUP BY 1),
days AS (SELECT coalesce(d.date, g.date) AS date, d.dau, g.amt FROM d FULL JOIN g ON d.date = g.date)
SELECT date, 'dau' AS id, '新增日活' AS name, round(CAST(coalesce(dau, 0) AS DOUBLE), 2) AS value FROM days
UNION ALL SELECT date, 'new_mid', '新增设备', 233.0 FROM days
UNION ALL SELECT date, 'order_amount', '新增交易额', round(coalesce(amt, 0.0), 2) FROM days""",
    "realtime_hours": "WITH " + FIRST_SEEN + """,
h AS (SELECT logDate AS date, logHour AS hour, CAST(count(*) AS DOUBLE) AS value
      FROM first_seen GROUP BY 1, 2),
p AS (SELECT strftime(CAST(date AS DATE) + INTERVAL 1 DAY, '%Y-%m-%d') AS date, hour, value FROM h)
SELECT coalesce(h.date, p.date) AS date, coalesce(h.hour, p.hour) AS hour,
       h.value AS today, p.value AS yesterday
FROM h FULL JOIN p ON h.date = p.date AND h.hour = p.hour""",
    "realtime_hours_gmv": "WITH " + PURCHASES + """,
h AS (SELECT create_date AS date, create_hour AS hour, sum(total_amount) AS value
      FROM purchases GROUP BY 1, 2),
p AS (SELECT strftime(CAST(date AS DATE) + INTERVAL 1 DAY, '%Y-%m-%d') AS date, hour, value FROM h)
SELECT coalesce(h.date, p.date) AS date, coalesce(h.hour, p.hour) AS hour,
       round(h.value, 2) AS today, round(p.value, 2) AS yesterday
FROM h FULL JOIN p ON h.date = p.date AND h.hour = p.hour""",
    "cdc_route": CDC_ROUTE,
    "cdc_flatten": CDC_FLATTEN,
    "canal_explode": CANAL_EXPLODE,
    "order_full_outer": "WITH " + ORDERS + "," + LINES + """,
os AS (SELECT order_id, order_status FROM o)
SELECT coalesce(os.order_id, l.order_id) AS order_id, l.order_detail_id, os.order_status, l.sku_id,
       CASE WHEN os.order_id IS NULL THEN 'detail_only' WHEN l.order_id IS NULL THEN 'order_only'
            ELSE 'matched' END AS match
FROM os FULL JOIN l ON os.order_id = l.order_id""",
    "sale_detail_wide": "WITH " + _sale_detail() + f"\nSELECT {SD_COLS} FROM sd",
    "sale_detail_user_left": "WITH " + _sale_detail("DATE '2000-01-01'") + f"\nSELECT {SD_COLS} FROM sd",
    "user_latest": "WITH " + USERS + """
SELECT id, login_name, CASE WHEN c_acctbal > 5000 THEN 'VIP' ELSE user_level END AS user_level,
       strftime(bday, '%Y-%m-%d') AS birthday, gender
FROM u_all""",
    "keyword_match": "WITH " + _matches(["red", "bolt"]) + f"\nSELECT {SD_COLS} FROM m",
    "facet_gender": "WITH " + _matches(["red"]) + """
SELECT * FROM (
  SELECT dt, user_gender, doc_count,
         row_number() OVER (PARTITION BY dt ORDER BY doc_count DESC, user_gender ASC) AS rank
  FROM (SELECT dt, user_gender, count(*) AS doc_count FROM m WHERE user_gender IS NOT NULL
        GROUP BY 1, 2))
WHERE rank <= 2""",
    "facet_age": "WITH " + _matches(["red"]) + """
SELECT * FROM (
  SELECT dt, user_age, doc_count,
         row_number() OVER (PARTITION BY dt ORDER BY doc_count DESC, user_age ASC) AS rank
  FROM (SELECT dt, user_age, count(*) AS doc_count FROM m WHERE user_age IS NOT NULL GROUP BY 1, 2))
WHERE rank <= 5""",
    "age_shares": "WITH " + _matches(["red"]) + """,
c AS (SELECT dt, count(*) AS total, sum(CASE WHEN user_age < 20 THEN 1 ELSE 0 END) AS low,
             sum(CASE WHEN user_age > 30 THEN 1 ELSE 0 END) AS high FROM m GROUP BY dt),
r AS (SELECT dt, total, floor(low * 1000.0 / total + 0.5) / 10.0 AS under_20,
             floor(high * 1000.0 / total + 0.5) / 10.0 AS over_30 FROM c)
SELECT dt, total, under_20, CAST(floor(100.0 - under_20 - over_30 + 0.5) AS DOUBLE) AS from_20_to_30, over_30
FROM r""",
    "gender_shares": "WITH " + _matches(["red"]) + """
SELECT dt, count(*) AS total,
       floor(sum(CASE WHEN user_gender = 'M' THEN 1 ELSE 0 END) * 1000.0 / count(*) + 0.5) / 10.0 AS male,
       floor(sum(CASE WHEN user_gender = 'F' THEN 1 ELSE 0 END) * 1000.0 / count(*) + 0.5) / 10.0 AS female
FROM m GROUP BY dt""",
    "search_stat": "WITH " + _matches(["red"]) + """,
c AS (SELECT dt, count(*) AS total, sum(CASE WHEN user_age < 20 THEN 1 ELSE 0 END) AS low,
             sum(CASE WHEN user_age > 30 THEN 1 ELSE 0 END) AS high,
             sum(CASE WHEN user_gender = 'M' THEN 1 ELSE 0 END) AS male,
             sum(CASE WHEN user_gender = 'F' THEN 1 ELSE 0 END) AS female FROM m GROUP BY dt),
r AS (SELECT dt, floor(low * 1000.0 / total + 0.5) / 10.0 AS low, floor(high * 1000.0 / total + 0.5) / 10.0 AS high,
             floor(male * 1000.0 / total + 0.5) / 10.0 AS male, floor(female * 1000.0 / total + 0.5) / 10.0 AS female FROM c)
SELECT dt, '用户年龄占比' AS title, CAST(0 AS BIGINT) AS place, '20岁以下' AS name, low AS value FROM r
UNION ALL SELECT dt, '用户年龄占比', 1, '20岁到30岁', CAST(floor(100.0 - low - high + 0.5) AS DOUBLE) FROM r
UNION ALL SELECT dt, '用户年龄占比', 2, '30岁以上', high FROM r
UNION ALL SELECT dt, '用户性别占比', 0, '男', male FROM r
UNION ALL SELECT dt, '用户性别占比', 1, '女', female FROM r""",
    "search_answer": "WITH " + _matches(["red"]) + """,
c AS (SELECT dt, count(*) AS total, count(*) FILTER (user_age < 20) AS low, count(*) FILTER (user_age > 30) AS high,
             count(*) FILTER (user_gender = 'M') AS m, count(*) FILTER (user_gender = 'F') AS f FROM m GROUP BY dt),
r AS (SELECT dt, total, floor(low * 1000.0 / total + 0.5) / 10.0 AS under_20, floor(high * 1000.0 / total + 0.5) / 10.0 AS over_30,
             floor(m * 1000.0 / total + 0.5) / 10.0 AS male, floor(f * 1000.0 / total + 0.5) / 10.0 AS female FROM c),
g AS (SELECT dt, string_agg(user_gender || ':' || n, ',' ORDER BY n DESC, user_gender) AS genders FROM (
        SELECT dt, user_gender, count(*) AS n FROM m WHERE user_gender IS NOT NULL GROUP BY 1, 2
        QUALIFY row_number() OVER (PARTITION BY dt ORDER BY n DESC, user_gender) <= 2) GROUP BY dt),
a AS (SELECT dt, string_agg(user_age || ':' || n, ',' ORDER BY n DESC, user_age) AS ages FROM (
        SELECT dt, user_age, count(*) AS n FROM m WHERE user_age IS NOT NULL GROUP BY 1, 2
        QUALIFY row_number() OVER (PARTITION BY dt ORDER BY n DESC, user_age) <= 5) GROUP BY dt),
p AS (SELECT dt, string_agg(order_detail_id || '/' || user_id || '/' || sku_id, ',' ORDER BY row_no) AS page FROM (
        SELECT *, row_number() OVER (PARTITION BY dt ORDER BY order_detail_id) AS row_no FROM m)
      WHERE row_no > 2 AND row_no <= 7 GROUP BY dt)
SELECT dt, CAST(total AS BIGINT) AS total, under_20, CAST(floor(100.0 - under_20 - over_30 + 0.5) AS DOUBLE) AS from_20_to_30,
       over_30, male, female, coalesce(genders, '') AS genders, coalesce(ages, '') AS ages, coalesce(page, '') AS page
FROM r LEFT JOIN g USING (dt) LEFT JOIN a USING (dt) LEFT JOIN p USING (dt)""",
    "sale_detail_page": "WITH " + _matches(["red"]) + f"""
SELECT {SD_COLS}, row_no FROM (
  SELECT *, row_number() OVER (PARTITION BY dt ORDER BY order_detail_id) AS row_no FROM m)
WHERE row_no > 2 AND row_no <= 7""",
    "alert_tumbling": TUMBLING,
    "alert_sliding": SLIDING,
    "alert_trailing": TRAILING,
    "alert_per_minute": PER_MINUTE,
    "alert_throttle_60s": THROTTLE,
    "word_window": """
SELECT CAST(floor(epoch_ms(ts) / 10800000) * 10800000 AS BIGINT) AS window_start,
       CAST(floor(epoch_ms(ts) / 10800000) * 10800000 + 10800000 AS BIGINT) AS window_end,
       event_type AS word, count(*) AS n
FROM events GROUP BY 1, 2, 3""",
    "late_join_stream": "WITH " + ORDERS + "," + LINES + """
SELECT l.order_detail_id, o.order_id, l.sku_id, o.order_status
FROM o JOIN l ON o.order_id = l.order_id
WHERE CAST(split_part(l.order_detail_id, '-', 2) AS INTEGER) % 2 = 0""",
}

ORACLE["match_status_stream"] = "WITH " + ORDERS + "," + LINES + """,
kept AS (SELECT * FROM o WHERE CAST(order_id AS BIGINT) % 10 <> 3)
SELECT coalesce(k.order_id, l.order_id) AS order_id, l.order_detail_id, k.order_status, l.sku_id,
       CASE WHEN k.order_id IS NULL THEN 'detail_only' WHEN l.order_id IS NULL THEN 'order_only' ELSE 'matched' END AS match
FROM kept k FULL JOIN (SELECT l.* FROM l JOIN o USING (order_id)) l
  ON k.order_id = l.order_id AND CAST(split_part(l.order_detail_id, '-', 2) AS INTEGER) % 2 = 0"""

ORACLE["realtime_total_day"] = "SELECT id, name, value FROM (" + ORACLE["realtime_total"] + ") WHERE date = '2024-01-15'"
ORACLE["sale_detail_day"] = "SELECT * FROM (" + ORACLE["sale_detail_wide"] + ") WHERE dt = '1996-03-13'"
ORACLE["user_json"] = """
SELECT CAST(to_json({id: id, login_name: login_name, user_level: user_level, birthday: birthday, gender: gender}) AS VARCHAR) AS value
FROM (""" + ORACLE["user_latest"] + ")"
ORACLE["alert_days"] = "SELECT * FROM (WITH " + _sliding(8) + """
SELECT * FROM sliding)
WHERE strftime(make_timestamp(window_start * 1000), '%Y-%m-%d') IN ('2024-01-10', '2024-01-11')"""

ORACLE["order_merge_stream"] = "WITH " + ORDERS + """
SELECT order_id AS id, user_id, CASE WHEN CAST(order_id AS BIGINT) % 3 = 0 THEN 'R' ELSE order_status END AS order_status,
       create_time, dt AS create_date
FROM o"""

# the watermark is that of the slower side; days are far apart, so a day waits as a whole or not at all
ORACLE["join_state_stream"] = "WITH " + ORDERS + "," + LINES + """,
met AS (SELECT l.order_id, l.order_detail_id, o.dt FROM l JOIN o USING (order_id)),
day AS (SELECT least((SELECT max(dt) FROM o), (SELECT max(dt) FROM met)) AS dt)
SELECT 'order' AS side, order_id, CAST(NULL AS VARCHAR) AS order_detail_id FROM o WHERE dt >= (SELECT dt FROM day)
UNION ALL
SELECT 'line', order_id, order_detail_id FROM met WHERE dt >= (SELECT dt FROM day)"""

# seconds from the order's first sending; a line meets the order sent last less than 100 s before it, or
# else the next one, if no two arrivals from the line to it are 100 s apart
ORACLE["cached_pairs"] = "WITH " + ORDERS + "," + LINES + """,
sent AS (
  SELECT order_id, order_status, 0 AS s FROM o
  UNION ALL SELECT order_id, 'R', 90 FROM o WHERE CAST(order_id AS BIGINT) % 3 = 0),
came AS (
  SELECT l.order_id, order_detail_id, sku_id, CAST(split_part(order_detail_id, '-', 2) AS INTEGER) * 45
         * CASE WHEN CAST(l.order_id AS BIGINT) % 2 = 0 THEN 1 ELSE -1 END AS s FROM l JOIN o USING (order_id)),
arrivals AS (SELECT order_id, s FROM sent UNION SELECT order_id, s FROM came),
gaps AS (SELECT order_id, s, lead(s) OVER (PARTITION BY order_id ORDER BY s) - s AS gap FROM arrivals),
near AS (
  SELECT order_detail_id, c.order_id, sku_id, c.s, max(x.s) FILTER (x.s <= c.s AND c.s - x.s < 100) AS before,
         min(x.s) FILTER (x.s > c.s) AS next
  FROM came c JOIN sent x ON x.order_id = c.order_id GROUP BY ALL),
broken AS (
  SELECT DISTINCT order_detail_id FROM near n JOIN gaps g ON g.order_id = n.order_id
  WHERE g.s >= n.s AND g.s < n.next AND g.gap >= 100),
met AS (
  SELECT *, coalesce(before, CASE WHEN order_detail_id NOT IN (SELECT order_detail_id FROM broken) THEN next END) AS at FROM near)
SELECT order_detail_id, met.order_id, sku_id, order_status FROM met JOIN sent ON sent.order_id = met.order_id AND sent.s = met.at"""

for _twin, _batch in {
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
    "order_full_outer_bucketed": "order_full_outer",
    "sale_detail_bucketed": "sale_detail_wide",
    "dau_from_state_stream": "dau_first_seen",
}.items():
    ORACLE[_twin] = ORACLE[_batch]
