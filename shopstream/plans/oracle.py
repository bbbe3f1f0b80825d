"""DuckDB SQL oracles for the query catalogue.

The views ``events orders lineitem part customer nation`` are the shared parquet
tables. The CTEs below apply the same adapter rules as
``shopstream.sources.testdata``; each query then states the operator's semantics in
plain SQL (window functions, outer joins, FILTER aggregates), independent of the
Spark formulation. Column names match the Spark outputs.
"""

from __future__ import annotations

from shopstream.plans import catalog as C

APP_LOGS = """
app_logs AS (
  SELECT event_id,
         CASE WHEN event_type = 'view' THEN 'startup' ELSE 'event' END AS type,
         'mid_' || CAST(user_id AS VARCHAR) AS mid,
         json_extract_string(props, '$.k') AS uid,
         CASE WHEN user_id % 2 = 0 THEN 'android' ELSE 'ios' END AS os,
         'app' || CAST(user_id % 3 AS VARCHAR) AS appid,
         'area_' || CAST(user_id % 31 AS VARCHAR) AS area,
         'ch' || CAST(event_id % 5 AS VARCHAR) AS ch,
         '1.1.' || CAST(event_id % 4 AS VARCHAR) AS vs,
         CAST(event_id % 50 AS VARCHAR) AS pgid,
         CAST((event_id + 7) % 50 AS VARCHAR) AS npgid,
         CASE WHEN event_type = 'purchase' THEN 'coupon'
              WHEN event_type = 'click' THEN 'clickItem'
              ELSE event_type END AS evid,
         CAST(CAST(floor(value) AS BIGINT) % 50 AS VARCHAR) AS itemid,
         epoch_us(ts) // 1000 AS ts,
         strftime(ts, '%Y-%m-%d') AS log_date,
         strftime(ts, '%H') AS log_hour
  FROM events
)"""

ORDERS = """
orders_l AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id,
         CAST(o_custkey AS VARCHAR) AS user_id,
         o_orderstatus AS order_status,
         o_totalprice AS total_amount,
         strftime(o_orderdate + to_seconds((o_orderkey * 7919) % 86400), '%Y-%m-%d %H:%M:%S') AS create_time,
         strftime(o_orderdate, '%Y-%m-%d') AS create_date,
         strftime(o_orderdate + to_seconds((o_orderkey * 7919) % 86400), '%H') AS create_hour,
         '135' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS consignee_tel,
         CAST(o_orderkey % 34 AS VARCHAR) AS province_id,
         'consignee ' || CAST(o_orderkey AS VARCHAR) AS consignee,
         'comment ' || CAST(o_orderkey % 97 AS VARCHAR) AS order_comment,
         CAST(o_orderkey % 3 + 1 AS VARCHAR) AS payment_way,
         'http://img/' || CAST(o_orderkey AS VARCHAR) || '.png' AS img_url,
         'exp-' || CAST(o_orderkey AS VARCHAR) AS expire_time,
         'street ' || CAST(o_orderkey % 500 AS VARCHAR) AS delivery_address,
         'op-' || CAST(o_orderkey AS VARCHAR) AS operate_time,
         'T' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS tracking_no,
         CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_orderkey - 1 AS VARCHAR) END AS parent_order_id,
         'N' || CAST(o_orderkey AS VARCHAR) AS out_trade_no,
         'body of ' || CAST(o_orderkey AS VARCHAR) AS trade_body,
         1704067200000 + o_orderkey * 700 AS ts
  FROM orders
)"""

ORDER_ROW = (
    "id, province_id, consignee, order_comment, '*******' || substr(consignee_tel, 8, 4) AS consignee_tel, order_status, "
    "payment_way, user_id, img_url, total_amount, expire_time, delivery_address, create_time, operate_time, tracking_no, "
    "parent_order_id, out_trade_no, trade_body, create_date, create_hour")

DETAILS = """
details_l AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) || '-' ||
         CAST(l.l_partkey AS VARCHAR) || '-' || CAST(l.l_suppkey AS VARCHAR) AS id,
         CAST(l.l_orderkey AS VARCHAR) AS order_id,
         p.p_name AS sku_name,
         CAST(l.l_partkey AS VARCHAR) AS sku_id,
         l.l_extendedprice AS order_price,
         CAST(l.l_quantity AS VARCHAR) AS sku_num,
         1704067200000 + l.l_orderkey * 700 + ((l.l_partkey % 180) - 90) * 1000 AS ts,
         l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice
  FROM lineitem l
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
)"""

USERS = """
users_base AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS login_name, c_mktsegment AS user_level,
         strftime(DATE '1950-01-01' + CAST(c_custkey % 18000 AS INTEGER), '%Y-%m-%d') AS birthday,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         c_acctbal
  FROM customer WHERE c_acctbal >= 0
),
user_changes AS (
  SELECT id, login_name, user_level, birthday, gender, 1 AS seq, 'INSERT' AS event_type FROM users_base
  UNION ALL
  SELECT id, login_name, 'VIP' AS user_level, birthday, gender, 2 AS seq, 'UPDATE' AS event_type
  FROM users_base WHERE c_acctbal > 5000
),
users_latest AS (
  SELECT id, login_name, user_level, birthday, gender FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM user_changes)
  WHERE rn = 1
)"""

DAU = """
dau AS (
  SELECT mid, uid, appid, area, os, ch, type, vs, log_date, log_hour, ts
  FROM (SELECT *, row_number() OVER (PARTITION BY mid, log_date ORDER BY ts, event_id) AS rn
        FROM app_logs)
  WHERE rn = 1
)"""

SEEN = f"""
seen AS (SELECT DISTINCT mid, log_date FROM app_logs WHERE log_hour < '{C.SEEN_BEFORE_HOUR}'),
batch AS (SELECT * FROM app_logs WHERE log_hour >= '{C.SEEN_BEFORE_HOUR}'),
unseen AS (SELECT b.* FROM batch b WHERE NOT EXISTS
           (SELECT 1 FROM seen s WHERE s.mid = b.mid AND s.log_date = b.log_date))"""

SALE_INTERVAL = """
sale_iv AS (
  SELECT d.id AS order_detail_id, o.id AS order_id, o.order_status, o.create_time, o.user_id,
         d.sku_id, d.order_price AS sku_price, d.sku_name, o.create_date AS dt
  FROM orders_l o JOIN details_l d
    ON o.id = d.order_id AND d.ts BETWEEN o.ts - 60000 AND o.ts + 60000
)"""

AGE = f"(epoch_ms(TIMESTAMP '{C.AS_OF}') - epoch_ms(CAST(birthday AS DATE))) // 31536000000"

# 3-day windows sliding by 1 day: each event lies in the windows starting on its day
# and on the two days before.
ALERT_WINDOWS = """
ev_w AS (
  SELECT a.*, (a.ts // 86400000 - k.k) * 86400000 AS ws
  FROM app_logs a CROSS JOIN (SELECT unnest([0, 1, 2]) AS k) k
),
win AS (
  SELECT mid, ws,
         count(DISTINCT uid) FILTER (WHERE evid = 'coupon') AS n_uids,
         array_to_string(list_sort(list(DISTINCT uid) FILTER (WHERE evid = 'coupon')), ',') AS uids,
         array_to_string(list_sort(list(DISTINCT itemid) FILTER (WHERE evid = 'coupon')), ',') AS item_ids,
         bool_or(evid = 'clickItem') AS clicked_evid,
         bool_or(type = 'clickItem') AS clicked_type,
         bool_or(event_id % 211 = 0 AND evid <> 'coupon') AS clicked_other
  FROM ev_w GROUP BY mid, ws
)"""

WS_TEXT = "strftime(make_timestamp(ws * 1000), '%Y-%m-%d %H:%M:%S')"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _json_hours(cte: str, value_sql: str) -> str:
    def part(series):
        return (f"coalesce((SELECT string_agg('\"' || hour || '\":' || {value_sql}, ',' ORDER BY hour) "
                f"FROM {cte} WHERE series = '{series}'), '')")
    return (f"SELECT '{{\"today\":{{' || {part('today')} || '}},\"yesterday\":{{' || "
            f"{part('yesterday')} || '}}}}' AS doc")


def _day_documents(src: str, date_col: str, hour_col: str, value: str) -> str:
    return f"""
SELECT t.date AS day, '{{"today":{{' || t.m || '}},"yesterday":{{' || coalesce(y.m, '') || '}}}}' AS doc
FROM day_hours t LEFT JOIN day_hours y ON y.date = strftime(CAST(t.date AS DATE) - INTERVAL 1 DAY, '%Y-%m-%d')""", f"""
day_hours AS (
  SELECT date, string_agg('"' || hour || '":' || v, ',' ORDER BY hour) AS m
  FROM (SELECT {date_col} AS date, {hour_col} AS hour, CAST({value} AS VARCHAR) AS v FROM {src} GROUP BY 1, 2)
  GROUP BY date)"""


def _compare(src: str, date_col: str, hour_col: str, value: str, day: str) -> str:
    from shopstream.operators.kpi import yesterday_of
    return (f"SELECT CASE WHEN {date_col} = '{day}' THEN 'today' ELSE 'yesterday' END AS series, "
            f"{hour_col} AS hour, {value} AS value FROM {src} "
            f"WHERE {date_col} IN ('{day}', '{yesterday_of(day)}') GROUP BY 1, 2")


def oracle_sql() -> dict[str, str]:
    d, od = C.DAU_DAY, C.ORDER_DAY
    q: dict[str, str] = {}

    q["parse_startup"] = _with(APP_LOGS) + "SELECT event_id, mid, uid, appid, area, os, ch, type, vs, ts, log_date, log_hour FROM app_logs"
    q["parse_event"] = _with(APP_LOGS) + "SELECT event_id, mid, uid, appid, area, os, ch, type, evid, pgid, npgid, itemid, ts FROM app_logs"
    q["parse_order"] = _with(ORDERS) + f"SELECT {ORDER_ROW} FROM orders_l"
    q["parse_user"] = _with(USERS) + "SELECT seq, id, login_name, user_level, birthday, gender FROM user_changes"
    q["parse_detail"] = _with(DETAILS) + "SELECT id, order_id, sku_id, sku_name, order_price, sku_num FROM details_l"
    q["log_ingest"] = _with(APP_LOGS) + (
        "SELECT event_id, log_date, json_object('type', type, 'mid', mid, 'uid', uid, 'os', os, 'appid', appid, 'area', area, "
        "'ch', ch, 'vs', vs, 'evid', evid, 'pgid', CAST(pgid AS BIGINT), 'npgid', CAST(npgid AS BIGINT), "
        "'itemid', CAST(itemid AS BIGINT), 'ts', ts)::VARCHAR AS value FROM app_logs")
    q["log_ingest_passthrough"] = """
SELECT event_id, event_id % 101 = 0 AS rejected,
       CASE WHEN event_id % 101 = 0 THEN substr('{"type":"event","mid":"mid_' || CAST(user_id AS VARCHAR) || '","itemid":', 1, 25)
            ELSE '{"type":"event","mid":"mid_' || CAST(user_id AS VARCHAR) || '","itemid":' || CAST(event_id % 50 AS VARCHAR)
                 || ',"brand":"X' || CAST(event_id % 9 AS VARCHAR) || '","extra":{"a":[1,2.5,"b"],"k":true},"ts":'
                 || CAST(epoch_us(ts) // 1000 AS VARCHAR) || '}' END AS value
FROM events"""
    q["log_route"] = _with(APP_LOGS) + (
        "SELECT event_id, CASE WHEN type = 'startup' THEN 'CAT_STARTUP' ELSE 'CAT_EVENT' END AS topic "
        "FROM app_logs")

    cdc_rows = """
cdc_rows AS (
  SELECT 'order_info' AS "table",
         CASE order_status WHEN 'F' THEN 'INSERT' WHEN 'O' THEN 'UPDATE' ELSE 'DELETE' END AS event_type,
         id AS pk, 6 AS n_cols,
         json_object('id', id, 'user_id', user_id, 'order_status', order_status,
                     'total_amount', CAST(total_amount AS VARCHAR), 'create_time', create_time,
                     'consignee_tel', consignee_tel)::VARCHAR AS value
  FROM orders_l
  UNION ALL
  SELECT 'user_info', event_type, id, 5,
         json_object('id', id, 'login_name', login_name, 'user_level', user_level,
                     'birthday', birthday, 'gender', gender)::VARCHAR
  FROM user_changes
  UNION ALL
  SELECT 'user_info', 'DELETE', CAST(c_custkey AS VARCHAR), 1,
         json_object('id', CAST(c_custkey AS VARCHAR))::VARCHAR
  FROM customer WHERE c_acctbal < 0
  UNION ALL
  SELECT 'order_detail', 'INSERT', id, 6,
         json_object('id', id, 'order_id', order_id, 'sku_name', sku_name, 'sku_id', sku_id,
                     'order_price', CAST(order_price AS VARCHAR), 'sku_num', sku_num)::VARCHAR
  FROM details_l
),
cdc_routed AS (
  SELECT CASE WHEN "table" = 'order_info' AND event_type = 'INSERT' THEN 'CAT_ORDER'
              WHEN "table" = 'user_info' AND event_type IN ('INSERT', 'UPDATE') THEN 'CAT_USER'
              WHEN "table" = 'order_detail' AND event_type = 'INSERT' THEN 'CAT_ORDER_DETAIL'
         END AS topic, *
  FROM cdc_rows
)"""
    cdc = _with(ORDERS, DETAILS, USERS, cdc_rows)
    q["cdc_explode"] = cdc + 'SELECT "table", event_type, pk, n_cols FROM cdc_rows'
    q["cdc_route"] = cdc + "SELECT topic, pk FROM cdc_routed WHERE topic IS NOT NULL"
    q["cdc_after_json"] = cdc + "SELECT topic, value FROM cdc_routed WHERE topic IS NOT NULL"

    q["dau_dedup"] = _with(APP_LOGS, DAU) + "SELECT * FROM dau"
    seen_dedup = """
unseen_first AS (
  SELECT mid, uid, appid, area, os, ch, type, vs, log_date, log_hour, ts
  FROM (SELECT *, row_number() OVER (PARTITION BY mid, log_date ORDER BY ts, event_id) AS rn
        FROM unseen) WHERE rn = 1
)"""
    q["dau_seen_anti"] = _with(APP_LOGS, SEEN, seen_dedup) + "SELECT * FROM unseen_first"
    q["dau_seen_filter"] = q["dau_seen_anti"]
    q["dau_filter_counts"] = _with(APP_LOGS, SEEN) + (
        "SELECT (SELECT count(*) FROM batch) AS n_in, (SELECT count(*) FROM unseen) AS n_unseen, "
        "(SELECT count(*) FROM (SELECT DISTINCT mid, log_date FROM unseen)) AS n_new")
    q["route_dau"] = _with(APP_LOGS) + (
        "SELECT mid, uid, appid, area, os, ch, type, vs, log_date, log_hour, ts FROM ("
        "SELECT *, row_number() OVER (PARTITION BY mid, log_date ORDER BY ts, event_id) AS rn "
        "FROM app_logs WHERE type = 'startup') WHERE rn = 1")
    q["dau_total"] = _with(APP_LOGS, DAU) + f"SELECT count(*) AS dau_total FROM dau WHERE log_date = '{d}'"
    q["dau_hourly"] = _with(APP_LOGS, DAU) + (
        f"SELECT log_hour, count(*) AS dau FROM dau WHERE log_date = '{d}' GROUP BY log_hour")
    dau_cmp = "dau_cmp AS (" + _compare("dau", "log_date", "log_hour", "count(*)", d) + ")"
    q["dau_hourly_compare"] = _with(APP_LOGS, DAU, dau_cmp) + "SELECT * FROM dau_cmp"
    q["dau_hourly_json"] = _with(APP_LOGS, DAU, dau_cmp) + _json_hours("dau_cmp", "CAST(value AS VARCHAR)")

    docs, day_hours = _day_documents("dau", "log_date", "log_hour", "count(*)")
    q["dau_hour_documents"] = _with(APP_LOGS, DAU, day_hours) + docs

    q["order_enrich"] = _with(ORDERS) + f"SELECT {ORDER_ROW} FROM orders_l"
    q["mask_tel_tail"] = _with(ORDERS) + "SELECT id, '*******' || substr(consignee_tel, 8, 4) AS tel_masked FROM orders_l"
    q["mask_tel_head"] = _with(ORDERS) + "SELECT id, substr(consignee_tel, 1, 4) || '*******' AS tel_masked FROM orders_l"
    q["order_total"] = _with(ORDERS) + (
        f"SELECT round(sum(total_amount), 2) AS order_amount FROM orders_l WHERE create_date = '{od}'")
    q["order_hourly"] = _with(ORDERS) + (
        f"SELECT create_hour, round(sum(total_amount), 2) AS order_amount FROM orders_l "
        f"WHERE create_date = '{od}' GROUP BY create_hour")
    ord_cmp = "ord_cmp AS (" + _compare("orders_l", "create_date", "create_hour",
                                        "round(sum(total_amount), 2)", od) + ")"
    q["order_hourly_compare"] = _with(ORDERS, ord_cmp) + "SELECT * FROM ord_cmp"
    q["order_hourly_json"] = _with(ORDERS, ord_cmp) + _json_hours(
        "ord_cmp", "CAST(CAST(value AS DECIMAL(20,2)) AS VARCHAR)")
    docs, day_hours = _day_documents("orders_l", "create_date", "create_hour", "CAST(round(sum(total_amount), 2) AS DECIMAL(20,2))")
    q["order_hour_documents"] = _with(ORDERS, day_hours) + docs
    q["order_upsert"] = _with(ORDERS) + """
SELECT id, version, order_status, total_amount FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC) AS rn FROM (
    SELECT id, 1 AS version, order_status, total_amount FROM orders_l
    UNION ALL
    SELECT id, 2 AS version, order_status, total_amount * 1.1 FROM orders_l WHERE order_status = 'O'))
WHERE rn = 1"""

    kpi_vals = f"""
kpi_vals AS (
  SELECT (SELECT count(*) FROM dau WHERE log_date = '{d}') AS n_dau,
         (SELECT round(sum(total_amount), 2) FROM orders_l WHERE create_date = '{od}') AS amount
)"""
    q["kpi_total"] = _with(APP_LOGS, DAU, ORDERS, kpi_vals) + """
SELECT 'dau' AS id, '新增日活' AS name, CAST(n_dau AS DOUBLE) AS value FROM kpi_vals
UNION ALL SELECT 'new_mid', '新增用户', 233.0 FROM kpi_vals
UNION ALL SELECT 'order_amount', '新增交易额', amount FROM kpi_vals"""
    q["kpi_total_json"] = _with(APP_LOGS, DAU, ORDERS, kpi_vals) + """
SELECT '[{"id":"dau","name":"新增日活","value":' || CAST(n_dau AS VARCHAR) ||
       '},{"id":"new_mid","name":"新增用户","value":233},{"id":"order_amount","name":"新增交易额"' ||
       coalesce(',"value":' || CAST(CAST(amount AS DECIMAL(20,2)) AS VARCHAR), '') || '}]' AS doc
FROM kpi_vals"""

    q["sale_full_join"] = _with(ORDERS, DETAILS) + """
SELECT coalesce(o.id, d.order_id) AS order_id, d.id AS order_detail_id,
       CASE WHEN o.id IS NOT NULL AND d.id IS NOT NULL THEN 'both'
            WHEN o.id IS NOT NULL THEN 'order_only' ELSE 'detail_only' END AS match_kind
FROM (SELECT *, ts // 5000 AS b FROM orders_l) o
FULL OUTER JOIN (SELECT *, ts // 5000 AS b FROM details_l) d
  ON o.id = d.order_id AND o.b = d.b"""
    q["sale_join"] = _with(ORDERS, DETAILS) + """
SELECT d.id AS order_detail_id, o.id AS order_id, o.order_status, o.create_time, o.user_id,
       d.sku_id, d.order_price AS sku_price, d.sku_name, o.create_date AS dt
FROM orders_l o JOIN details_l d ON o.id = d.order_id"""
    q["sale_interval_join"] = _with(ORDERS, DETAILS, SALE_INTERVAL) + "SELECT * FROM sale_iv"
    q["sale_interval_full_join"] = _with(ORDERS, DETAILS) + """
SELECT coalesce(o.id, d.order_id) AS order_id, d.id AS order_detail_id,
       CASE WHEN o.id IS NOT NULL AND d.id IS NOT NULL THEN 'both'
            WHEN o.id IS NOT NULL THEN 'order_only' ELSE 'detail_only' END AS match_kind
FROM orders_l o FULL OUTER JOIN details_l d
  ON o.id = d.order_id AND d.ts BETWEEN o.ts - 60000 AND o.ts + 60000"""
    q["user_latest"] = _with(USERS) + "SELECT * FROM users_latest"
    q["user_age"] = _with(USERS) + f"SELECT id, CAST({AGE} AS INTEGER) AS age FROM users_latest"
    wide = f"""
sale_wide AS (
  SELECT s.order_detail_id, s.order_id, s.order_status, s.create_time, s.user_id, s.sku_id,
         u.gender AS user_gender, CAST(coalesce({AGE}, 0) AS INTEGER) AS user_age,
         u.user_level, s.sku_price, s.sku_name, s.dt
  FROM sale_iv s LEFT JOIN users_latest u ON s.user_id = u.id
)"""
    q["sale_wide"] = _with(ORDERS, DETAILS, SALE_INTERVAL, USERS, wide) + "SELECT * FROM sale_wide"
    q["sale_wide_keyed"] = _with(ORDERS, DETAILS, SALE_INTERVAL, USERS, wide) + """
SELECT order_detail_id, order_id, order_status, create_time, user_id, sku_id, user_gender, user_age,
       user_level, sku_price, sku_name, dt
FROM (SELECT *, row_number() OVER (PARTITION BY order_detail_id ORDER BY create_time DESC, order_id DESC,
        order_status DESC, user_id DESC, sku_id DESC, user_gender DESC NULLS LAST, user_age DESC,
        user_level DESC NULLS LAST, sku_price DESC, sku_name DESC NULLS LAST, dt DESC) AS rn FROM sale_wide)
WHERE rn = 1"""

    resent = """
details_sent AS (
  SELECT id, order_id, sku_id, sku_name, order_price, ts FROM details_l
  UNION ALL
  SELECT id, order_id, sku_id, sku_name, order_price * 1.1, ts + 1000 FROM details_l WHERE l_linenumber = 1
)"""
    q["sale_wide_resent"] = q["sale_wide_keyed"].replace(
        _with(ORDERS, DETAILS, SALE_INTERVAL, USERS, wide),
        _with(ORDERS, DETAILS, resent, SALE_INTERVAL.replace("details_l", "details_sent"), USERS, wide))

    alert_base = _with(APP_LOGS, ALERT_WINDOWS)
    min_uids = C.ALERT_MIN_UIDS
    q["coupon_alert"] = alert_base + (
        f"SELECT mid, {WS_TEXT} AS window_start, n_uids, uids, item_ids FROM win "
        f"WHERE n_uids > {min_uids} AND NOT clicked_evid")
    q["coupon_alert_lists"] = q["coupon_alert"]
    q["coupon_alert_windows"] = alert_base + (
        f"SELECT mid, {WS_TEXT} AS window_start FROM win WHERE n_uids > {min_uids} AND NOT clicked_evid")
    q["coupon_alert_literal"] = alert_base + (
        f"SELECT mid, {WS_TEXT} AS window_start, n_uids, uids, item_ids FROM win "
        f"WHERE n_uids > {min_uids} AND NOT clicked_type")
    q["coupon_alert_literal_click"] = alert_base + (
        f"SELECT mid, {WS_TEXT} AS window_start, n_uids, uids, item_ids FROM win "
        f"WHERE n_uids > {min_uids} AND NOT clicked_other")
    q["coupon_alert_per_minute"] = alert_base + f"""
SELECT alert_id, mid, window_start, n_uids FROM (
  SELECT mid || '_' || CAST((ws + 3 * 86400000) // 60000 AS VARCHAR) AS alert_id, mid,
         {WS_TEXT} AS window_start, n_uids,
         row_number() OVER (PARTITION BY mid || '_' || CAST((ws + 3 * 86400000) // 60000 AS VARCHAR)
                            ORDER BY ws DESC) AS rn
  FROM win WHERE n_uids > {min_uids} AND NOT clicked_evid)
WHERE rn = 1"""
    q["coupon_alert_minute_pick"] = _with(APP_LOGS) + f"""
SELECT alert_id, mid, {WS_TEXT} AS window_start, n_uids FROM (
  SELECT mid || '_' || CAST((ws + 90000) // 60000 AS VARCHAR) AS alert_id, mid, ws, n_uids,
         row_number() OVER (PARTITION BY mid, (ws + 90000) // 60000 ORDER BY ws DESC) AS rn
  FROM (SELECT mid, ws, count(DISTINCT uid) FILTER (WHERE evid = 'coupon') AS n_uids, bool_or(evid = 'clickItem') AS clicked
        FROM (SELECT a.mid, a.uid, a.evid, ((1704067200000 + (a.ts - 1704067200000) // 2880) // 30000 - k.k) * 30000 AS ws
              FROM app_logs a CROSS JOIN (SELECT unnest([0, 1, 2]) AS k) k)
        GROUP BY mid, ws)
  WHERE n_uids > {min_uids} AND NOT clicked)
WHERE rn = 1"""
    q["coupon_alert_events"] = alert_base + f""",
mix AS (SELECT mid, ws, evid, count(*) AS n FROM ev_w GROUP BY mid, ws, evid)
SELECT w.mid, {WS_TEXT.replace('ws', 'w.ws')} AS window_start,
       (SELECT string_agg(m.evid || ':' || CAST(m.n AS VARCHAR), ',' ORDER BY m.evid)
        FROM mix m WHERE m.mid = w.mid AND m.ws = w.ws) AS events
FROM win w WHERE w.n_uids > {min_uids} AND NOT w.clicked_evid"""

    q["upsert_latest"] = _with(ORDERS, DETAILS) + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY ts DESC, l_partkey DESC, l_suppkey DESC,
                                        l_quantity DESC, l_extendedprice DESC) AS rn
  FROM details_l)
WHERE rn = 1"""
    return q
