"""Schemas of the raw feeds and the logical tables.

Every raw field is a string, as in the upstream JSON records; numbers that arrive
quoted (``"682.0"``) are parsed as strings and cast afterwards, because ``from_json``
returns null for a quoted number declared as DOUBLE.
"""

from pyspark.sql import types as T

S = T.StringType()

# App log line (startup and event logs share one intake); ``ts`` is stamped by the server.
LOG_SCHEMA = T.StructType([
    T.StructField("type", S), T.StructField("mid", S), T.StructField("uid", S),
    T.StructField("os", S), T.StructField("appid", S), T.StructField("area", S),
    T.StructField("ch", S), T.StructField("vs", S), T.StructField("evid", S),
    T.StructField("pgid", S), T.StructField("npgid", S), T.StructField("itemid", S),
    T.StructField("ts", T.LongType()),
])

# Field and column lists of the raw feeds and tables.
STARTUP_FIELDS = ["mid", "uid", "appid", "area", "os", "ch", "type", "vs"]
EVENT_FIELDS = ["mid", "uid", "appid", "area", "os", "ch", "type", "evid", "pgid", "npgid", "itemid"]

STARTUP_SCHEMA = T.StructType([T.StructField(c, S) for c in STARTUP_FIELDS]
                              + [T.StructField("ts", T.LongType())])
EVENT_SCHEMA = T.StructType([T.StructField(c, S) for c in EVENT_FIELDS]
                            + [T.StructField("ts", T.LongType())])

ORDER_FIELDS = ["id", "province_id", "consignee", "order_comment", "consignee_tel", "order_status",
                "payment_way", "user_id", "img_url", "total_amount", "expire_time", "delivery_address",
                "create_time", "operate_time", "tracking_no", "parent_order_id", "out_trade_no",
                "trade_body"]
# total_amount arrives quoted, so it is read as a string and cast to double.
ORDER_SCHEMA = T.StructType([T.StructField(c, S) for c in ORDER_FIELDS])

DETAIL_FIELDS = ["id", "order_id", "sku_name", "sku_id", "order_price", "img_url", "sku_num"]
DETAIL_SCHEMA = T.StructType([T.StructField(c, S) for c in DETAIL_FIELDS])

USER_FIELDS = ["id", "login_name", "user_level", "birthday", "gender"]
USER_SCHEMA = T.StructType([T.StructField(c, S) for c in USER_FIELDS])

# Column order of the DAU table (11 columns) and the order table (20 columns).
DAU_COLUMNS = ["mid", "uid", "appid", "area", "os", "ch", "type", "vs", "log_date", "log_hour", "ts"]
ORDER_TABLE_COLUMNS = ["id", "province_id", "consignee", "order_comment", "consignee_tel",
                       "order_status", "payment_way", "user_id", "img_url", "total_amount",
                       "expire_time", "delivery_address", "create_time", "operate_time",
                       "tracking_no", "parent_order_id", "out_trade_no", "trade_body",
                       "create_date", "create_hour"]

# Rows of the maintained tables: what the jobs store (see ``operators.upsert``).
_CHANGE = [T.StructField("timestamp", T.TimestampType()), T.StructField("offset", T.LongType())]
DAU_TABLE = T.StructType([T.StructField(c, T.LongType() if c == "ts" else S) for c in DAU_COLUMNS])
ORDER_TABLE = T.StructType([T.StructField(c, T.DoubleType() if c == "total_amount" else S) for c in ORDER_TABLE_COLUMNS] + _CHANGE)
USER_TABLE = T.StructType(USER_SCHEMA.fields + _CHANGE)
SALE_TABLE = T.StructType([
    T.StructField("order_detail_id", S), T.StructField("order_id", S), T.StructField("order_status", S), T.StructField("create_time", S),
    T.StructField("user_id", S), T.StructField("sku_id", S), T.StructField("user_gender", S), T.StructField("user_age", T.IntegerType()),
    T.StructField("user_level", S), T.StructField("sku_price", T.DoubleType()), T.StructField("sku_name", S), T.StructField("dt", S)])

# A CDC change-set entry: one binlog entry for one table and one operation; each row is
# the after-image as an ordered list of (name, value) string pairs.
CDC_COLUMN = T.StructType([T.StructField("name", S), T.StructField("value", S)])
CDC_ENTRY_SCHEMA = T.StructType([
    T.StructField("db", S), T.StructField("table", S),
    T.StructField("entry_type", S), T.StructField("event_type", S),
    T.StructField("rows", T.ArrayType(T.StructType([
        T.StructField("after", T.ArrayType(CDC_COLUMN))]))),
    T.StructField("ts", T.LongType()),
])
