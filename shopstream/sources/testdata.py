"""Adapters: the shared parquet tables -> the logical feeds the operators consume.

The shared tables are a TPC-H-like star schema plus an ``events`` table. They are
shaped into the application's logical tables (app logs, orders, order details,
users, CDC entries) with deterministic column rules; the DuckDB oracle applies the
same rules in SQL. Every adapter is a lazy projection/join over the parquet scan, so
filters and column pruning still reach the files.

Rules (fixed values, shared with the oracle):

* app log: ``mid = 'mid_' || user_id``, ``uid = props.k``, ``type = 'startup'`` for
  ``view`` events else ``'event'``; ``evid``: ``purchase`` -> ``coupon``,
  ``click`` -> ``clickItem``, otherwise the event type; ``itemid = floor(value) % 50``;
  ``ts`` = epoch millis of the event time (session zone UTC); ``os, appid, area``
  follow the user id, ``ch, vs, pgid, npgid`` the event id.
* order: ``create_time = o_orderdate + (o_orderkey * 7919) % 86400`` seconds;
  ``consignee_tel = '135' || lpad(o_custkey, 8, '0')``; the feed delivers order ``k`` at
  ``ARRIVAL_BASE_MS + k * ARRIVAL_STEP_MS``; the other text columns follow the keys.
* detail: id ``l_orderkey-l_linenumber-l_partkey-l_suppkey``; arrival time = its
  order's arrival + ``(l_partkey % 180) - 90`` seconds (computed from the line item alone).
* user: customers with a negative account balance are not (yet) in the user feed;
  each other customer is inserted once, and customers with a balance above 5000 get
  a later update that sets ``user_level`` to ``VIP``. Birthday =
  ``1950-01-01 + (c_custkey % 18000)`` days, gender ``M`` for even keys else ``F``.
* CDC: orders as ``order_info`` (status ``F`` INSERT, ``O`` UPDATE, ``P`` DELETE; two
  consecutive order keys of one status share an entry of two rows; orders divisible by
  10 are followed by a ``TRANSACTIONEND`` entry, which carries no row data),
  the user feed as ``user_info`` (negative balance DELETE, else INSERT, plus the VIP
  UPDATE), line items as ``order_detail`` INSERT, nations as ``base.nation`` (outside
  the subscribed schema).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream import schemas
from shopstream.functions import parse, timefmt

# Fixed values of the adapter rules.
ORDER_SECOND_MULTIPLIER = 7919
SECONDS_PER_DAY = 86400
DETAIL_ARRIVAL_SPREAD = 180
DETAIL_ARRIVAL_SHIFT = 90
TEL_PREFIX = "135"
BIRTHDAY_BASE = "1950-01-01"
BIRTHDAY_SPAN_DAYS = 18000
VIP_BALANCE = 5000.0
VIP_LEVEL = "VIP"
ITEM_BUCKETS = 50
OS_EVEN, OS_ODD = "android", "ios"
# feed arrival clock: order k arrives k * ARRIVAL_STEP_MS after ARRIVAL_BASE_MS
ARRIVAL_BASE_MS = 1_704_067_200_000
DENSITY = 2880
ARRIVAL_STEP_MS = 700
CLICK_TYPE_EVERY = 211
BROKEN_EVERY = 101
DB_NAME = "cat2019"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day_bounds(days) -> tuple[str, str]:
    ds = sorted(_dt.date.fromisoformat(d) for d in days)
    return ds[0].isoformat(), (ds[-1] + _dt.timedelta(days=1)).isoformat()


def _in_days(col: str, days, ntz: bool = True) -> Column:
    """Range predicate on a raw timestamp column, written so it reaches the parquet
    scan as PushedFilters (a formatted-date equality would not)."""
    lo, hi = _day_bounds(days)
    typ = "timestamp_ntz" if ntz else "timestamp"
    return (F.col(col) >= F.lit(lo).cast(typ)) & (F.col(col) < F.lit(hi).cast(typ))


# ---------------------------------------------------------------------------------
# app logs (startup + event)


def app_logs(spark: SparkSession, sf_dir: str, days=None) -> DataFrame:
    """One app log record per event, columns of the log schema plus ``event_id``."""
    ev = table(spark, sf_dir, "events")
    if days:
        ev = ev.filter(_in_days("ts", days))
    user, event = F.col("user_id"), F.col("event_id")
    return ev.select(
        F.col("event_id"),
        F.when(F.col("event_type") == "view", F.lit("startup")).otherwise(F.lit("event")).alias("type"),
        F.concat(F.lit("mid_"), F.col("user_id").cast("string")).alias("mid"),
        F.get_json_object("props", "$.k").alias("uid"),
        F.when(user % 2 == 0, F.lit(OS_EVEN)).otherwise(F.lit(OS_ODD)).alias("os"),
        F.concat(F.lit("app"), (user % 3).cast("string")).alias("appid"),
        F.concat(F.lit("area_"), (user % 31).cast("string")).alias("area"),
        F.concat(F.lit("ch"), (event % 5).cast("string")).alias("ch"),
        F.concat(F.lit("1.1."), (event % 4).cast("string")).alias("vs"),
        F.when(F.col("event_type") == "purchase", F.lit("coupon"))
         .when(F.col("event_type") == "click", F.lit("clickItem"))
         .otherwise(F.col("event_type")).alias("evid"),
        (event % 50).cast("string").alias("pgid"), ((event + 7) % 50).cast("string").alias("npgid"),
        (F.floor("value") % ITEM_BUCKETS).cast("string").alias("itemid"),
        timefmt.ts_to_ms("ts").alias("ts"),
    )


def startup_log(spark: SparkSession, sf_dir: str, days=None) -> DataFrame:
    """Every event used as a startup record, with ``log_date``/``log_hour``."""
    logs = app_logs(spark, sf_dir, days)
    return logs.select("event_id", *schemas.STARTUP_FIELDS, "ts",
                       timefmt.log_date("ts").alias("log_date"),
                       timefmt.log_hour("ts").alias("log_hour"))


def event_log(spark: SparkSession, sf_dir: str, days=None) -> DataFrame:
    """Every event as an event record (``evid``, ``itemid``), with ``log_date``/``log_hour``."""
    logs = app_logs(spark, sf_dir, days)
    return logs.select("event_id", *schemas.EVENT_FIELDS, "ts",
                       timefmt.log_date("ts").alias("log_date"),
                       timefmt.log_hour("ts").alias("log_hour"))


def typed_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log where every ``CLICK_TYPE_EVERY``-th record, coupon takes among them, has a click as its ``type``."""
    return event_log(spark, sf_dir).withColumn(
        "type", F.when(F.col("event_id") % CLICK_TYPE_EVERY == 0, F.lit("clickItem")).otherwise(F.col("type")))


def dense_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log in ``DENSITY`` times less time: a day takes 30 seconds."""
    return event_log(spark, sf_dir).withColumn(
        "ts", F.lit(ARRIVAL_BASE_MS) + F.floor((F.col("ts") - F.lit(ARRIVAL_BASE_MS)) / F.lit(DENSITY)))


def foreign_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines with fields the log schema doesn't know (text, number, nested) and a client ``ts``;
    every ``BROKEN_EVERY``-th line is cut off."""
    line = F.concat(F.lit('{"type":"event","mid":"mid_'), F.col("user_id").cast("string"), F.lit('","itemid":'), (F.col("event_id") % 50).cast("string"),
                    F.lit(',"brand":"X'), (F.col("event_id") % 9).cast("string"), F.lit('","ts":1,"extra":{"a":[1,2.5,"b"],"k":true}}'))
    return table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % BROKEN_EVERY == 0, F.substring(line, 1, 25)).otherwise(line).alias("value"),
        timefmt.ts_to_ms("ts").alias("arrival_ms"))


def log_lines(spark: SparkSession, sf_dir: str, days=None, with_ts: bool = True) -> DataFrame:
    """Raw JSON log lines as the intake receives them (``value``), plus the arrival time
    ``arrival_ms`` that the intake stamps. Numeric fields are written as JSON numbers."""
    logs = app_logs(spark, sf_dir, days)
    fields = [F.col(c) for c in ("type", "mid", "uid", "os", "appid", "area", "ch", "vs", "evid")]
    fields += [F.col(c).cast("int").alias(c) for c in ("pgid", "npgid", "itemid")]
    if with_ts:
        fields.append(F.col("ts"))
    return logs.select("event_id", parse.record_json(*fields).alias("value"),
                       F.col("ts").alias("arrival_ms"))


# ---------------------------------------------------------------------------------
# orders, details, users


def _create_ms() -> Column:
    offset_s = (F.col("o_orderkey") * ORDER_SECOND_MULTIPLIER) % SECONDS_PER_DAY
    return timefmt.ts_to_ms("o_orderdate") + offset_s * 1000


def _arrival_ms(order_key: str) -> Column:
    return F.lit(ARRIVAL_BASE_MS) + F.col(order_key) * ARRIVAL_STEP_MS


def _order_text(order_key: Column) -> dict[str, Column]:
    """Text columns of an order that the shared tables don't have, from its key."""
    key = order_key.cast("string")
    return {
        "province_id": (order_key % 34).cast("string"),
        "consignee": F.concat(F.lit("consignee "), key),
        "order_comment": F.concat(F.lit("comment "), (order_key % 97).cast("string")),
        "payment_way": (order_key % 3 + 1).cast("string"),
        "img_url": F.concat(F.lit("http://img/"), key, F.lit(".png")),
        "expire_time": F.concat(F.lit("exp-"), key),
        "delivery_address": F.concat(F.lit("street "), (order_key % 500).cast("string")),
        "operate_time": F.concat(F.lit("op-"), key),
        "tracking_no": F.concat(F.lit("T"), F.lpad(key, 10, "0")),
        "parent_order_id": F.when(order_key % 7 == 0, (order_key - 1).cast("string")),
        "out_trade_no": F.concat(F.lit("N"), key),
        "trade_body": F.concat(F.lit("body of "), key),
    }


def orders(spark: SparkSession, sf_dir: str, days=None) -> DataFrame:
    """Order records (raw phone), ``create_date``/``create_hour`` and arrival ``ts``."""
    o = table(spark, sf_dir, "orders")
    if days:
        o = o.filter(_in_days("o_orderdate", days))
    create_time = F.date_format(timefmt.ms_to_ts(_create_ms()), "yyyy-MM-dd HH:mm:ss")
    return o.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("total_amount"),
        create_time.alias("create_time"),
        F.concat(F.lit(TEL_PREFIX), F.lpad(F.col("o_custkey").cast("string"), 8, "0")).alias("consignee_tel"),
        *[c.alias(name) for name, c in _order_text(F.col("o_orderkey")).items()],
        _arrival_ms("o_orderkey").alias("ts"),
    ).withColumn("create_date", timefmt.create_date("create_time")) \
     .withColumn("create_hour", timefmt.create_hour("create_time"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order JSON lines (every value quoted, as the CDC feed writes them)."""
    o = orders(spark, sf_dir)
    fields = [F.col(c).cast("string").alias(c) for c in schemas.ORDER_FIELDS]
    return o.select(parse.record_json(*fields).alias("value"), F.col("ts").alias("arrival_ms"))


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-detail records with their arrival ``ts`` (line items of existing parts get a name)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    joined = li.join(p, li.l_partkey == p.p_partkey, "left")
    shift_s = (F.col("l_partkey") % DETAIL_ARRIVAL_SPREAD) - DETAIL_ARRIVAL_SHIFT
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("p_name").alias("sku_name"),
        F.col("l_partkey").cast("string").alias("sku_id"),
        F.col("l_extendedprice").alias("order_price"),
        F.col("l_quantity").cast("string").alias("sku_num"),
        (_arrival_ms("l_orderkey") + shift_s * 1000).alias("ts"),
        # raw line-item fields kept for the keyed upsert
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    )


def resent_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details, those of the first line of each order sent again a second later at a price 10 % higher (unrounded)."""
    d = details(spark, sf_dir)
    again = (d.filter(F.col("l_linenumber") == 1).withColumn("order_price", F.col("order_price") * 1.1).withColumn("ts", F.col("ts") + 1000))
    return d.unionByName(again)


def detail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = details(spark, sf_dir)
    fields = [F.col(c).cast("string").alias(c) for c in
              ("id", "order_id", "sku_name", "sku_id", "order_price", "sku_num")]
    return d.select(parse.record_json(*fields).alias("value"), F.col("ts").alias("arrival_ms"))


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change of the user table from one customer scan: DELETE for a negative
    balance, otherwise INSERT (seq 1) and, above the VIP balance, an UPDATE (seq 2)
    that sets ``user_level`` to ``VIP``."""
    c = table(spark, sf_dir, "customer")
    birthday = F.date_format(F.date_add(F.lit(BIRTHDAY_BASE).cast("date"),
                                        (F.col("c_custkey") % BIRTHDAY_SPAN_DAYS).cast("int")),
                             "yyyy-MM-dd")
    bal = F.col("c_acctbal")

    def change(cond, seq, op, level):
        return F.when(cond, F.struct(F.lit(seq).alias("seq"), F.lit(op).alias("event_type"),
                                     level.alias("user_level")))

    changes = F.array(change(bal < 0, 1, "DELETE", F.col("c_mktsegment")),
                      change(bal >= 0, 1, "INSERT", F.col("c_mktsegment")),
                      change(bal > VIP_BALANCE, 2, "UPDATE", F.lit(VIP_LEVEL)))
    exploded = c.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("login_name"),
        birthday.alias("birthday"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("gender"),
        F.explode(F.filter(changes, lambda x: x.isNotNull())).alias("_c"))
    return exploded.select("id", "login_name", "_c.user_level", "birthday", "gender", "_c.seq", "_c.event_type")


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user feed: inserts (seq 1) of present customers and VIP updates (seq 2)."""
    return customer_changes(spark, sf_dir).filter(F.col("event_type") != "DELETE")


def user_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = user_changes(spark, sf_dir)
    return u.select(parse.record_json(*schemas.USER_FIELDS).alias("value"), "seq")


# ---------------------------------------------------------------------------------
# CDC envelopes


def _after(*cols: str) -> Column:
    """After-image of a single-row entry: an ordered array of (name, value) strings."""
    image = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"))
                      for c in cols])
    return F.array(F.struct(image.alias("after")))


def order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order change feed: version 1 is every order as placed; open orders (``O``) are
    re-sent as version 2 with the amount raised by 10% (unrounded, so any engine
    computes the same double)."""
    v1 = orders(spark, sf_dir).withColumn("version", F.lit(1))
    v2 = (orders(spark, sf_dir).filter(F.col("order_status") == "O")
          .withColumn("total_amount", F.col("total_amount") * 1.1).withColumn("version", F.lit(2)))
    return v1.unionByName(v2)


CDC_ORDER_FIELDS = ("id", "user_id", "order_status", "total_amount", "create_time", "consignee_tel")


def _order_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order changes: rows of one status whose keys are 2k and 2k+1 share an entry."""
    o = orders(spark, sf_dir)
    image = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"))
                      for c in CDC_ORDER_FIELDS])
    key = F.col("id").cast("long")
    entry = o.groupBy(F.floor(key / 2).alias("pair"), "order_status").agg(
        F.array_sort(F.collect_list(F.struct(key.alias("k"), image.alias("after")))).alias("r"), F.min("ts").alias("ts"))
    return entry.select(
        F.lit(DB_NAME).alias("db"), F.lit("order_info").alias("table"), F.lit("ROWDATA").alias("entry_type"),
        F.when(F.col("order_status") == "F", F.lit("INSERT"))
         .when(F.col("order_status") == "O", F.lit("UPDATE"))
         .otherwise(F.lit("DELETE")).alias("event_type"),
        F.transform("r", lambda x: F.struct(x["after"].alias("after"))).alias("rows"), "ts")


def cdc_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change-set entries (``db, table, entry_type, event_type, rows, ts``) as a binlog
    delivers them: one table and one operation each, with one or more rows, and
    transaction ends between them that carry an image of no interest."""
    o = _order_entries(spark, sf_dir)
    ends = orders(spark, sf_dir).filter(F.col("id").cast("long") % 10 == 0).select(
        F.lit(DB_NAME).alias("db"), F.lit("order_info").alias("table"), F.lit("TRANSACTIONEND").alias("entry_type"),
        F.lit("INSERT").alias("event_type"), _after("id").alias("rows"), "ts")
    is_delete = F.col("event_type") == "DELETE"
    u = customer_changes(spark, sf_dir).select(
        F.lit(DB_NAME).alias("db"), F.lit("user_info").alias("table"),
        F.lit("ROWDATA").alias("entry_type"), "event_type",
        # a delete carries only the key in its image
        F.when(is_delete, _after("id")).otherwise(_after(*schemas.USER_FIELDS)).alias("rows"),
        F.when(is_delete, F.col("id").cast("long")).otherwise(F.col("seq").cast("long")).alias("ts"))
    d = details(spark, sf_dir).select(
        F.lit(DB_NAME).alias("db"), F.lit("order_detail").alias("table"),
        F.lit("ROWDATA").alias("entry_type"), F.lit("INSERT").alias("event_type"),
        _after("id", "order_id", "sku_name", "sku_id", "order_price", "sku_num").alias("rows"),
        F.col("ts"))
    n = table(spark, sf_dir, "nation").select(
        F.lit("base").alias("db"), F.lit("nation").alias("table"),
        F.lit("ROWDATA").alias("entry_type"), F.lit("INSERT").alias("event_type"),
        _after("n_nationkey", "n_name").alias("rows"), F.lit(0).cast("long").alias("ts"))
    return o.unionByName(ends).unionByName(u).unionByName(d).unionByName(n)
