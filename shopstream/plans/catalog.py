"""Named queries over the shared test tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each entry reads whole tables (date-scoped reports filter on the report date, as the
upstream reports do) and returns a DataFrame with the column names used by the
matching oracle SQL in ``shopstream.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream import schemas
from shopstream.functions import masking, parse, timefmt
from shopstream.operators import alerts, dau, kpi, orders, routing, sales, upsert
from shopstream.sources import testdata as td

# Query constants (shared with the oracle).
DAU_DAY = "2024-01-15"
ORDER_DAY = "1995-01-06"
AS_OF = "2024-01-31 00:00:00"
ALERT_WINDOW = "3 days"
ALERT_SLIDE = "1 day"
ALERT_MIN_UIDS = 3
SEEN_BEFORE_HOUR = "12"

Query = Callable[[SparkSession, str], DataFrame]


def _days(day: str) -> list[str]:
    return [kpi.yesterday_of(day), day]


# ---------------------------------------------------------------------------------
# parsing / intake / routing


def q_parse_startup(spark, sf_dir):
    lines = td.log_lines(spark, sf_dir).select("event_id", "value")
    out = parse.parse_startup(lines)
    return out.select("event_id", *schemas.STARTUP_FIELDS, "ts", "log_date", "log_hour")


def q_parse_event(spark, sf_dir):
    lines = td.log_lines(spark, sf_dir).select("event_id", "value")
    out = parse.parse_event(lines)
    return out.select("event_id", *schemas.EVENT_FIELDS, "ts")


def q_parse_order(spark, sf_dir):
    out = parse.parse_order(td.order_lines(spark, sf_dir).select("value"))
    return out.select(*schemas.ORDER_TABLE_COLUMNS)


def q_parse_user(spark, sf_dir):
    out = parse.parse_user(td.user_lines(spark, sf_dir).select("value", "seq"))
    return out.select("seq", *schemas.USER_FIELDS)


def q_parse_detail(spark, sf_dir):
    out = parse.parse_detail(td.detail_lines(spark, sf_dir).select("value"))
    return out.select("id", "order_id", "sku_id", "sku_name", "order_price", "sku_num")


def q_log_ingest(spark, sf_dir):
    # the client's lines carry no ts; the intake stamps the arrival time
    lines = td.log_lines(spark, sf_dir, with_ts=False)
    stamped = routing.stamp_logs(lines, F.col("arrival_ms"))
    return stamped.select("event_id", "log_date", "value")


def q_log_ingest_passthrough(spark, sf_dir):
    """Lines with unknown, numeric and nested fields and lines that are no JSON object: all that was sent stays."""
    stamped = routing.stamp_lines(td.foreign_log_lines(spark, sf_dir), F.col("arrival_ms"))
    return stamped.select("event_id", "rejected", "value")


def q_log_route(spark, sf_dir):
    lines = td.log_lines(spark, sf_dir, with_ts=False)
    routed = routing.route_logs(routing.stamp_logs(lines, F.col("arrival_ms")))
    return routed.select("event_id", "topic")


def q_cdc_explode(spark, sf_dir):
    rows = routing.cdc_explode(td.cdc_entries(spark, sf_dir))
    return rows.select("table", "event_type", F.col("after")[0]["value"].alias("pk"),
                       F.size("after").alias("n_cols"))


def q_cdc_route(spark, sf_dir):
    routed = routing.cdc_route(routing.cdc_explode(td.cdc_entries(spark, sf_dir)))
    return routed.select("topic", F.col("after")[0]["value"].alias("pk"))


def q_cdc_after_json(spark, sf_dir):
    routed = routing.cdc_route(routing.cdc_explode(td.cdc_entries(spark, sf_dir)))
    return routing.cdc_after_json(routed).select("topic", "value")


# ---------------------------------------------------------------------------------
# daily active devices


def _dau_table(spark, sf_dir, days=None):
    return dau.dau_rows(dau.dedup_daily(td.startup_log(spark, sf_dir, days)))


def q_dau_dedup(spark, sf_dir):
    return _dau_table(spark, sf_dir)


def _seen_split(spark, sf_dir):
    logs = td.startup_log(spark, sf_dir)
    seen = logs.filter(F.col("log_hour") < SEEN_BEFORE_HOUR).select(*dau.DAU_KEY)
    batch = logs.filter(F.col("log_hour") >= SEEN_BEFORE_HOUR)
    return batch, seen


def q_dau_seen_filter(spark, sf_dir):
    """The same rows as ``dau_seen_anti``, with a Bloom filter of the seen keys before the anti join."""
    batch, seen = _seen_split(spark, sf_dir)
    return dau.dau_rows(dau.new_devices(batch, seen, known=dau.seen_filter(seen)))


def q_dau_seen_anti(spark, sf_dir):
    batch, seen = _seen_split(spark, sf_dir)
    return dau.dau_rows(dau.new_devices(batch, seen))


def q_dau_filter_counts(spark, sf_dir):
    batch, seen = _seen_split(spark, sf_dir)
    return dau.filter_counts(batch, seen)


def q_dau_total(spark, sf_dir):
    return dau.dau_total(_dau_table(spark, sf_dir, [DAU_DAY]), DAU_DAY)


def q_dau_hourly(spark, sf_dir):
    return dau.dau_hourly(_dau_table(spark, sf_dir, [DAU_DAY]), DAU_DAY)


def q_dau_hourly_compare(spark, sf_dir):
    return kpi.metric_hourly_compare("dau", _dau_table(spark, sf_dir, _days(DAU_DAY)), None, DAU_DAY)


def q_route_dau(spark, sf_dir):
    """Intake to table in one chain: stamp, route, parse the startup topic, first record per device and day."""
    lines = td.log_lines(spark, sf_dir, with_ts=False)
    routed = routing.route_logs(routing.stamp_logs(lines, F.col("arrival_ms")))
    startup = routed.filter(F.col("topic") == routing.TOPIC_STARTUP).select("event_id", "value")
    return dau.dau_rows(dau.dedup_daily(parse.parse_startup(startup)))


def q_dau_hourly_json(spark, sf_dir):
    return kpi.hourly_compare_json(q_dau_hourly_compare(spark, sf_dir), "long")


def q_dau_hour_documents(spark, sf_dir):
    """The hour documents of all days from one scan, as the hours job publishes them."""
    hours = _dau_table(spark, sf_dir).groupBy(F.col("log_date").alias("date"), F.col("log_hour").alias("hour")).agg(F.count(F.lit(1)).alias("value"))
    return kpi.hour_documents(hours, kpi.VALUE_TYPES["dau"])


# ---------------------------------------------------------------------------------
# orders


def _order_table(spark, sf_dir, days=None):
    return orders.enrich_orders(td.orders(spark, sf_dir, days))


def q_order_enrich(spark, sf_dir):
    return _order_table(spark, sf_dir)


def q_mask_tel_tail(spark, sf_dir):
    o = td.orders(spark, sf_dir)
    return o.select("id", masking.mask_tel_tail("consignee_tel").alias("tel_masked"))


def q_mask_tel_head(spark, sf_dir):
    o = td.orders(spark, sf_dir)
    return o.select("id", masking.mask_tel_head("consignee_tel").alias("tel_masked"))


# Sums of doubles differ in the last bits with the order of addition, so the catalogue
# compares amounts rounded to cents; the operators return the plain sums.
def _cents(df, col):
    return df.withColumn(col, F.round(col, 2))


def q_order_total(spark, sf_dir):
    return _cents(orders.order_total(_order_table(spark, sf_dir, [ORDER_DAY]), ORDER_DAY), "order_amount")


def q_order_hourly(spark, sf_dir):
    return _cents(orders.order_hourly(_order_table(spark, sf_dir, [ORDER_DAY]), ORDER_DAY), "order_amount")


def _order_hourly_compare(spark, sf_dir):
    return kpi.metric_hourly_compare("order", None, _order_table(spark, sf_dir, _days(ORDER_DAY)), ORDER_DAY)


def q_order_hourly_compare(spark, sf_dir):
    return _cents(_order_hourly_compare(spark, sf_dir), "value")


def q_order_hourly_json(spark, sf_dir):
    return kpi.hourly_compare_json(_order_hourly_compare(spark, sf_dir), "decimal(20,2)")


def q_order_hour_documents(spark, sf_dir):
    hours = _order_table(spark, sf_dir).groupBy(F.col("create_date").alias("date"), F.col("create_hour").alias("hour")).agg(F.sum("total_amount").alias("value"))
    return kpi.hour_documents(hours, kpi.VALUE_TYPES["order"])


def _kpi_total(spark, sf_dir):
    # devices of DAU_DAY and the order amount of ORDER_DAY: the test tables keep app
    # logs and orders in different years, so each metric is read for a day it has data
    return kpi.kpi_total(_dau_table(spark, sf_dir, [DAU_DAY]),
                         _order_table(spark, sf_dir, [ORDER_DAY]), DAU_DAY, order_day=ORDER_DAY)


def q_kpi_total(spark, sf_dir):
    return _cents(_kpi_total(spark, sf_dir).select("id", "name", "value"), "value")


def q_kpi_total_json(spark, sf_dir):
    return kpi.kpi_total_json(_kpi_total(spark, sf_dir))


def q_order_upsert(spark, sf_dir):
    versions = td.order_versions(spark, sf_dir)
    stored = versions.select("id", "version", "order_status", "total_amount")
    return upsert.latest_per_key(stored, ["id"], ["version"])


def q_upsert_latest(spark, sf_dir):
    d = td.details(spark, sf_dir)
    latest = upsert.latest_per_key(
        d.select("l_orderkey", "l_linenumber", "ts", "l_partkey", "l_suppkey", "l_quantity",
                 "l_extendedprice"),
        ["l_orderkey", "l_linenumber"],
        ["ts", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    return latest.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                         "l_extendedprice")


# ---------------------------------------------------------------------------------
# sales


def q_sale_full_join(spark, sf_dir):
    j = sales.batch_full_join(td.orders(spark, sf_dir), td.details(spark, sf_dir))
    return j.select("order_id", "order_detail_id", "match_kind")


def q_sale_join(spark, sf_dir):
    j = sales.sale_join(td.orders(spark, sf_dir), td.details(spark, sf_dir))
    return j.select(*sales.SALE_COLUMNS_NO_USER)


def q_sale_interval_join(spark, sf_dir):
    j = sales.interval_join(td.orders(spark, sf_dir), td.details(spark, sf_dir))
    return j.select(*sales.SALE_COLUMNS_NO_USER)


def q_sale_interval_full_join(spark, sf_dir):
    """Pairs within the tolerance, and the orders and details that never meet."""
    j = sales.interval_full_join(td.orders(spark, sf_dir), td.details(spark, sf_dir))
    return j.select("order_id", "order_detail_id", "match_kind")


def _users(spark, sf_dir):
    return sales.user_latest(td.user_changes(spark, sf_dir))


def q_user_latest(spark, sf_dir):
    return _users(spark, sf_dir).select("id", "login_name", "user_level", "birthday", "gender")


def q_user_age(spark, sf_dir):
    u = _users(spark, sf_dir)
    return u.select("id", timefmt.age_in_years("birthday", F.lit(AS_OF).cast("timestamp")).alias("age"))


def q_sale_wide(spark, sf_dir):
    j = sales.interval_join(td.orders(spark, sf_dir), td.details(spark, sf_dir))
    wide = sales.with_user(j, _users(spark, sf_dir), F.lit(AS_OF).cast("timestamp"))
    return wide.select(*sales.SALE_COLUMNS)


def q_sale_wide_keyed(spark, sf_dir):
    """What the sale index holds: one row per ``order_detail_id``."""
    return sales.one_per_detail(q_sale_wide(spark, sf_dir))


def q_sale_wide_resent(spark, sf_dir):
    """The sale index when details are sent again: one row per ``order_detail_id`` out of several."""
    j = sales.interval_join(td.orders(spark, sf_dir), td.resent_details(spark, sf_dir))
    return sales.one_per_detail(sales.with_user(j, _users(spark, sf_dir), F.lit(AS_OF).cast("timestamp")))


# ---------------------------------------------------------------------------------
# coupon alerts


def _alerts(spark, sf_dir, click_col="evid", ev=None):
    ev = td.event_log(spark, sf_dir) if ev is None else ev
    return alerts.coupon_alerts(ev, window=ALERT_WINDOW, slide=ALERT_SLIDE,
                                min_uids=ALERT_MIN_UIDS, click_col=click_col)


def _window_start_text():
    return F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start")


def _alert_out(a):
    return a.select("mid", _window_start_text(), "n_uids",
                    F.array_join(F.array_sort("uids"), ",").alias("uids"),
                    F.array_join(F.array_sort("item_ids"), ",").alias("item_ids"))


def q_coupon_alert(spark, sf_dir):
    return _alert_out(_alerts(spark, sf_dir))


def q_coupon_alert_literal(spark, sf_dir):
    return _alert_out(_alerts(spark, sf_dir, click_col="type"))


def q_coupon_alert_literal_click(spark, sf_dir):
    return _alert_out(_alerts(spark, sf_dir, "type", td.typed_event_log(spark, sf_dir)))


def q_coupon_alert_per_minute(spark, sf_dir):
    per_min = alerts.one_per_minute(_alerts(spark, sf_dir))
    return per_min.select("alert_id", "mid", _window_start_text(), "n_uids")


def q_coupon_alert_minute_pick(spark, sf_dir):
    """Windows that end in the same minute: the later one is the stored alert of the device and minute."""
    found = alerts.coupon_alerts(td.dense_event_log(spark, sf_dir), window="90 seconds", slide="30 seconds", min_uids=ALERT_MIN_UIDS)
    return alerts.one_per_minute(found).select("alert_id", "mid", _window_start_text(), "n_uids")


def q_coupon_alert_windows(spark, sf_dir):
    """The windows that raise an alert, from aggregates of bounded size."""
    timed = alerts.usable(td.event_log(spark, sf_dir)).withColumn("event_time", timefmt.ms_to_ts("ts"))
    return alerts.alerting_windows(timed, ALERT_WINDOW, ALERT_SLIDE, ALERT_MIN_UIDS).select("mid", _window_start_text())


def q_coupon_alert_lists(spark, sf_dir):
    """Bounded decision first, then the lists of the alerting windows."""
    ev = td.event_log(spark, sf_dir)
    timed = alerts.usable(ev).withColumn("event_time", timefmt.ms_to_ts("ts"))
    return _alert_out(alerts.with_lists(alerts.alerting_windows(timed, ALERT_WINDOW, ALERT_SLIDE, ALERT_MIN_UIDS), ev))


def q_coupon_alert_events(spark, sf_dir):
    a = _alerts(spark, sf_dir)
    return a.select("mid", _window_start_text(),
                    alerts.event_counts_text("event_counts").alias("events"))


QUERIES: dict[str, Query] = {
    "parse_startup": q_parse_startup,
    "parse_event": q_parse_event,
    "parse_order": q_parse_order,
    "parse_detail": q_parse_detail,
    "parse_user": q_parse_user,
    "log_ingest": q_log_ingest,
    "log_ingest_passthrough": q_log_ingest_passthrough,
    "log_route": q_log_route,
    "cdc_explode": q_cdc_explode,
    "cdc_route": q_cdc_route,
    "cdc_after_json": q_cdc_after_json,
    "dau_dedup": q_dau_dedup,
    "dau_seen_anti": q_dau_seen_anti,
    "dau_seen_filter": q_dau_seen_filter,
    "dau_filter_counts": q_dau_filter_counts,
    "dau_total": q_dau_total,
    "dau_hourly": q_dau_hourly,
    "dau_hourly_compare": q_dau_hourly_compare,
    "dau_hourly_json": q_dau_hourly_json,
    "dau_hour_documents": q_dau_hour_documents,
    "route_dau": q_route_dau,
    "order_enrich": q_order_enrich,
    "mask_tel_tail": q_mask_tel_tail,
    "mask_tel_head": q_mask_tel_head,
    "order_total": q_order_total,
    "order_hourly": q_order_hourly,
    "order_hourly_compare": q_order_hourly_compare,
    "order_hourly_json": q_order_hourly_json,
    "order_hour_documents": q_order_hour_documents,
    "order_upsert": q_order_upsert,
    "kpi_total": q_kpi_total,
    "kpi_total_json": q_kpi_total_json,
    "sale_full_join": q_sale_full_join,
    "sale_join": q_sale_join,
    "sale_interval_join": q_sale_interval_join,
    "sale_interval_full_join": q_sale_interval_full_join,
    "user_latest": q_user_latest,
    "user_age": q_user_age,
    "sale_wide": q_sale_wide,
    "sale_wide_keyed": q_sale_wide_keyed,
    "sale_wide_resent": q_sale_wide_resent,
    "coupon_alert": q_coupon_alert,
    "coupon_alert_literal": q_coupon_alert_literal,
    "coupon_alert_literal_click": q_coupon_alert_literal_click,
    "coupon_alert_per_minute": q_coupon_alert_per_minute,
    "coupon_alert_minute_pick": q_coupon_alert_minute_pick,
    "coupon_alert_events": q_coupon_alert_events,
    "coupon_alert_windows": q_coupon_alert_windows,
    "coupon_alert_lists": q_coupon_alert_lists,
    "upsert_latest": q_upsert_latest,
}
