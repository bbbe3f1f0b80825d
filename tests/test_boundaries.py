"""Boundary behaviour: join tolerance, alert threshold, midnight, leap years, CDC rules."""

from pyspark.sql import functions as F

from conftest import rows
from shopstream.functions import timefmt
from shopstream.operators import alerts, dau, routing, sales, upsert

BASE = 1_700_000_000_000


def _orders(spark, ts_list):
    return spark.createDataFrame(
        [(str(i), "u1", "1", f"2023-11-14 22:13:{i:02d}", "2023-11-14", ts) for i, ts in enumerate(ts_list)],
        "id string, user_id string, order_status string, create_time string, create_date string, ts long")


def test_interval_join_tolerance_59_60_61(spark):
    orders = _orders(spark, [BASE, BASE, BASE])
    det = spark.createDataFrame(
        [(f"d{i}", str(i), "s", "n", 1.0, BASE + off) for i, off in enumerate([59_000, 60_000, 61_000])],
        "id string, order_id string, sku_id string, sku_name string, order_price double, ts long")
    got = sorted(r.order_detail_id for r in sales.interval_join(orders, det).collect())
    assert got == ["d0", "d1"]
    early = det.withColumn("ts", F.lit(BASE) - (F.col("ts") - F.lit(BASE)))
    assert sorted(r.order_detail_id for r in sales.interval_join(orders, early).collect()) == ["d0", "d1"]


def test_full_join_match_kinds(spark):
    orders = _orders(spark, [BASE, BASE])
    det = spark.createDataFrame([("d0", "0", "s", "n", 1.0, BASE + 1000), ("d1", "1", "s", "n", 1.0, BASE + 20_000),
                                 ("d9", "9", "s", "n", 1.0, BASE)],
                                "id string, order_id string, sku_id string, sku_name string, order_price double, ts long")
    got = rows(sales.batch_full_join(orders, det), "order_id", "order_detail_id", "match_kind")
    assert sorted(got, key=str) == sorted([("0", "d0", "both"), ("1", None, "order_only"),
                                           ("1", "d1", "detail_only"), ("9", "d9", "detail_only")], key=str)


def _events(spark, uids, extra=()):
    data = [("m1", u, "coupon", str(i), "event", BASE + i * 1000) for i, u in enumerate(uids)]
    data += list(extra)
    return spark.createDataFrame(data, "mid string, uid string, evid string, itemid string, type string, ts long")


def test_alert_needs_more_than_three_distinct_uids(spark):
    three = _events(spark, ["a", "b", "c", "c", "a"])
    assert alerts.coupon_alerts(three, window="5 minutes", slide="5 minutes").count() == 0
    four = _events(spark, ["a", "b", "c", "d"])
    out = alerts.coupon_alerts(four, window="5 minutes", slide="5 minutes").collect()
    assert len(out) == 1 and sorted(out[0].uids) == ["a", "b", "c", "d"]


def test_alert_click_excludes_unless_literal_type_check(spark):
    ev = _events(spark, ["a", "b", "c", "d"], [("m1", "z", "clickItem", "9", "event", BASE + 5000)])
    assert alerts.coupon_alerts(ev, window="5 minutes", slide="5 minutes").count() == 0
    assert alerts.coupon_alerts(ev, window="5 minutes", slide="5 minutes", click_col="type").count() == 1


def test_alert_null_uid_is_not_a_member(spark):
    ev = _events(spark, ["a", "b", "c", None])
    assert alerts.coupon_alerts(ev, window="5 minutes", slide="5 minutes").count() == 0


def test_alert_pane_plan_equals_window_plan_5min_10s(spark):
    from conftest import SF001
    from shopstream.sources import testdata as td
    ev = td.event_log(spark, SF001)
    # compress time so 5-minute windows hold enough devices to alert
    ev = ev.withColumn("ts", F.lit(1_704_067_200_000) + (F.col("ts") - F.lit(1_704_067_200_000)) / F.lit(2000)) \
           .withColumn("ts", F.col("ts").cast("long"))
    a = alerts.coupon_alerts(ev, method="panes")
    b = alerts.coupon_alerts(ev, method="window")
    key = ("mid", "window_start", "n_uids", "ts")
    assert a.count() > 0
    assert rows(a, *key) == rows(b, *key)
    def text(df):
        return rows(df.select("mid", "window_start", F.array_join(F.array_sort("uids"), ",").alias("u"),
                              alerts.event_counts_text().alias("e")))
    assert text(a) == text(b)


def test_one_alert_per_device_minute(spark):
    ev = _events(spark, ["a", "b", "c", "d"])
    a = alerts.coupon_alerts(ev, window="1 minute", slide="10 seconds")
    per_min = alerts.one_per_minute(a)
    assert per_min.count() == per_min.select("alert_id").distinct().count()
    assert per_min.count() < a.count()


def test_dau_midnight_keys_on_event_date(spark):
    midnight = 1_704_153_600_000  # 2024-01-02 00:00:00 UTC
    logs = spark.createDataFrame([(1, "m", midnight - 1), (2, "m", midnight), (3, "m", midnight + 5)],
                                 "event_id long, mid string, ts long")
    logs = logs.withColumn("log_date", timefmt.log_date("ts"))
    got = rows(dau.dedup_daily(logs), "mid", "log_date", "ts")
    assert got == [("m", "2024-01-01", midnight - 1), ("m", "2024-01-02", midnight)]


def test_seen_filter_then_dedup(spark):
    logs = spark.createDataFrame([(1, "a", "d1", 5), (2, "a", "d1", 3), (3, "b", "d1", 9), (4, "b", "d2", 1)],
                                 "event_id long, mid string, log_date string, ts long")
    seen = spark.createDataFrame([("b", "d1")], "mid string, log_date string")
    got = rows(dau.dedup_daily(dau.filter_unseen(logs, seen)), "mid", "log_date", "ts")
    assert got == [("a", "d1", 3), ("b", "d2", 1)]
    c = dau.filter_counts(logs, seen).first()
    assert (c.n_in, c.n_unseen, c.n_new) == (4, 3, 2)


def test_age_ignores_leap_days(spark):
    df = spark.createDataFrame([("2000-02-29",), ("2004-01-31",), ("2004-01-26",)], "birthday string")
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp")
    # 24 calendar years contain 6 leap days, so a 365-day year count passes the
    # birthday 6 days early
    got = [r.a for r in df.select(timefmt.age_in_years("birthday", as_of).alias("a")).collect()]
    assert got == [23, 20, 20]


def test_cdc_routes_inserts_and_user_updates_only(spark):
    def entry(table, op, *cols):
        return ("cat2019", table, "ROWDATA", op, [([(k, v) for k, v in cols],)], 0)
    data = [entry("order_info", "INSERT", ("id", "1")), entry("order_info", "UPDATE", ("id", "2")),
            entry("order_info", "DELETE", ("id", "3")), entry("user_info", "INSERT", ("id", "4")),
            entry("user_info", "UPDATE", ("id", "5"), ("id", "55")), entry("user_info", "DELETE", ("id", "6")),
            entry("order_detail", "INSERT", ("id", "7")), entry("order_detail", "UPDATE", ("id", "8")),
            ("other", "order_info", "ROWDATA", "INSERT", [([("id", "9")],)], 0),
            ("cat2019", "order_info", "TRANSACTIONEND", "INSERT", [([("id", "10")],)], 0)]
    from shopstream.schemas import CDC_ENTRY_SCHEMA
    entries = spark.createDataFrame(data, CDC_ENTRY_SCHEMA)
    out = routing.cdc_after_json(routing.cdc_route(routing.cdc_explode(entries)))
    got = rows(out, "topic", "value")
    assert got == [("CAT_ORDER", '{"id":"1"}'), ("CAT_ORDER_DETAIL", '{"id":"7"}'),
                   ("CAT_USER", '{"id":"4"}'), ("CAT_USER", '{"id":"55"}')]


def test_upsert_replay_is_idempotent_and_null_keys_append(spark, scratch):
    b0 = spark.createDataFrame([("k1", 1, "a"), ("k2", 1, "b"), (None, 1, "n1")], "id string, v int, p string")
    b1 = spark.createDataFrame([("k1", 2, "c"), (None, 2, "n2")], "id string, v int, p string")
    upsert.write_batch(b0, scratch, 0, ["id"], ["v"])
    upsert.write_batch(b1, scratch, 1, ["id"], ["v"])
    upsert.write_batch(b1, scratch, 1, ["id"], ["v"])  # replay of batch 1
    cur = upsert.read_latest(spark, scratch, ["id"])
    assert cur.count() == 4
    assert rows(cur.filter(~F.col("id").startswith("auto-")), "id", "p") == [("k1", "c"), ("k2", "b")]
    first = upsert.read_latest(spark, scratch, ["id"], keep="first")
    assert rows(first.filter(F.col("id") == "k1"), "p") == [("a",)]
