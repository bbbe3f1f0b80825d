"""Streaming forms equal the batch forms; restarts do not duplicate output."""

import os

from pyspark.sql import functions as F

from conftest import SF001, rows
from shopstream.operators import alerts, dau, sales, upsert
from shopstream.sources import streams, tables
from shopstream.sources import testdata as td
from shopstream.streaming import jobs


def _write_lines(df, path, n_files=4):
    """Write ``value, timestamp`` JSON lines, several files so a stream sees batches."""
    (df.select("value", F.timestamp_millis("arrival_ms").alias("timestamp"))
       .repartition(n_files).write.mode("overwrite").json(path))


def test_dau_stream_equals_batch(spark, scratch):
    src = os.path.join(scratch, "startup")
    _write_lines(td.log_lines(spark, SF001), src)
    lines = streams.read_topic(spark, "CAT_STARTUP", fmt="json", path=src)
    table = os.path.join(scratch, "dau")
    q = jobs.start_dau(lines, table, available_now=True, checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination(240)
    progress = [p for p in q.recentProgress if p.get("observedMetrics")]
    assert sum(int(p["observedMetrics"]["dau_rows"]["n_rejected"]) for p in progress) == 0
    n_in = sum(int(p["observedMetrics"]["dau_in"]["n_in"]) for p in progress)
    n_new = sum(int(p["observedMetrics"]["dau_new"]["n_new"]) for p in progress)
    got = tables.dau_table(spark, table)
    want = dau.dedup_daily(td.startup_log(spark, SF001))
    assert got.count() == want.count()
    assert rows(got, "mid", "log_date", "ts", "uid", "log_hour") == rows(want, "mid", "log_date", "ts", "uid", "log_hour")
    assert n_in == td.log_lines(spark, SF001).count()
    assert n_new == want.count()

    # a later batch repeating devices of the last day adds nothing; restart keeps state
    last_day = want.agg(F.max("log_date")).first()[0]
    again = td.log_lines(spark, SF001).join(
        td.startup_log(spark, SF001).filter(F.col("log_date") == last_day).select("event_id"), "event_id")
    _write_lines(again.withColumn("arrival_ms", F.col("arrival_ms") + 1), os.path.join(src, "more"), 1)
    lines2 = streams.read_topic(spark, "CAT_STARTUP", fmt="json", path=src + "/*")
    q = jobs.start_dau(lines2, table, available_now=True, checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination(240)
    assert tables.dau_table(spark, table).count() == want.count()


def test_alert_stream_equals_batch(spark, scratch):
    src = os.path.join(scratch, "events")
    _write_lines(td.log_lines(spark, SF001), src, n_files=1)
    lines = streams.read_topic(spark, "CAT_EVENT", fmt="json", path=src)
    # a late sentinel event far in the future closes every open window
    sentinel = spark.createDataFrame(
        [('{"type":"event","mid":"mid_sentinel","uid":"0","evid":"view","ts":1900000000000}',)],
        "value string").withColumn("timestamp", F.current_timestamp())
    sentinel.write.mode("append").json(os.path.join(scratch, "events_late"))
    late = streams.read_topic(spark, "CAT_EVENT", fmt="json", path=os.path.join(scratch, "events_late"))
    out = os.path.join(scratch, "alerts")
    q = jobs.start_alerts(lines.unionByName(late), out, window="3 days", slide="1 day",
                          lateness="0 seconds", available_now=True,
                          checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination(240)
    got = upsert.read_latest(spark, out, ["alert_id"], ["ts", "window_start"])
    want = alerts.coupon_alerts(td.event_log(spark, SF001), window="3 days", slide="1 day")
    key = lambda df: rows(df.select("mid", "window_start", F.array_join(F.array_sort("uids"), ",")))
    assert key(got) == key(want)
    assert got.count() > 0


def test_sale_stream_interval_join_equals_batch(spark, scratch):
    o_src, d_src = os.path.join(scratch, "orders"), os.path.join(scratch, "details")
    _write_lines(td.order_lines(spark, SF001), o_src, 1)
    _write_lines(td.detail_lines(spark, SF001), d_src, 1)
    o = streams.read_topic(spark, "CAT_ORDER", fmt="json", path=o_src)
    d = streams.read_topic(spark, "CAT_ORDER_DETAIL", fmt="json", path=d_src)
    j = jobs.sale_stream(o, d)
    q = (j.writeStream.format("memory").queryName("sale_stream_t").outputMode("append")
          .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(240)
    got = spark.table("sale_stream_t")
    want = sales.interval_join(td.orders(spark, SF001), td.details(spark, SF001))
    assert rows(got, "order_detail_id", "order_id") == rows(want, "order_detail_id", "order_id")


def test_sales_job_enriches_with_users_and_restart_is_idempotent(spark, scratch):
    o_src, d_src, u_src = (os.path.join(scratch, x) for x in ("o", "d", "u"))
    _write_lines(td.order_lines(spark, SF001), o_src, 1)
    _write_lines(td.detail_lines(spark, SF001), d_src, 1)
    ul = td.user_lines(spark, SF001).withColumn("arrival_ms", F.col("seq").cast("long") * 1000)
    _write_lines(ul, u_src, 1)
    users_tbl, sale_tbl = os.path.join(scratch, "users"), os.path.join(scratch, "sale")
    uq = jobs.start_users(streams.read_topic(spark, "CAT_USER", fmt="json", path=u_src), users_tbl,
                          available_now=True, checkpoint=os.path.join(scratch, "ck_u"))
    uq.awaitTermination(240)
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp")
    for _ in range(2):  # second start resumes from the checkpoint: nothing new, nothing doubled
        q = jobs.start_sales(streams.read_topic(spark, "CAT_ORDER", fmt="json", path=o_src),
                             streams.read_topic(spark, "CAT_ORDER_DETAIL", fmt="json", path=d_src),
                             users_tbl, sale_tbl, as_of=as_of, available_now=True,
                             checkpoint=os.path.join(scratch, "ck_s"))
        q.awaitTermination(240)
    got = tables.sale_table(spark, sale_tbl)
    assert spark.read.parquet(sale_tbl).count() == got.count()
    one_day = got.agg(F.min("dt")).first()[0]
    assert tables.sale_table(spark, sale_tbl, [one_day]).count() == got.filter(F.col("dt") == one_day).count()
    want = sales.with_user(sales.interval_join(td.orders(spark, SF001), td.details(spark, SF001)),
                           sales.user_latest(td.user_changes(spark, SF001)), as_of)
    # the sink keeps one row per order_detail_id (the fixture repeats one detail id)
    assert rows(got.select(*sales.SALE_COLUMNS)) == rows(sales.one_per_detail(want))


def test_order_and_cdc_and_intake_streams_run(spark, scratch):
    o_src = os.path.join(scratch, "o")
    _write_lines(td.order_lines(spark, SF001), o_src, 2)
    q = jobs.start_orders(streams.read_topic(spark, "CAT_ORDER", fmt="json", path=o_src),
                          os.path.join(scratch, "order_tbl"), available_now=True,
                          checkpoint=os.path.join(scratch, "ck_o"))
    q.awaitTermination(240)
    assert spark.read.parquet(os.path.join(scratch, "order_tbl")).count() == td.orders(spark, SF001).count()

    l_src = os.path.join(scratch, "logs")
    lines = td.log_lines(spark, SF001, with_ts=False)
    _write_lines(lines, l_src, 2)
    q = jobs.start_intake(streams.read_topic(spark, "logs", fmt="json", path=l_src),
                          os.path.join(scratch, "archive"), topics_fmt="json",
                          topics_path=os.path.join(scratch, "topics"),
                          arrival_col=None, available_now=True, checkpoint=os.path.join(scratch, "ck_i"))
    q.awaitTermination(240)
    topics = spark.read.json(os.path.join(scratch, "topics"))
    assert topics.count() == lines.count()
    assert {r.topic for r in topics.select("topic").distinct().collect()} == {"CAT_STARTUP", "CAT_EVENT"}


def test_kpi_reads_only_the_report_days(spark, scratch):
    """DAU table written by the stream, KPI read back with partition pruning."""
    from shopstream.operators import kpi
    src = os.path.join(scratch, "startup")
    _write_lines(td.log_lines(spark, SF001), src, 1)
    table = os.path.join(scratch, "dau")
    q = jobs.start_dau(streams.read_topic(spark, "CAT_STARTUP", fmt="json", path=src), table,
                       available_now=True, checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination(240)
    day = "2024-01-15"
    stored = tables.dau_table(spark, table, [kpi.yesterday_of(day), day])
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "log_date" in plan
    got = rows(kpi.dau_hourly_compare(stored, day))
    want = rows(kpi.dau_hourly_compare(dau.dedup_daily(td.startup_log(spark, SF001)), day))
    assert got == want and got


def test_cdc_stream_publishes_what_batch_routes(spark, scratch):
    from shopstream.operators import routing
    from shopstream.schemas import CDC_ENTRY_SCHEMA
    src = os.path.join(scratch, "cdc")
    td.cdc_entries(spark, SF001).repartition(3).write.parquet(src)
    entries = spark.readStream.schema(CDC_ENTRY_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    out = os.path.join(scratch, "topics")
    q = jobs.start_cdc(entries, topics_fmt="json", topics_path=out, available_now=True,
                       checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination(240)
    got = spark.read.json(out)
    want = routing.cdc_after_json(routing.cdc_route(routing.cdc_explode(td.cdc_entries(spark, SF001))))
    assert rows(got, "topic", "value") == rows(want, "topic", "value")


def test_alert_stream_default_windows_equal_batch(spark, scratch):
    """5 min / 10 s windows (the upstream sizes) on time-compressed events."""
    base = 1_704_067_200_000
    ev = td.event_log(spark, SF001).withColumn(
        "ts", (F.lit(base) + (F.col("ts") - F.lit(base)) / F.lit(2000)).cast("long"))
    lines = ev.select(F.to_json(F.struct("type", "mid", "uid", "evid", "itemid", "ts")).alias("value"),
                      F.col("ts").alias("arrival_ms"))
    src = os.path.join(scratch, "events")
    _write_lines(lines, src, 1)
    sentinel = spark.createDataFrame(
        [('{"type":"event","mid":"mid_sentinel","uid":"0","evid":"view","ts":1900000000000}',)],
        "value string").withColumn("timestamp", F.current_timestamp())
    sentinel.write.json(os.path.join(scratch, "late"))
    stream = streams.read_topic(spark, "CAT_EVENT", fmt="json", path=src).unionByName(
        streams.read_topic(spark, "CAT_EVENT", fmt="json", path=os.path.join(scratch, "late")))
    q = (jobs.alert_stream(stream, lateness="0 seconds").writeStream.format("memory")
         .queryName("alerts_5m").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(240)
    got = spark.table("alerts_5m")
    want = alerts.coupon_alerts(ev)

    def key(df):
        return rows(df.select("mid", "window_start", "n_uids", F.array_join(F.array_sort("uids"), ",").alias("u"),
                              alerts.event_counts_text().alias("e")))
    assert len(key(want)) > 0
    assert key(got) == key(want)


def test_launcher_jobs_feed_the_reports(spark, scratch):
    """Jobs started from the command-line launcher; both reports read the tables."""
    import json

    from shopstream.operators import kpi, orders as order_ops
    from shopstream.plans import reports
    from shopstream.streaming import apps

    logs_src, orders_src = os.path.join(scratch, "logs"), os.path.join(scratch, "orders")
    _write_lines(td.log_lines(spark, SF001), logs_src, 2)
    _write_lines(td.order_lines(spark, SF001), orders_src, 2)
    dau_tbl, order_tbl = os.path.join(scratch, "dau"), os.path.join(scratch, "orders_tbl")
    apps.main(["dau", "--source-path", logs_src, "--table", dau_tbl, "--available-now",
               "--checkpoint", os.path.join(scratch, "ck1")])
    apps.main(["orders", "--source-path", orders_src, "--table", order_tbl, "--available-now",
               "--checkpoint", os.path.join(scratch, "ck2")])

    day = "2024-01-15"
    want_dau = dau.dedup_daily(td.startup_log(spark, SF001))
    got = rows(reports.realtime_hour(spark, dau_tbl, order_tbl, day, "dau"))
    assert got == rows(kpi.dau_hourly_compare(want_dau, day)) and got

    oday = td.orders(spark, SF001).agg(F.max("create_date")).first()[0]
    got_o = rows(reports.realtime_hour(spark, dau_tbl, order_tbl, oday, "order"))
    assert got_o == rows(kpi.order_hourly_compare(order_ops.enrich_orders(td.orders(spark, SF001)), oday))
    doc = json.loads(reports.realtime_total(spark, dau_tbl, order_tbl, day, as_json=True).first().doc)
    assert doc[0]["value"] == want_dau.filter(F.col("log_date") == day).count()
    assert reports.realtime_hour(spark, dau_tbl, order_tbl, day, "other") is None


def test_change_feed_to_user_table_end_to_end(spark, scratch):
    """CDC entries -> topic files -> user job -> latest user rows, as the batch form."""
    from shopstream.schemas import CDC_ENTRY_SCHEMA
    src = os.path.join(scratch, "cdc")
    td.cdc_entries(spark, SF001).filter(F.col("table") == "user_info").write.parquet(src)
    topics = os.path.join(scratch, "topics")
    q = jobs.start_cdc(spark.readStream.schema(CDC_ENTRY_SCHEMA).parquet(src), topics_fmt="json",
                       topics_path=topics, available_now=True, checkpoint=os.path.join(scratch, "ck1"))
    q.awaitTermination(240)
    users_tbl = os.path.join(scratch, "users")
    q = jobs.start_users(streams.read_topic(spark, "CAT_USER", fmt="json", path=topics), users_tbl,
                         available_now=True, checkpoint=os.path.join(scratch, "ck2"))
    q.awaitTermination(240)
    stored = tables.keyed_table(spark, users_tbl, "id", ["timestamp", "offset"])
    # one batch carries both versions of a VIP user: the table keeps one row per id
    assert stored.count() == stored.select("id").distinct().count()
    want = sales.user_latest(td.user_changes(spark, SF001))
    assert rows(stored, "id", "user_level") == rows(want, "id", "user_level")


def test_compacted_dau_table_reads_the_same(spark, scratch):
    src = os.path.join(scratch, "startup")
    _write_lines(td.log_lines(spark, SF001), src, 2)
    table, snap = os.path.join(scratch, "dau"), os.path.join(scratch, "dau_snap")
    q = jobs.start_dau(streams.read_topic(spark, "CAT_STARTUP", fmt="json", path=src, max_per_trigger=1),
                       table, available_now=True, checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination(240)
    upsert.compact(spark, table, snap, ["mid", "log_date"], ["ts"], keep="first",
                   partition_by=["log_date"], batch_first=False)
    assert rows(tables.dau_table(spark, snap)) == rows(tables.dau_table(spark, table))


def test_raw_text_lines_through_the_intake(spark, scratch):
    src = os.path.join(scratch, "raw")
    lines = td.log_lines(spark, SF001, with_ts=False)
    lines.select("value").write.text(src)
    raw = streams.read_topic(spark, "logs", fmt="text", path=src, max_per_trigger=1)
    out = jobs.intake_stream(raw)
    q = (out.writeStream.format("memory").queryName("intake_text").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(240)
    got = spark.table("intake_text")
    assert got.count() == lines.count()
    # the server stamp (processing time) replaced any client time; routing follows the type
    assert got.filter(F.col("ts").isNull()).count() == 0
    assert rows(got.groupBy("topic").count(), "topic", "count") == \
        rows(routing_counts(lines), "topic", "count")


def routing_counts(lines):
    from shopstream.operators import routing
    routed = routing.route_logs(routing.stamp_logs(lines, F.col("arrival_ms")))
    return routed.groupBy("topic").count()


def test_order_and_detail_in_different_batches_meet_in_join_state(spark, scratch):
    """The upstream cached the side that arrived first for 60 s; here the join state
    holds the order until its detail arrives in a later micro-batch."""
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1, 12, 0, 0)
    orders = spark.createDataFrame(
        [('{"id":"1","user_id":"7","order_status":"1","total_amount":"5.0","create_time":"2024-01-01 12:00:00",'
          '"consignee_tel":"13500000007"}', t0),
         ('{"id":"2","user_id":"7","order_status":"1","total_amount":"6.0","create_time":"2024-01-01 12:00:00",'
          '"consignee_tel":"13500000007"}', t0)], "value string, timestamp timestamp")
    details = spark.createDataFrame(
        [('{"id":"d1","order_id":"1","sku_id":"s","sku_name":"n","order_price":"1.5","sku_num":"1"}',
          t0 + dt.timedelta(seconds=30)),
         ('{"id":"d2","order_id":"2","sku_id":"s","sku_name":"n","order_price":"2.5","sku_num":"1"}',
          t0 + dt.timedelta(seconds=90))], "value string, timestamp timestamp")
    o_src, d_src = os.path.join(scratch, "o"), os.path.join(scratch, "d")
    orders.write.json(o_src)
    details.limit(0).write.json(d_src)  # the detail topic exists but is empty at first

    def run():
        o = streams.read_topic(spark, "CAT_ORDER", fmt="json", path=o_src)
        d = streams.read_topic(spark, "CAT_ORDER_DETAIL", fmt="json", path=d_src + "*")
        out = os.path.join(scratch, "out")
        q = (jobs.sale_stream(o, d).writeStream.format("parquet").option("path", out).outputMode("append")
             .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
        q.awaitTermination(240)
        return {r.order_detail_id for r in spark.read.parquet(out).collect()}

    assert run() == set()           # batch with the orders only: nothing to join yet
    details.write.json(d_src + "_later")
    assert run() == {"d1"}          # the detail 30 s later meets the order kept in state; 90 s is too late
