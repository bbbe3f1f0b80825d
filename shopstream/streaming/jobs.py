"""Structured Streaming jobs: the batch operators on streaming DataFrames.

Each ``*_stream`` function builds the streaming DataFrame (testable on its own with a
memory sink); each ``start_*`` function attaches the idempotent sink, a checkpoint
under the session's checkpoint folder, and the trigger (5 s micro-batches by
default, ``available_now=True`` to drain what is there and stop).

Event time: log records carry epoch-millis ``ts``; orders, details and users carry
no usable event time, so their stream arrival ``timestamp`` plays that role (the
upstream cache TTL was measured on arrival too). Watermarks bound every state store:
the device dedup keeps a key for one day plus lateness, the alert windows are
emitted once the watermark passes their end, the order/detail join keeps rows for
the join tolerance plus lateness.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopstream import schemas
from shopstream.functions import masking, parse, timefmt
from shopstream.operators import alerts, routing, sales, upsert
from shopstream.session import checkpoint_path
from shopstream.sources import tables
from shopstream.streaming import sinks

DEFAULT_TRIGGER = "5 seconds"


def start(df: DataFrame, name: str, batch_fn, *, target: str | None, checkpoint: str | None = None,
           source: str | None = None, trigger: str = DEFAULT_TRIGGER, available_now: bool = False,
           output_mode: str = "append") -> StreamingQuery:
    """Start a job. Without ``checkpoint`` it is kept under the session's checkpoint folder, for this job on
    this ``target`` and ``source``."""
    spark = df.sparkSession
    writer = (df.writeStream.queryName(name).outputMode(output_mode)
                .option("checkpointLocation", checkpoint or checkpoint_path(spark, name, target, source))
                .foreachBatch(batch_fn))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start()


def counted(df: DataFrame, name: str, valid) -> DataFrame:
    """The valid rows; how many came in and how many were rejected is reported with each batch."""
    return df.observe(name, F.count(F.lit(1)).alias("n_in"), F.count_if(~valid).alias("n_rejected")).filter(valid)


def rejected_lines(lines: DataFrame, job: str) -> DataFrame:
    """Lines of a job's topic that its parser cannot use, with their text."""
    raw = lines.select("value", F.col("value").alias("raw"), "timestamp")
    if job == "cdc":
        entry = F.from_json("value", schemas.CDC_ENTRY_SCHEMA)
        return raw.filter(~valid_entry(entry)).select(F.col("raw").alias("value"), "timestamp")
    return PARSERS[job][0](raw).filter(~valid(job)).select(F.col("raw").alias("value"), "timestamp")


def start_rejects(lines: DataFrame, job: str, path: str, **kw) -> StreamingQuery:
    """Keep what ``job`` drops: the text of each rejected line, in a folder per batch."""
    def write(df, batch_id):
        df.write.mode("overwrite").json(sinks.batch_folder(df, path, batch_id))
    return start(rejected_lines(lines, job), f"{job}-rejects", write, target=path, **kw)


# ---------------------------------------------------------------------------------
# intake: stamp, archive, route


def intake_stream(lines: DataFrame, arrival_col: str | None = None) -> DataFrame:
    """Raw log lines -> stamped lines with ``topic`` and archive partition ``log_date``; lines that are no
    JSON object have no topic and keep their text.
    The server time is the processing time unless ``arrival_col`` (epoch ms) is given."""
    arrival = F.col(arrival_col) if arrival_col else F.unix_millis(F.current_timestamp())
    stamped = routing.stamp_lines(lines, arrival)
    return routing.route_logs(stamped).withColumn("topic", F.when(~F.col("rejected"), F.col("topic")))


def start_intake(lines: DataFrame, archive_path: str, *, topics_fmt: str = "kafka",
                 topics_path: str | None = None, bootstrap_servers: str | None = None,
                 arrival_col: str | None = None, rejects_path: str | None = None, **kw) -> StreamingQuery:
    """Archive every stamped line (JSON, partitioned by ``log_date``), publish it to its topic, and keep the
    rejected lines as they came in ``rejects_path`` (default: next to the archive), from one computation of
    each micro-batch."""
    rejects = rejects_path or f"{archive_path.rstrip('/')}_rejects"

    def write_text(df, path, batch_id):
        df.select("log_date", "value").write.mode("overwrite").partitionBy("log_date").text(sinks.batch_folder(df, path, batch_id))

    def archive(df, batch_id):
        write_text(df.filter(F.col("topic").isNotNull()), archive_path, batch_id)

    def publish(df, batch_id):
        sinks.write_topics(df.filter(F.col("topic").isNotNull()).drop("timestamp").withColumn("key", _json_key("mid")), batch_id, fmt=topics_fmt,
                           path=topics_path, bootstrap_servers=bootstrap_servers)

    def reject(df, batch_id):
        write_text(df.filter(F.col("topic").isNull()), rejects, batch_id)

    out = intake_stream(lines, arrival_col).observe("intake", F.count(F.lit(1)).alias("n_in"), F.count_if("rejected").alias("n_rejected"))
    return start(out, "intake", sinks.fan_out(archive, publish, reject), target=archive_path, **kw)


def _json_key(field: str):
    return F.get_json_object("value", f"$.{field}")


# ---------------------------------------------------------------------------------
# daily active devices


def dau_stream(lines: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Startup lines -> earliest record per ``(mid, log_date)``, as a watermarked
    streaming aggregate (``min`` of a struct led by ``ts``) in update mode: a device is
    emitted when first seen and again only if an earlier record arrives late. The
    day window carries the event time, so a device's state is dropped ``lateness``
    after its day has closed."""
    logs = counted(parse.parse_startup(lines.select("value")), "dau_rows", valid("dau"))
    timed = logs.withColumn("event_time", timefmt.ms_to_ts("ts")).withWatermark("event_time", lateness)
    payload = [c for c in schemas.DAU_COLUMNS if c not in ("mid", "log_date", "ts")]
    first = (timed.groupBy("mid", "log_date", F.window("event_time", "1 day").alias("day"))
                  .agg(F.min(F.struct("ts", *payload)).alias("_first")))
    return first.select("mid", "log_date", "_first.*").select(*schemas.DAU_COLUMNS)


def dau_first_seen_stream(lines: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Startup lines -> the first record of each ``(mid, log_date)`` to arrive, once, in append mode. The state is the key and
    when it may go, no record: smaller than that of ``dau_stream``, which also takes back a record for an earlier one that
    comes late. A key is held for a day plus ``lateness`` after its event time, so all of its day falls on it."""
    logs = counted(parse.parse_startup(lines.select("value")), "dau_rows", valid("dau"))
    timed = logs.withColumn("event_time", timefmt.ms_to_ts("ts")).withWatermark("event_time", _day_and(lateness))
    return timed.dropDuplicatesWithinWatermark(["mid", "log_date"]).select(*schemas.DAU_COLUMNS)


def _day_and(lateness: str) -> str:
    return f"{86_400_000 + alerts.duration_ms(lateness)} milliseconds"


def start_dau(lines: DataFrame, table_path: str, first_seen: bool = False, **kw) -> StreamingQuery:
    """Write new devices to the DAU table (partitioned by ``log_date``); readers keep
    the earliest record per device and day (``sources.tables.dau_table``). ``first_seen`` takes records in the order
    of their arrival, with less state."""
    observed = lines.observe("dau_in", F.count(F.lit(1)).alias("n_in"))
    devices = dau_first_seen_stream(observed) if first_seen else dau_stream(observed)
    out = devices.observe("dau_new", F.count(F.lit(1)).alias("n_new"))
    sink = sinks.upsert_sink(table_path, ["mid", "log_date"], ["ts"], keep="first", partition_by=["log_date"])
    kw.setdefault("output_mode", "append" if first_seen else "update")
    return start(out, "dau", sink, target=table_path, **kw)


# ---------------------------------------------------------------------------------
# order landing


def order_stream(lines: DataFrame) -> DataFrame:
    """Order lines -> 20-column order rows (tail-masked phone, date and hour split), with ``timestamp`` and ``offset``."""
    parsed = counted(parse.parse_order(lines.select("value", "timestamp", "offset"), mask=masking.mask_tel_tail), "orders_rows", valid("orders"))
    return parsed.select(*schemas.ORDER_TABLE_COLUMNS, "timestamp", "offset")


def start_orders(lines: DataFrame, table_path: str, **kw) -> StreamingQuery:
    sink = sinks.upsert_sink(table_path, ["id"], ["timestamp", "offset"], partition_by=["create_date"])
    return start(order_stream(lines), "orders", sink, target=table_path, **kw)


# ---------------------------------------------------------------------------------
# coupon alerts


def alert_stream(lines: DataFrame, window: str = alerts.DEFAULT_WINDOW,
                 slide: str = alerts.DEFAULT_SLIDE, lateness: str = "1 minute",
                 min_uids: int = alerts.DEFAULT_MIN_UIDS, click_col: str = "evid") -> DataFrame:
    """Event lines -> alerts, emitted once per window when the watermark passes its end."""
    ev = alerts.usable(counted(parse.parse_event(lines.select("value")), "alerts_rows", valid("alerts")))
    timed = ev.withColumn("event_time", timefmt.ms_to_ts("ts")).withWatermark("event_time", lateness)
    is_coupon, is_click = alerts.rule_columns(click_col)
    # 1) tumbling slide-sized panes per (mid, evid): raw events are aggregated once;
    # 2) sliding windows over the pane rows (their event time is window_time(pane)),
    #    so only pane rows - not raw events - are copied into the window/slide windows.
    per_pane = (timed.groupBy("mid", F.window("event_time", slide).alias("pane"), "evid")
                     .agg(F.collect_set(F.when(is_coupon, F.col("uid"))).alias("c_uids"),
                          F.collect_set(F.when(is_coupon, F.col("itemid"))).alias("c_items"),
                          F.bool_or(is_click).alias("clicked"),
                          F.count(F.lit(1)).alias("n")))
    windows = (per_pane.groupBy("mid", F.window(F.window_time("pane"), window, slide).alias("window"))
                       .agg(*alerts.merged_sets())
                       .withColumn("window_start", F.col("window.start")).withColumn("window_end", F.col("window.end")))
    return alerts.finish_alerts(windows, min_uids).withColumn(
        "alert_id", alerts.alert_id(F.col("mid"), F.col("ts")))


def alert_windows_stream(lines: DataFrame, window: str = alerts.DEFAULT_WINDOW, slide: str = alerts.DEFAULT_SLIDE,
                         lateness: str = "1 minute", min_uids: int = alerts.DEFAULT_MIN_UIDS, click_col: str = "evid") -> DataFrame:
    """Event lines -> alerting windows without their lists, from state of bounded size per pane and window."""
    ev = alerts.usable(counted(parse.parse_event(lines.select("value")), "alerts_rows", valid("alerts")))
    timed = ev.withColumn("event_time", timefmt.ms_to_ts("ts")).withWatermark("event_time", lateness)
    return alerts.alerting_windows(timed, window, slide, min_uids, click_col)


def archived_events(spark: SparkSession, archive_path: str, days: list[str]) -> DataFrame:
    """Event records of the intake's archive, from the folders of these days."""
    lines = spark.read.schema("value string, gen string, batch_id string, log_date string").text(archive_path)
    parsed = parse.parse_event(lines.filter(F.col("log_date").isin(*days)).select("value"))
    return parsed.filter(~F.col("type").eqNullSafe("startup"))


def start_alerts(lines: DataFrame, index_path: str, archive: str | None = None, **kw) -> StreamingQuery:
    """Write alerts keyed ``mid_<minute>``; a later window in the same minute overwrites.

    With ``archive`` (the folder of the intake job, which archives lines before it publishes them) the state only decides which windows
    alert, and their lists are read from the archived days of these windows; events that came too late for the decision are in
    the lists. Without it the state keeps the lists of every open window."""
    opts = {k: kw.pop(k) for k in ("window", "slide", "lateness", "min_uids", "click_col") if k in kw}
    if archive is None:
        out = alert_stream(lines, **opts).observe("alerts_new", F.count(F.lit(1)).alias("n_new"))
        return start(out, "alerts", sinks.upsert_sink(index_path, ["alert_id"], ["ts", "window_start"]), target=index_path, **kw)
    click_col = opts.get("click_col", "evid")

    def write(df, batch_id):
        df.persist()
        try:
            spans = df.select(F.explode(F.sequence(F.to_date("window_start"), F.to_date("window_end"))).alias("day")).distinct().collect()
            if not spans:  # no window alerts
                return
            events = archived_events(df.sparkSession, archive, sorted(str(r["day"]) for r in spans))
            found = alerts.with_lists(df, events, click_col).withColumn("alert_id", alerts.alert_id(F.col("mid"), F.col("ts")))
            upsert.write_batch(found, index_path, batch_id, ["alert_id"], ["ts", "window_start"], writer=upsert.query_id(df))
        finally:
            df.unpersist()

    out = alert_windows_stream(lines, **opts).observe("alerts_new", F.count(F.lit(1)).alias("n_new"))
    return start(out, "alerts", write, target=index_path, **kw)


# ---------------------------------------------------------------------------------
# sales: orders x details (interval join), then the latest user row


def user_stream(lines: DataFrame) -> DataFrame:
    return counted(parse.parse_user(lines.select("value", "timestamp", "offset")), "users_rows", valid("users"))


def start_users(lines: DataFrame, table_path: str, **kw) -> StreamingQuery:
    """Keep the latest row per user id (later arrivals overwrite)."""
    sink = sinks.upsert_sink(table_path, ["id"], ["timestamp", "offset"])
    return start(user_stream(lines), "users", sink, target=table_path, **kw)


def _sale_sides(order_lines: DataFrame, detail_lines: DataFrame, tolerance_s: int, lateness: str) -> tuple[DataFrame, DataFrame, Column]:
    """Watermarked orders and details, and their join condition: the order id, and arrivals within the tolerance."""
    o = counted(parse.parse_order(order_lines.select("value", "timestamp"), mask=masking.mask_tel_head), "sale_orders_rows", valid("orders")) \
        .withColumn("ts", F.unix_millis("timestamp"))
    d = counted(parse.parse_detail(detail_lines.select("value", "timestamp")), "sale_details_rows", valid("details")) \
        .withColumn("ts", F.unix_millis("timestamp"))
    o = sales.order_side(o, "timestamp").withColumnRenamed("timestamp", "o_time").withWatermark("o_time", lateness)
    d = sales.detail_side(d, "timestamp").withColumnRenamed("timestamp", "d_time").withWatermark("d_time", lateness)
    tol = F.expr(f"INTERVAL {int(tolerance_s)} SECONDS")
    return o, d, (o.o_id == d.order_id) & (d.d_time >= o.o_time - tol) & (d.d_time <= o.o_time + tol)


def sale_stream(order_lines: DataFrame, detail_lines: DataFrame,
                tolerance_s: int = sales.DEFAULT_TOLERANCE_S, lateness: str = "1 minute") -> DataFrame:
    """Stream-stream interval join of orders and details on the order id with
    ``|detail arrival - order arrival| <= tolerance_s``; state is evicted once the
    watermark passes the tolerance."""
    o, d, cond = _sale_sides(order_lines, detail_lines, tolerance_s, lateness)
    return sales.sale_row(o.join(d, cond, "inner"))


def sale_full_stream(order_lines: DataFrame, detail_lines: DataFrame,
                     tolerance_s: int = sales.DEFAULT_TOLERANCE_S, lateness: str = "1 minute") -> DataFrame:
    """The same join FULL OUTER: pairs as they meet, and each order or detail that never meets another side once, when
    the watermark says that none can come any more (``match_kind`` tells). Columns as ``sales.interval_full_join``."""
    o, d, cond = _sale_sides(order_lines, detail_lines, tolerance_s, lateness)
    return sales.full_rows(o.join(d, cond, "full_outer"))


def start_unmatched(order_lines: DataFrame, detail_lines: DataFrame, path: str,
                    tolerance_s: int = sales.DEFAULT_TOLERANCE_S, lateness: str = "1 minute", **kw) -> StreamingQuery:
    """Report the orders and details that the sales job drops, in a folder per batch, partitioned by ``match_kind``; how many pairs and
    how many of each kind there are is observed."""
    rows = sale_full_stream(order_lines, detail_lines, tolerance_s, lateness)
    kinds = [F.count_if(F.col("match_kind") == k).alias(f"n_{k}") for k in ("both", "order_only", "detail_only")]

    def write(df, batch_id):
        df.filter(F.col("match_kind") != "both").write.mode("overwrite").partitionBy("match_kind").json(sinks.batch_folder(df, path, batch_id))
    return start(rows.observe("sale_matches", *kinds), "unmatched", write, target=path, **kw)


def start_sales(order_lines: DataFrame, detail_lines: DataFrame, user_table: str | list[str], sale_index: str,
                as_of=None, **kw) -> StreamingQuery:
    """Each batch of joined sales is enriched with the user table as it is at that
    moment (re-read per batch, so user updates written by ``start_users`` are seen)
    and written keyed by ``order_detail_id``, partitioned by the order date ``dt``. ``user_table`` may be
    several folders, e.g. a snapshot and what was written after it."""
    def write(df, batch_id):
        df.persist()
        try:
            _write_sales(df, user_table, sale_index, batch_id, as_of)
        finally:
            df.unpersist()

    return start(sale_stream(order_lines, detail_lines), "sales", write, target=sale_index, **kw)


def _write_sales(sale_rows: DataFrame, user_table: str | list[str], sale_index: str, batch_id: int, as_of=None) -> None:
    """Sales of one micro-batch with the users as the table has them now, keyed by ``order_detail_id``."""
    spark = sale_rows.sparkSession
    users = _read_users(spark, user_table, sale_rows.select(F.col("user_id").alias("id")).distinct())
    when = as_of if as_of is not None else F.current_timestamp()
    wide = sales.one_per_detail(sales.with_user(sale_rows, users, when))
    upsert.write_batch(wide, sale_index, batch_id, ["order_detail_id"], ["create_time"], partition_by=["dt"],
                       writer=upsert.query_id(sale_rows))


def sales_topics_stream(lines: DataFrame, tolerance_s: int = sales.DEFAULT_TOLERANCE_S, lateness: str = "1 minute") -> DataFrame:
    """Lines of the order, detail and user topics (with their ``topic``) -> rows ``kind, sale, user``: the joined sales, and the
    user changes as they are."""
    def of(topic):
        return lines.filter(F.col("topic") == topic)
    sale = sale_stream(of(routing.TOPIC_ORDER), of(routing.TOPIC_ORDER_DETAIL), tolerance_s, lateness)
    user = user_stream(of(routing.TOPIC_USER))
    users = user.select(F.lit("user").alias("kind"), F.struct(*[F.col(c) for c in schemas.USER_TABLE.names]).alias("user"))
    rows = sale.select(F.lit("sale").alias("kind"), F.struct(*[F.col(c) for c in sales.SALE_COLUMNS_NO_USER]).alias("sale"))
    return rows.unionByName(users, allowMissingColumns=True)


def start_sales_topics(lines: DataFrame, user_table: str, sale_index: str, as_of=None,
                       tolerance_s: int = sales.DEFAULT_TOLERANCE_S, lateness: str = "1 minute", **kw) -> StreamingQuery:
    """One job over the three topics: each micro-batch first writes its user changes to ``user_table`` and then its sales, so a sale
    sees the users that came with it. Both writes replace their own folder when a batch is replayed."""
    def write(df, batch_id):
        df.persist()
        try:
            users = df.filter(F.col("kind") == "user").select("user.*")
            upsert.write_batch(users, user_table, batch_id, ["id"], ["timestamp", "offset"], writer=upsert.query_id(df))
            _write_sales(df.filter(F.col("kind") == "sale").select("sale.*"), user_table, sale_index, batch_id, as_of)
        finally:
            df.unpersist()

    return start(sales_topics_stream(lines, tolerance_s, lateness), "sales-topics", write, target=f"{user_table} {sale_index}", **kw)


def _read_users(spark: SparkSession, user_table: str | list[str], ids: DataFrame) -> DataFrame:
    """Latest user rows for the ids of one micro-batch: the table is semi-joined with
    the batch's ids before the per-id reduction, so the aggregation only sees the
    users the batch needs. A folder that is not there yet, or has empty batches only, has no users; one that
    cannot be read fails the batch, which is then tried again."""
    folders = [user_table] if isinstance(user_table, str) else list(user_table)
    found = [f for f in folders if upsert.path_exists(spark, f)]
    if not found:
        return spark.createDataFrame([], schemas.USER_SCHEMA)
    return tables.user_table(spark, found, only=ids)


# ---------------------------------------------------------------------------------
# change feed routing


def cdc_stream(entries: DataFrame) -> DataFrame:
    """Change entries -> ``topic, key, value, timestamp`` rows for the published changes; the key is the row's
    first column (its id), the timestamp the change time, so consumers can order versions of a row."""
    read = counted(entries, "cdc_entries", F.col("entry_type").isNotNull())
    routed = routing.cdc_route(routing.cdc_explode(read))
    return routing.cdc_after_json(routed).select(
        "topic", F.col("after")[0]["value"].alias("key"), "value", timefmt.ms_to_ts("ts").alias("timestamp"))


def start_cdc(entries: DataFrame, *, topics_fmt: str = "kafka", topics_path: str | None = None,
              bootstrap_servers: str | None = None, **kw) -> StreamingQuery:
    def publish(df, batch_id):
        sinks.write_topics(df, batch_id, fmt=topics_fmt, path=topics_path,
                           bootstrap_servers=bootstrap_servers)
    return start(cdc_stream(entries), "cdc", publish, target=topics_path or bootstrap_servers, **kw)


def valid_entry(entry: Column) -> Column:
    """Whether a line was a change entry: every entry names its type."""
    return F.coalesce(entry["entry_type"].isNotNull(), F.lit(False))


# Parser and required fields of each job's topic.
PARSERS = {
    "dau": (parse.parse_startup, ["mid"]),
    "alerts": (parse.parse_event, ["mid"]),
    "orders": (parse.parse_order, ["id"]),
    "details": (parse.parse_detail, ["id", "order_id"]),
    "users": (parse.parse_user, ["id"]),
}


def valid(job: str) -> Column:
    return reduce(and_, [parse.valid_record(key) for key in PARSERS[job][1]])
