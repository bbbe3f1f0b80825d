"""Coupon-fraud alert over sliding windows.

Rule per device (``mid``) and window: more than ``min_uids`` distinct users took a
coupon (``evid = 'coupon'``) and no event of the window is an item click. The alert
carries the distinct coupon users, the distinct coupon item ids and the event mix.

Batch plan: when the window is a multiple of the slide, every window is a union of
consecutive slide-sized panes. Events are first reduced to distinct ``(mid, pane, evid,
coupon uid, coupon item)`` rows - map-side combined, so a device that holds a third of all
rows is reduced before the shuffle - and only those rows are copied into the
``window/slide`` windows that contain them. Distinct uids are counted in two hash
aggregates and the threshold and the click rule are applied to these counts; the lists of an
alert are collected for the surviving windows alone. Other windows (``method="window"``, or a
window that is no multiple of the slide) take ``F.window`` on the events and the same steps.

Semantics fixed here: null uids / item ids are not members of the sets (SQL set
semantics); rows without a device or an event time belong to no window; a coupon take never
counts as a click; the event list is reported as a multiset (``event_counts``: distinct
event id and count), which is bounded by the number of event kinds instead of the
number of events in the window.

``alerting_windows`` decides only which windows raise an alert, in batch and in streaming, from aggregates of
bounded size: a Theta sketch of the coupon users (exact far beyond the threshold, then a few dozen hashes) and
a click flag. ``with_lists`` then collects the lists of those windows from an archive of the events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.functions import timefmt
from shopstream.operators.dedup import latest_per_key

# The event ids of a coupon take and of an item click.
COUPON_EVID = "coupon"
CLICK_EVID = "clickItem"

DEFAULT_WINDOW = "5 minutes"
DEFAULT_SLIDE = "10 seconds"
DEFAULT_MIN_UIDS = 3

_UNIT_MS = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000,
            "day": 86_400_000, "week": 604_800_000}


def duration_ms(text: str) -> int:
    """``'5 minutes'`` / ``'10 seconds'`` / ``'1 day'`` -> milliseconds."""
    n, unit = text.strip().split()
    unit = unit.lower().rstrip("s")
    return int(float(n) * _UNIT_MS[unit])


def usable(events: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Events that can belong to a window of a device."""
    return events.filter(F.col("mid").isNotNull() & F.col(ts_col).isNotNull())


def rule_columns(click_col: str) -> tuple[Column, Column]:
    """(is a coupon take, excludes the window): the click is only looked for in rows that take no coupon."""
    is_coupon = F.coalesce(F.col("evid") == COUPON_EVID, F.lit(False))
    return is_coupon, F.coalesce(F.col(click_col) == CLICK_EVID, F.lit(False)) & ~is_coupon


def merged_sets() -> list[Column]:
    """Aggregates that merge rows with ``c_uids, c_items, clicked, evid, n`` into a window."""
    return [F.array_distinct(F.flatten(F.collect_list("c_uids"))).alias("uids"),
            F.array_distinct(F.flatten(F.collect_list("c_items"))).alias("item_ids"),
            F.bool_or("clicked").alias("clicked"),
            F.collect_list(F.struct("evid", "n")).alias("_pairs")]


def alert_rows(windows: DataFrame) -> DataFrame:
    """Output columns of the alert windows (``window_start, window_end, uids, item_ids, _pairs``)."""
    return windows.select(
        "mid", "window_start", "window_end",
        F.size("uids").cast("long").alias("n_uids"), "uids", "item_ids",
        event_mix(F.col("_pairs")).alias("event_counts"),
        # the time an alert for this window is emitted: the end of the window
        F.unix_millis("window_end").alias("ts"),
    )


def finish_alerts(windows: DataFrame, min_uids: int) -> DataFrame:
    """Threshold + no-click filter on merged windows, and the output columns."""
    return alert_rows(windows.filter((F.size("uids") > F.lit(min_uids)) & ~F.col("clicked")))


def event_mix(pairs: Column) -> Column:
    """array<struct<evid, n>> with repeats -> summed, sorted by evid."""
    kinds = F.array_sort(F.array_distinct(F.transform(pairs, lambda p: p["evid"])))
    return F.transform(kinds, lambda k: F.struct(
        k.alias("evid"),
        F.aggregate(F.filter(pairs, lambda p: p["evid"] == k), F.lit(0).cast("long"),
                    lambda acc, p: acc + p["n"]).alias("n")))


def coupon_alerts(events: DataFrame, window: str = DEFAULT_WINDOW, slide: str = DEFAULT_SLIDE,
                  min_uids: int = DEFAULT_MIN_UIDS, click_col: str = "evid",
                  ts_col: str = "ts", method: str = "panes") -> DataFrame:
    """Alerts per ``(mid, window)``. ``events`` needs ``mid, uid, evid, itemid``, the
    click column and ``ts`` (epoch millis). ``click_col="type"`` reproduces the
    upstream check on the ``type`` field."""
    win_ms, slide_ms = duration_ms(window), duration_ms(slide)
    is_coupon, is_click = rule_columns(click_col)
    facts = [F.col("evid"), F.when(is_coupon, F.col("uid")).alias("c_uid"), F.when(is_coupon, F.col("itemid")).alias("c_item")]
    events = usable(events, ts_col)
    reduced = [F.bool_or(is_click).alias("clicked"), F.count(F.lit(1)).alias("n")]
    if method == "panes" and win_ms % slide_ms == 0:
        pane = timefmt.floor_to(F.col(ts_col).cast("long"), slide_ms)
        panes = events.groupBy("mid", pane.alias("pane"), *facts).agg(*reduced)
        # each pane belongs to the windows starting at pane, pane - slide, ...
        offsets = F.sequence(F.lit(0), F.lit(win_ms // slide_ms - 1))
        placed = panes.select("*", F.explode(offsets).alias("_k")) \
                      .withColumn("ws", F.col("pane") - F.col("_k") * F.lit(slide_ms))
    else:
        w = F.window(timefmt.ms_to_ts(F.col(ts_col)), window, slide)
        placed = events.groupBy("mid", w.alias("w"), *facts).agg(*reduced) \
                       .withColumn("ws", F.unix_millis(F.col("w.start")))
    counted = (placed.groupBy("mid", "ws", "c_uid").agg(F.bool_or("clicked").alias("clicked"))
                     .groupBy("mid", "ws").agg(F.count("c_uid").alias("_uids"), F.bool_or("clicked").alias("clicked")))
    alerting = counted.filter((F.col("_uids") > F.lit(min_uids)) & ~F.col("clicked")).select("mid", "ws")
    per_evid = (placed.join(alerting, ["mid", "ws"], "left_semi").groupBy("mid", "ws", "evid")
                      .agg(F.collect_set("c_uid").alias("c_uids"), F.collect_set("c_item").alias("c_items"),
                           F.bool_or("clicked").alias("clicked"), F.sum("n").alias("n")))
    merged = per_evid.groupBy("mid", "ws").agg(*merged_sets())
    return alert_rows(merged.withColumn("window_start", timefmt.ms_to_ts(F.col("ws")))
                            .withColumn("window_end", timefmt.ms_to_ts(F.col("ws") + F.lit(win_ms))))


def sketch_bits(min_uids: int) -> int:
    """Size of the sketch of coupon users (log2 of its entries): exact up to four times the threshold at least."""
    return max(4, (4 * (min_uids + 1) - 1).bit_length())


def alerting_windows(timed: DataFrame, window: str = DEFAULT_WINDOW, slide: str = DEFAULT_SLIDE,
                     min_uids: int = DEFAULT_MIN_UIDS, click_col: str = "evid") -> DataFrame:
    """``(mid, window_start, window_end, n_uids)`` of the windows that raise an alert. ``timed`` needs ``event_time``, in a stream
    with its watermark. Only coupon takes and clicks decide, so nothing else is kept. ``n_uids`` is exact up to the size of
    the sketch, an estimate above it. The window must be a multiple of the slide."""
    is_coupon, is_click = rule_columns(click_col)
    # one predicate that reads the event time: it stays above the watermark, which all events move
    decides = F.when(F.col("event_time").isNotNull(), (is_coupon & F.col("uid").isNotNull()) | is_click)
    bits = sketch_bits(min_uids)
    panes = (timed.filter(decides).groupBy("mid", F.window("event_time", slide).alias("pane"))
                  .agg(F.theta_sketch_agg(F.when(is_coupon, F.col("uid")), bits).alias("users"), F.bool_or(is_click).alias("clicked")))
    windows = (panes.groupBy("mid", F.window(F.window_time("pane"), window, slide).alias("window"))
                    .agg(F.theta_union_agg("users", bits).alias("users"), F.bool_or("clicked").alias("clicked")))
    n_uids = F.theta_sketch_estimate("users")
    return windows.filter((n_uids > F.lit(min_uids)) & ~F.col("clicked")).select(
        "mid", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), n_uids.cast("long").alias("n_uids"))


def with_lists(windows: DataFrame, events: DataFrame, click_col: str = "evid") -> DataFrame:
    """Alerts of the given windows (``mid, window_start, window_end``), their lists collected from ``events``. Events are
    reduced to distinct facts per window before anything is collected."""
    is_coupon, is_click = rule_columns(click_col)
    facts = [F.col("evid"), F.when(is_coupon, F.col("uid")).alias("c_uid"), F.when(is_coupon, F.col("itemid")).alias("c_item")]
    spans = windows.select(F.col("mid").alias("w_mid"), "window_start", "window_end",
                           F.unix_millis("window_start").alias("w_from"), F.unix_millis("window_end").alias("w_to"))
    ev = usable(events)
    inside = ev.join(spans, (ev.mid == spans.w_mid) & (ev.ts >= spans.w_from) & (ev.ts < spans.w_to))
    per_evid = (inside.groupBy("mid", "window_start", "window_end", *facts).agg(F.bool_or(is_click).alias("clicked"), F.count(F.lit(1)).alias("n"))
                      .groupBy("mid", "window_start", "window_end", "evid")
                      .agg(F.collect_set("c_uid").alias("c_uids"), F.collect_set("c_item").alias("c_items"),
                           F.bool_or("clicked").alias("clicked"), F.sum("n").alias("n")))
    return alert_rows(per_evid.groupBy("mid", "window_start", "window_end").agg(*merged_sets()))


def alert_id(mid: Column, ts_ms: Column) -> Column:
    """``<mid>_<epoch minute>``: at most one stored alert per device per minute."""
    return F.concat_ws("_", mid, timefmt.minute_bucket(ts_ms).cast("string"))


def one_per_minute(alerts: DataFrame) -> DataFrame:
    """Keep the last alert per ``alert_id`` (later windows overwrite earlier ones)."""
    keyed = alerts.withColumn("alert_id", alert_id(F.col("mid"), F.col("ts")))
    return latest_per_key(keyed, ["alert_id"], ["ts", "window_start"])


def event_counts_text(col: str = "event_counts") -> Column:
    """``evid:n`` pairs joined by commas, sorted by evid."""
    return F.array_join(F.transform(F.col(col), lambda p: F.concat(p["evid"], F.lit(":"),
                                                                    p["n"].cast("string"))), ",")
