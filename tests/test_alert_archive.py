"""Alerts decided from state of bounded size, their lists read from the intake's archive."""

import datetime as dt
import json
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shopstream.operators import alerts, upsert
from shopstream.sources import streams
from shopstream.streaming import jobs

BASE = 1_704_067_200_000
FIELDS = ("type", "mid", "uid", "evid", "itemid", "ts")


def _events(seed, n, span_s, mids=6, uids=9):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        evid = rnd.choices(["coupon", "clickItem", "view", "cart"], [6, 0.15, 3, 1])[0]
        uid = None if rnd.random() < 0.05 else f"u{rnd.randrange(uids)}"
        out.append({"type": "event", "mid": f"m{rnd.randrange(mids)}", "uid": uid, "evid": evid, "itemid": str(rnd.randrange(5)), "ts": BASE + rnd.randrange(span_s * 1000)})
    return out


def _frame(spark, events):
    return spark.createDataFrame([tuple(e[f] for f in FIELDS) for e in events], "type string, mid string, uid string, evid string, itemid string, ts long")


def _key(df):
    return rows(df.select("mid", "window_start", "n_uids", F.array_join(F.array_sort("uids"), ",").alias("u"),
                          F.array_join(F.array_sort("item_ids"), ",").alias("i"), alerts.event_counts_text().alias("e")))


@pytest.mark.parametrize(("window", "slide", "min_uids"), [("5 minutes", "10 seconds", 3), ("1 minute", "1 minute", 0), ("2 minutes", "30 seconds", 6)])
def test_bounded_decision_and_lists_equal_the_plain_form(spark, window, slide, min_uids):
    ev = _frame(spark, _events(min_uids, 1500, 3000))
    timed = alerts.usable(ev).withColumn("event_time", F.timestamp_millis("ts"))
    found = alerts.alerting_windows(timed, window, slide, min_uids)
    want = alerts.coupon_alerts(ev, window, slide, min_uids)
    assert rows(found, "mid", "window_start", "window_end", "n_uids") == rows(want, "mid", "window_start", "window_end", "n_uids")
    assert _key(alerts.with_lists(found, ev)) == _key(want) and want.count() > 0


def test_many_users_of_one_window_are_more_than_the_threshold(spark):
    """Far beyond the sketch's size the number is an estimate, the decision is not."""
    ev = _frame(spark, [{"type": "event", "mid": m, "uid": f"u{i}", "evid": "coupon", "itemid": "1", "ts": BASE + i} for i in range(5000) for m in ("a", "b")]
                + [{"type": "event", "mid": "b", "uid": "u", "evid": "clickItem", "itemid": "1", "ts": BASE + 9000}])
    timed = ev.withColumn("event_time", F.timestamp_millis("ts"))
    found = alerts.alerting_windows(timed, "5 minutes", "5 minutes").collect()
    assert [(r["mid"], r["n_uids"] > 1000) for r in found] == [("a", True)]
    assert 1 << alerts.sketch_bits(3) >= 16 and 1 << alerts.sketch_bits(100) >= 404


def test_click_column_and_empty_input(spark):
    ev = _frame(spark, [{"type": "clickItem" if i == 4 else "event", "mid": "a", "uid": f"u{i}", "evid": "coupon" if i < 4 else "view", "itemid": "1", "ts": BASE + i} for i in range(5)])
    timed = ev.withColumn("event_time", F.timestamp_millis("ts"))
    assert alerts.alerting_windows(timed, "1 minute", "1 minute").count() == 1
    assert alerts.alerting_windows(timed, "1 minute", "1 minute", click_col="type").count() == 0
    assert alerts.alerting_windows(timed.limit(0)).count() == 0
    assert alerts.with_lists(alerts.alerting_windows(timed.limit(0)), ev).count() == 0


def _state_bytes(q):
    return max(sum(s["memoryUsedBytes"] for s in p["stateOperators"]) for p in q.recentProgress if p["stateOperators"])


def test_alert_job_over_the_archive_equals_batch(spark, scratch):
    """Raw lines -> intake (archive, then topics) -> alerts; the last line closes all windows."""
    events = sorted(_events(5, 1200, 2400), key=lambda e: e["ts"])
    events += [{**e, "type": "startup"} for e in events[:50]]
    late = {"type": "event", "mid": "last", "uid": "0", "evid": "view", "itemid": "1", "ts": BASE + 86_400_000 * 3}
    raw, archive, topics = (os.path.join(scratch, x) for x in ("raw", "archive", "topics"))
    _frame(spark, [*events, late]).select(F.to_json(F.struct(*[f for f in FIELDS if f != "ts"])).alias("value"), F.col("ts").alias("arrival_ms")) \
        .coalesce(1).write.json(raw)
    lines = spark.readStream.schema("value string, arrival_ms long").json(raw)
    jobs.start_intake(lines, archive, topics_fmt="json", topics_path=topics, arrival_col="arrival_ms", available_now=True,
                      checkpoint=os.path.join(scratch, "ck_i")).awaitTermination(240)
    want = alerts.coupon_alerts(_frame(spark, [e for e in events if e["type"] == "event"]))
    assert want.count() > 5
    out = os.path.join(scratch, "alerts")
    for _ in range(2):  # the second start finds nothing new
        q = jobs.start_alerts(streams.read_topic(spark, "CAT_EVENT", fmt="json", path=topics), out, archive=archive, lateness="0 seconds",
                              available_now=True, checkpoint=os.path.join(scratch, "ck_a"))
        q.awaitTermination(240)
    stored = upsert.read_latest(spark, out, ["alert_id"], ["ts", "window_start"])
    assert _key(stored) == _key(alerts.one_per_minute(want))


def test_state_does_not_grow_with_the_users_of_a_window(spark, scratch):
    """Rows of state are the same; their bytes are bounded where lists of users are kept otherwise."""
    sizes = {}
    for n in (50, 3000):
        lines = spark.createDataFrame([(json.dumps({"type": "event", "mid": "m", "uid": f"user-{i:012d}", "evid": "coupon", "itemid": "1", "ts": BASE + i % 9000}),) for i in range(n)],
                                      "value string").withColumn("timestamp", F.lit(dt.datetime(2024, 1, 1)))
        src = os.path.join(scratch, f"src{n}")
        lines.coalesce(1).write.json(src)
        for name, build in (("lists", jobs.alert_stream), ("bounded", jobs.alert_windows_stream)):
            stream = build(streams.read_topic(spark, "CAT_EVENT", fmt="json", path=src), window="1 minute", slide="10 seconds")
            q = (stream.writeStream.format("noop").option("checkpointLocation", os.path.join(scratch, f"ck-{name}-{n}")).trigger(availableNow=True).start())
            q.awaitTermination(240)
            sizes[name, n] = _state_bytes(q)
    assert sizes["bounded", 3000] < 1.5 * sizes["bounded", 50] + 10_000
    assert sizes["lists", 3000] > sizes["lists", 50] + 50_000
    assert sizes["bounded", 3000] < sizes["lists", 3000]
