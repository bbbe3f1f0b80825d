"""Per-key picks agree with a brute-force pandas reference on random inputs."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from shopstream.operators import upsert
from shopstream.operators.dedup import first_per_key, latest_per_key

ROW = st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 3), st.integers(-5, 5),
                st.text("xyz", max_size=3))


def _brute(data, pick):
    df = pd.DataFrame(data, columns=["k1", "k2", "o", "p"])
    out = []
    for _, g in df.groupby(["k1", "k2"], dropna=False):
        g = g.sort_values(["o", "p"], kind="mergesort")
        r = g.iloc[0] if pick == "first" else g.iloc[-1]
        out.append((None if pd.isna(r.k1) else r.k1, int(r.k2), int(r.o), r.p))
    return sorted(out, key=lambda t: tuple((x is not None, x if x is not None else 0) for x in t))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=1, max_size=40))
def test_first_and_latest_per_key_match_brute_force(spark, data):
    df = spark.createDataFrame(data, "k1 string, k2 int, o int, p string")
    assert rows(first_per_key(df, ["k1", "k2"], ["o", "p"]), "k1", "k2", "o", "p") == _brute(data, "first")
    assert rows(latest_per_key(df, ["k1", "k2"], ["o", "p"]), "k1", "k2", "o", "p") == _brute(data, "last")


def test_compact_equals_read_latest(spark, scratch):
    import os
    table, snap = os.path.join(scratch, "t"), os.path.join(scratch, "snap")
    for b in range(3):
        df = spark.createDataFrame([(f"k{i}", b, f"v{b}{i}") for i in range(b, 5)], "id string, v int, p string")
        upsert.write_batch(df, table, b, ["id"], ["v"], partition_by=())
    upsert.compact(spark, table, snap, ["id"])
    assert rows(upsert.read_latest(spark, snap, ["id"])) == rows(upsert.read_latest(spark, table, ["id"]))
    assert rows(upsert.read_latest(spark, table, ["id"]), "id", "p") == \
        [("k0", "v00"), ("k1", "v11"), ("k2", "v22"), ("k3", "v23"), ("k4", "v24")]


def test_compact_from_the_launcher(spark, scratch):
    import os

    from shopstream.streaming import apps
    table, snap = os.path.join(scratch, "t"), os.path.join(scratch, "snap")
    for b in range(2):
        df = spark.createDataFrame([("k1", b, f"v{b}"), (f"only{b}", b, "x")], "id string, v int, p string")
        upsert.write_batch(df, table, b, ["id"], ["v"])
    apps.main(["compact", "--table", table, "--snapshot", snap, "--key", "id", "--order", "v"])
    assert rows(upsert.read_latest(spark, snap, ["id"]), "id", "p") == [("k1", "v1"), ("only0", "x"), ("only1", "x")]


EVENT = st.tuples(st.sampled_from(["a", "b"]), st.sampled_from(["u1", "u2", "u3", "u4", None]),
                  st.sampled_from(["coupon", "coupon", "view", "clickItem"]), st.integers(0, 179_999))


def _brute_alerts(events, win_ms, slide_ms, min_uids):
    windows = {}
    for mid, uid, evid, ts in events:
        start = ts - ts % slide_ms
        for k in range(win_ms // slide_ms):
            ws = start - k * slide_ms
            w = windows.setdefault((mid, ws), {"uids": set(), "clicked": False})
            if evid == "coupon" and uid is not None:
                w["uids"].add(uid)
            if evid == "clickItem":
                w["clicked"] = True
    return sorted((mid, ws, len(w["uids"])) for (mid, ws), w in windows.items()
                  if len(w["uids"]) > min_uids and not w["clicked"])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(EVENT, min_size=1, max_size=60))
def test_sliding_alert_matches_brute_force(spark, events):
    from pyspark.sql import functions as F

    from shopstream.operators import alerts
    df = spark.createDataFrame([(m, u, e, str(t % 7), "event", t) for m, u, e, t in events],
                               "mid string, uid string, evid string, itemid string, type string, ts long")
    got = alerts.coupon_alerts(df, window="1 minute", slide="20 seconds", min_uids=2)
    got = sorted((r.mid, r.ws, r.n_uids) for r in
                 got.select("mid", F.unix_millis("window_start").alias("ws"), "n_uids").collect())
    assert got == _brute_alerts(events, 60_000, 20_000, 2)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["1", "2", "3"]), st.integers(0, 200_000)), min_size=1, max_size=6,
                unique_by=lambda t: t[0]),
       st.lists(st.tuples(st.sampled_from(["1", "2", "3", "4"]), st.integers(0, 200_000)), max_size=25))
def test_interval_join_matches_nested_loop(spark, orders, details):
    from shopstream.operators import sales
    o = spark.createDataFrame([(i, "u", "s", "t", "d", ts) for i, ts in orders],
                              "id string, user_id string, order_status string, create_time string, "
                              "create_date string, ts long")
    d = spark.createDataFrame([(f"d{k}", oid, "s", "n", 1.0, ts) for k, (oid, ts) in enumerate(details)],
                              "id string, order_id string, sku_id string, sku_name string, "
                              "order_price double, ts long")
    got = sorted((r.order_detail_id, r.order_id) for r in sales.interval_join(o, d).collect())
    want = sorted((f"d{k}", oid) for k, (oid, dts) in enumerate(details)
                  for i, ots in orders if i == oid and abs(dts - ots) <= 60_000)
    assert got == want
