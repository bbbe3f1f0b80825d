"""Orders, details and users as streams: what never meets comes out, one job sees the users of its own batch."""

import datetime as dt
import json
import os
import random

import pytest
from conftest import SF001, rows
from pyspark.sql import functions as F

from shopstream import schemas
from shopstream.operators import routing, sales
from shopstream.sources import streams, tables
from shopstream.sources import testdata as td
from shopstream.streaming import jobs

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)
KINDS = ("order_id", "order_detail_id", "match_kind", "o_ts", "d_ts")


def _line(topic, at_s, **fields):
    at = (T0 + dt.timedelta(seconds=at_s)).isoformat() + "Z"
    return {"topic": topic, "value": json.dumps(fields), "timestamp": at}


def _order(i, at_s, user="u1"):
    return _line(routing.TOPIC_ORDER, at_s, id=i, user_id=user, order_status="1", total_amount="5.0",
                 create_time="2024-01-01 12:00:00", consignee_tel="13500000007")


def _detail(i, order, at_s):
    return _line(routing.TOPIC_ORDER_DETAIL, at_s, id=i, order_id=order, sku_id="s", sku_name="n", order_price="1.5", sku_num="1")


def _user(i, at_s, level):
    return _line(routing.TOPIC_USER, at_s, id=i, login_name="n", user_level=level, birthday="1990-01-01", gender="F")


def _put(folder, name, lines):
    """One file of a topic root, read as one micro-batch when files are read one by one."""
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.writelines(json.dumps(x) + "\n" for x in lines)


def _topic(spark, folder, topic, **kw):
    return streams.read_topic(spark, topic, fmt="json", path=folder, **kw)


def _drain(stream, out, ck):
    q = (stream.writeStream.format("parquet").option("path", out).outputMode("append")
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination(240)
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


# ---------------------------------------------------------------------------------
# full outer join by time bound


def _brute_force(orders, details, tol_s):
    out, met = [], set()
    for d, o, at in details:
        near = [(i, t) for i, t in orders if i == o and abs(t - at) <= tol_s * 1000]
        met.update(near)
        out += [(i, d, "both", t, at) for i, t in near] or [(o, d, "detail_only", None, at)]
    return sorted(out + [(i, None, "order_only", t, None) for i, t in orders if (i, t) not in met], key=str)


def _tables(spark, orders, details):
    o = spark.createDataFrame([(i, "u", "1", "2024-01-01 12:00:00", "2024-01-01", t) for i, t in orders],
                              "id string, user_id string, order_status string, create_time string, create_date string, ts long")
    d = spark.createDataFrame([(i, o_id, "s", "n", 1.0, t) for i, o_id, t in details],
                              "id string, order_id string, sku_id string, sku_name string, order_price double, ts long")
    return o, d


@pytest.mark.parametrize("tol", [1, 60])
def test_interval_full_join_equals_the_definition(spark, tol):
    rnd = random.Random(tol)
    base = 1_704_067_200_000
    orders = [(f"o{i}", base + rnd.randrange(0, 400_000)) for i in range(60)]
    orders += [("edge", base), ("early", base - 7), ("again", base), ("again", base + 200_000)]
    details = [(f"d{i}", f"o{rnd.randrange(80)}", base + rnd.randrange(-100_000, 500_000)) for i in range(300)]
    details += [(f"e{k}", "edge", base + s * (tol * 1000 + k)) for s in (-1, 1) for k in (0, 1)]
    details += [("r1", "again", base + 200_000), ("x", "early", base - 7 - tol * 1000)] + [(f"h{i}", "o1", base + i) for i in range(200)]
    got = sales.interval_full_join(*_tables(spark, orders, details), tolerance_s=tol)
    assert sorted((tuple(r) for r in got.select(*KINDS).collect()), key=str) == _brute_force(orders, details, tol)


def test_interval_full_join_of_empty_sides(spark):
    o, d = _tables(spark, [("a", 1)], [("x", "b", 1)])
    assert rows(sales.interval_full_join(o, d.limit(0)), "match_kind") == [("order_only",)]
    assert rows(sales.interval_full_join(o.limit(0), d), "match_kind") == [("detail_only",)]
    assert sales.interval_full_join(o.limit(0), d.limit(0)).count() == 0


def test_full_stream_equals_batch_over_micro_batches(spark, scratch):
    src = os.path.join(scratch, "topics")
    batches = [[_order("1", 0), _order("2", 1), _detail("d0", "1", 2)], [_detail("d1", "1", 60), _detail("d2", "2", 62), _order("3", 50)],
               [_detail("d3", "9", 70), _detail("d4", "3", 70), _detail("d5", "3", 71)], [_order("4", 200), _detail("d6", "4", 261), _detail("d7", "4", 260)],
               [_order("end", 90_000), _detail("end", "other", 90_000)]]
    for i, lines in enumerate(batches):
        _put(src, f"{i}.json", lines)
        os.utime(os.path.join(src, f"{i}.json"), (1_700_000_000 + i, 1_700_000_000 + i))
    one_by_one = dict(max_per_trigger=1)
    stream = jobs.sale_full_stream(_topic(spark, src, routing.TOPIC_ORDER, **one_by_one), _topic(spark, src, routing.TOPIC_ORDER_DETAIL, **one_by_one))
    got = _drain(stream, os.path.join(scratch, "out"), os.path.join(scratch, "ck"))

    at = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    orders, details = [], []
    for line in (x for b in batches for x in b):
        value, ts = json.loads(line["value"]), at + round((dt.datetime.fromisoformat(line["timestamp"][:-1]) - T0).total_seconds() * 1000)
        (orders.append((value["id"], ts)) if line["topic"] == routing.TOPIC_ORDER else details.append((value["id"], value["order_id"], ts)))
    # the last order and detail have closed all others; they themselves are still open
    open_ones = F.coalesce("order_detail_id", "order_id").isin("end", "other")
    want = sales.interval_full_join(*_tables(spark, orders, details)).filter(~open_ones)
    assert rows(got.select(*KINDS)) == rows(want.select(*KINDS))
    assert {r["match_kind"] for r in got.collect()} == {"both", "order_only", "detail_only"}


def test_unmatched_job_reports_what_the_sales_job_drops(spark, scratch):
    src, out = os.path.join(scratch, "topics"), os.path.join(scratch, "unmatched")
    _put(src, "0.json", [_order("1", 0), _order("2", 0), _detail("d1", "1", 61), _detail("d2", "2", 5), _detail("d3", "7", 5),
                         _order("end", 90_000), _detail("end", "other", 90_000)])

    def run():
        q = jobs.start_unmatched(_topic(spark, src, routing.TOPIC_ORDER), _topic(spark, src, routing.TOPIC_ORDER_DETAIL), out,
                                 available_now=True, checkpoint=os.path.join(scratch, "ck"))
        q.awaitTermination(240)
        return q
    q = run()
    seen = [p["observedMetrics"]["sale_matches"] for p in q.recentProgress if "sale_matches" in (p.get("observedMetrics") or {})]
    assert [sum(int(m[f"n_{k}"]) for m in seen) for k in ("both", "order_only", "detail_only")] == [1, 1, 2]
    want = [("d1", "1", "detail_only"), ("d3", "7", "detail_only"), (None, "1", "order_only")]
    for _ in range(2):
        got = spark.read.json(out)
        assert sorted(rows(got, "order_detail_id", "order_id", "match_kind"), key=str) == sorted(want, key=str)
        run()  # a restart adds nothing


# ---------------------------------------------------------------------------------
# one job over three topics


TOPICS = ",".join((routing.TOPIC_ORDER, routing.TOPIC_ORDER_DETAIL, routing.TOPIC_USER))


def _run_topics(spark, scratch, src):
    q = jobs.start_sales_topics(_topic(spark, src, TOPICS, max_per_trigger=1), os.path.join(scratch, "users"), os.path.join(scratch, "sales"),
                                as_of=F.lit("2024-01-31 00:00:00").cast("timestamp"), available_now=True, checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination(240)
    return {r["order_detail_id"]: (r["user_id"], r["user_level"], r["user_age"]) for r in tables.sale_table(spark, os.path.join(scratch, "sales")).collect()}


def test_user_and_its_sale_in_one_batch(spark, scratch):
    src = os.path.join(scratch, "topics")
    _put(src, "0.json", [_order("1", 0), _detail("d1", "1", 1), _user("u1", 1, "gold")])
    assert _run_topics(spark, scratch, src) == {"d1": ("u1", "gold", 34)}
    # no users in a batch; a user that comes later does not rewrite sales, a newer version holds for later ones
    _put(src, "1.json", [_order("2", 2, "u2"), _detail("d2", "2", 3)])
    assert _run_topics(spark, scratch, src)["d2"] == ("u2", None, 0)
    _put(src, "2.json", [_user("u2", 4, "silver"), _user("u1", 4, "platinum"), _detail("d3", "2", 5), _detail("d4", "1", 6)])
    got = _run_topics(spark, scratch, src)
    assert got["d2"] == ("u2", None, 0) and got["d3"] == ("u2", "silver", 34) and got["d4"] == ("u1", "platinum", 34) and len(got) == 4
    assert _run_topics(spark, scratch, src) == got  # nothing new: nothing doubled
    assert tables.user_table(spark, os.path.join(scratch, "users")).count() == 2


def test_batches_without_users_or_sales(spark, scratch):
    src = os.path.join(scratch, "topics")
    _put(src, "0.json", [_order("1", 0)])
    assert _run_topics(spark, scratch, src) == {}
    assert tables.user_table(spark, os.path.join(scratch, "users")).count() == 0
    _put(src, "1.json", [_detail("d1", "1", 1), _line(routing.TOPIC_USER, 1, login_name="no id")])
    assert _run_topics(spark, scratch, src) == {"d1": ("u1", None, 0)}


def test_one_job_equals_batch_on_the_shared_tables(spark, scratch):
    src = os.path.join(scratch, "topics")
    users = td.user_lines(spark, SF001).select("value", (F.col("seq").cast("long") * 1000).alias("arrival_ms"))
    for topic, lines in ((routing.TOPIC_ORDER, td.order_lines(spark, SF001)), (routing.TOPIC_ORDER_DETAIL, td.detail_lines(spark, SF001)),
                         (routing.TOPIC_USER, users)):
        lines.select(F.lit(topic).alias("topic"), "value", F.timestamp_millis("arrival_ms").alias("timestamp")).coalesce(1).write.mode("append").json(src)
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp")
    q = jobs.start_sales_topics(_topic(spark, src, TOPICS), os.path.join(scratch, "users"), os.path.join(scratch, "sales"), as_of=as_of,
                                available_now=True, checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination(240)
    want = sales.with_user(sales.interval_join(td.orders(spark, SF001), td.details(spark, SF001)), sales.user_latest(td.user_changes(spark, SF001)), as_of)
    got = tables.sale_table(spark, os.path.join(scratch, "sales"))
    assert rows(got.select(*sales.SALE_COLUMNS)) == rows(sales.one_per_detail(want))
    stored = tables.user_table(spark, os.path.join(scratch, "users"))
    assert rows(stored, *schemas.USER_FIELDS) == rows(sales.user_latest(td.user_changes(spark, SF001)), *schemas.USER_FIELDS)
