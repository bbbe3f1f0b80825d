"""Seen filter, first-seen state and bucketed tables: same rows, less shuffled or kept."""

import os
import uuid

import pytest
from conftest import SF001, rows
from pyspark.sql import functions as F

from shopstream.operators import dau, sales
from shopstream.plans import catalog
from shopstream.sources import streams, tables
from shopstream.sources import testdata as td
from shopstream.streaming import jobs


def _keys(spark, names, day="2024-01-01"):
    return spark.createDataFrame([(n, day) for n in names], "mid string, log_date string")


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_seen_filter_is_exact_whatever_its_size(spark, buckets):
    seen = _keys(spark, [f"m{i}" for i in range(4000)])
    logs = _keys(spark, [f"m{i}" for i in range(3900, 4300)]).unionByName(_keys(spark, ["m1", "m1"], "2024-01-02")).unionByName(_keys(spark, [None, "m5", "m5"]))
    known = dau.seen_filter(seen, buckets=buckets)
    assert known.count() <= buckets and known.agg(F.max(F.length("bits"))).first()[0] == 4096
    got = dau.filter_unseen_by_filter(logs, seen, known, buckets=buckets)
    assert sorted(map(str, got.collect())) == sorted(map(str, dau.filter_unseen(logs, seen).collect()))
    assert dau.filter_unseen_by_filter(logs, seen.limit(0), dau.seen_filter(seen.limit(0), buckets=buckets), buckets=buckets).count() == logs.count()


def test_rows_that_the_filter_rejects_do_not_reach_the_anti_join(spark):
    seen, logs = _keys(spark, [f"m{i}" for i in range(500)]), _keys(spark, [f"m{i}" for i in range(400, 20_000)])
    known = dau.seen_filter(seen)
    suspects = dau.filter_unseen_by_filter(logs, logs, known)  # all suspects are "seen" now: what is left was rejected by the filter
    rejected = suspects.count()
    assert 19_500 >= rejected > 19_400  # all 100 seen keys are suspects, and hardly any other


def test_seen_filter_query_equals_the_anti_join(spark):
    assert rows(catalog.q_dau_seen_filter(spark, SF001)) == rows(catalog.q_dau_seen_anti(spark, SF001))


def _dau_run(spark, scratch, src, name, **kw):
    q = jobs.start_dau(streams.read_topic(spark, "CAT_STARTUP", fmt="json", path=src), os.path.join(scratch, name), available_now=True,
                       checkpoint=os.path.join(scratch, f"ck-{name}"), **kw)
    q.awaitTermination(240)
    states = [s for p in q.recentProgress for s in p["stateOperators"]]
    return tables.dau_table(spark, os.path.join(scratch, name)), max(s["memoryUsedBytes"] for s in states), max(s["numRowsTotal"] for s in states)


def test_first_seen_stream_equals_batch_on_ordered_input(spark, scratch):
    src = os.path.join(scratch, "src")
    td.log_lines(spark, SF001).orderBy("arrival_ms", "event_id").select("value", F.timestamp_millis("arrival_ms").alias("timestamp")) \
        .coalesce(1).write.json(src)
    got, small, n_small = _dau_run(spark, scratch, src, "first", first_seen=True)
    want = dau.dedup_daily(td.startup_log(spark, SF001))
    cols = ("mid", "log_date", "ts", "uid", "log_hour")
    assert rows(got, *cols) == rows(want, *cols)
    earliest, large, n_large = _dau_run(spark, scratch, src, "earliest")
    assert rows(earliest, *cols) == rows(want, *cols)
    print(f"state: first seen {small} bytes in {n_small} rows, earliest {large} bytes in {n_large} rows")
    assert small < large
    # the same lines again: nothing new, also after a restart
    td.log_lines(spark, SF001).filter("event_id > 900").select("value", F.timestamp_millis("arrival_ms").alias("timestamp")).coalesce(1).write.mode("append").json(src)
    again, _, _ = _dau_run(spark, scratch, src, "first", first_seen=True)
    assert rows(again, *cols) == rows(want, *cols) and spark.read.parquet(os.path.join(scratch, "first")).count() == want.count()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_sale_and_user_joins_need_no_exchange(spark, scratch):
    names = {k: f"t_{k}_{uuid.uuid4().hex[:8]}" for k in ("orders", "details", "sales", "users")}
    o, d = td.orders(spark, SF001), td.details(spark, SF001)
    users = sales.user_latest(td.user_changes(spark, SF001))
    for k, df, key in (("orders", o, "id"), ("details", d, "order_id"), ("sales", sales.sale_join(o, d), "user_id"), ("users", users, "id")):
        tables.save_bucketed(df, names[k], key, 4, os.path.join(scratch, k))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = sales.sale_join(spark.table(names["orders"]), spark.table(names["details"]))
        wide = sales.with_user(spark.table(names["sales"]), spark.table(names["users"]), F.lit("2024-01-31 00:00:00").cast("timestamp"))
        plain = sales.sale_join(o, d)
        assert _plan(plain).count("Exchange") > 0
        for df in (joined, wide):
            assert "SortMergeJoin" in _plan(df) and "Exchange" not in _plan(df)
        assert rows(joined) == rows(plain)
        assert rows(wide) == rows(sales.with_user(plain, users, F.lit("2024-01-31 00:00:00").cast("timestamp")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for n in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {n}")
