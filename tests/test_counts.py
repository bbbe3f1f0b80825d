"""Counts of all batches as a table, over restarts; the launcher's rejects and failures."""

import json
import os

import pytest
from conftest import SF001, rows
from pyspark.sql import functions as F

from shopstream.operators import routing
from shopstream.sources import streams
from shopstream.sources import testdata as td
from shopstream.streaming import apps, counts, jobs


def _put(folder, name, values, topic=None, at="2024-01-01T00:00:00Z"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for v in values:
            f.write(json.dumps({"value": v, "timestamp": at, **({"topic": topic} if topic else {})}) + "\n")


def _order(i):
    return json.dumps({"id": str(i), "user_id": "u1", "total_amount": "1.0", "create_time": "2024-01-01 12:00:00", "consignee_tel": "13500000007"})


def _detail(i, order):
    return json.dumps({"id": f"d{i}", "order_id": order and str(order), "sku_id": "s", "order_price": "1.0"})


def _totals(spark, path):
    return {(r["query"], r["metric"], r["field"]): (r["batches"], r["n"]) for r in counts.total_counts(counts.read_counts(spark, path)).collect()}


def test_counts_of_all_jobs_are_there_after_a_restart(spark, scratch):
    assert counts.read_counts(spark, os.path.join(scratch, "none")).count() == 0
    path, src, logs = (os.path.join(scratch, x) for x in ("counts", "orders", "logs"))
    td.log_lines(spark, SF001).select("value", F.timestamp_millis("arrival_ms").alias("timestamp")).coalesce(1).write.json(logs)
    _put(src, "1.json", [_order(1), _order(2), "broken"])
    common = ["--available-now", "--counts", path]
    apps.main(["orders", "--source-path", src, "--table", os.path.join(scratch, "t"), "--checkpoint", os.path.join(scratch, "ck"), *common])
    apps.main(["dau", "--source-path", logs, "--table", os.path.join(scratch, "dau"), "--checkpoint", os.path.join(scratch, "ck_dau"), *common])
    first = _totals(spark, path)
    assert first["orders", "orders_rows", "n_in"] == (1, 3) and first["orders", "orders_rows", "n_rejected"] == (1, 1)
    n = td.log_lines(spark, SF001).count()
    assert first["dau", "dau_in", "n_in"][1] == n and first["dau", "dau_new", "n_new"][1] == td.startup_log(spark, SF001).select("mid", "log_date").distinct().count()
    # a restarted job goes on where it was: its id and batch numbers stay its own
    _put(src, "2.json", [_order(3), "broken", "broken"])
    apps.main(["orders", "--source-path", src, "--table", os.path.join(scratch, "t"), "--checkpoint", os.path.join(scratch, "ck"), *common])
    again = _totals(spark, path)
    assert again["orders", "orders_rows", "n_in"] == (2, 6) and again["orders", "orders_rows", "n_rejected"] == (2, 3)
    assert {k: v for k, v in again.items() if k[0] == "dau"} == {k: v for k, v in first.items() if k[0] == "dau"}
    found = counts.read_counts(spark, path).filter("query = 'orders'")
    assert found.select("query_id").distinct().count() == 1


def test_a_replayed_batch_replaces_its_counts(spark, scratch):
    class Progress:
        name, id, batchId, timestamp = "orders", "q", 7, "2024-01-01T00:00:00Z"

        def __init__(self, n):
            self.observedMetrics = {"orders_rows": spark.createDataFrame([(n, None)], "n_in long, n_rejected long").first()}

    class Event:
        def __init__(self, n):
            self.progress = Progress(n)
    listener = counts.CountsListener(spark, scratch)
    for n in (5, 6):
        listener.onQueryProgress(Event(n))
    assert listener.failure is None
    assert rows(counts.read_counts(spark, scratch), "batch_id", "field", "n") == [(7, "n_in", 6)]
    assert not listener.wait("q", 0.01)


def test_unwritable_counts_do_not_stop_the_job_but_are_told(spark, scratch):
    src, blocked = os.path.join(scratch, "s"), os.path.join(scratch, "file")
    _put(src, "1.json", [_order(1)])
    open(blocked, "w").close()
    with pytest.raises(Exception):  # noqa: B017
        apps.main(["orders", "--source-path", src, "--table", os.path.join(scratch, "t"), "--checkpoint", os.path.join(scratch, "ck"), "--available-now",
                   "--counts", os.path.join(blocked, "counts")])
    assert spark.read.parquet(os.path.join(scratch, "t")).count() == 1


def test_rejects_of_the_sales_job(spark, scratch):
    src, rejects = os.path.join(scratch, "topics"), os.path.join(scratch, "rejects")
    _put(src, "o.json", [_order(1), "bad order"], routing.TOPIC_ORDER)
    _put(src, "d.json", [_detail(1, 1), "bad detail", _detail(2, None)], routing.TOPIC_ORDER_DETAIL)
    apps.main(["sales", "--source-path", src, "--users", os.path.join(scratch, "users"), "--table", os.path.join(scratch, "sales"), "--rejects", rejects,
               "--checkpoint", os.path.join(scratch, "ck"), "--available-now"])
    assert rows(spark.read.json(os.path.join(rejects, "orders")), "value") == [("bad order",)]
    assert rows(spark.read.json(os.path.join(rejects, "details")), "value") == sorted([("bad detail",), (_detail(2, None),)])
    assert spark.read.parquet(os.path.join(scratch, "sales")).count() == 1


def test_rejects_of_the_change_feed(spark, scratch):
    src, topics, rejects = (os.path.join(scratch, x) for x in ("cdc", "topics", "rejects"))
    entries = td.cdc_entries(spark, SF001).filter("table = 'user_info'")
    os.makedirs(src)
    good = [r["j"] for r in entries.select(F.to_json(F.struct("*")).alias("j")).collect()]
    with open(os.path.join(src, "1.json"), "w") as f:
        f.write("\n".join([*good, "no entry", '{"x": 1}']) + "\n")
    apps.main(["cdc", "--source-path", src, "--topics-path", topics, "--rejects", rejects, "--checkpoint", os.path.join(scratch, "ck"), "--available-now",
               "--counts", os.path.join(scratch, "counts")])
    assert rows(spark.read.json(rejects), "value") == [("no entry",), ('{"x": 1}',)]
    published = routing.cdc_after_json(routing.cdc_route(routing.cdc_explode(entries)))
    assert rows(spark.read.json(topics), "value") == rows(published, "value")
    seen = _totals(spark, os.path.join(scratch, "counts"))
    assert seen["cdc", "cdc_entries", "n_in"][1] == len(good) + 2 and seen["cdc", "cdc_entries", "n_rejected"][1] == 2


def test_a_failed_main_job_ends_the_launcher(spark, scratch):
    """The rejects query would go on for ever; the failure of the job itself ends both."""
    src, table = os.path.join(scratch, "s"), os.path.join(scratch, "table")
    _put(src, "1.json", [_order(1)])
    open(table, "w").close()  # a file where the table's folder should be
    with pytest.raises(Exception):  # noqa: B017
        apps.main(["orders", "--source-path", src, "--table", table, "--rejects", os.path.join(scratch, "rejects"),
                   "--checkpoint", os.path.join(scratch, "ck"), "--trigger", "1 second"])
    assert not [q for q in spark.streams.active if q.name in ("orders", "orders-rejects")]


def test_change_lines_of_text_files_are_entries(spark, scratch):
    src = os.path.join(scratch, "cdc")
    os.makedirs(src)
    with open(os.path.join(src, "1.json"), "w") as f:
        f.write('{"db":"cat2019","table":"user_info","entry_type":"ROWDATA","event_type":"INSERT","rows":[{"after":[{"name":"id","value":"1"}]}],"ts":5}\nbad\n')
    out = jobs.cdc_stream(streams.read_changes(spark, fmt="json", path=src))
    q = (out.writeStream.format("memory").queryName("change_lines").option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(240)
    assert rows(spark.table("change_lines"), "topic", "key", "value") == [("CAT_USER", "1", '{"id":"1"}')]
