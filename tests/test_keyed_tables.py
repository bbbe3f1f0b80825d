"""Keyed tables survive what restarts do to them: fresh checkpoints, snapshots, replays."""

import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shopstream.operators import upsert
from shopstream.session import checkpoint_path
from shopstream.sources import streams, tables
from shopstream.streaming import jobs


def _users(path, name, ids, level="a", at="2024-01-01T00:00:00Z"):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for i in ids:
            value = json.dumps({"id": i, "login_name": i, "user_level": level, "birthday": "1990-01-01", "gender": "F"})
            f.write(json.dumps({"value": value, "timestamp": at}) + "\n")


def _run_users(spark, src, table, checkpoint):
    lines = streams.read_topic(spark, "CAT_USER", fmt="json", path=src)
    jobs.start_users(lines, table, available_now=True, checkpoint=checkpoint).awaitTermination(240)


def _levels(spark, table):
    return {r["id"]: r["user_level"] for r in upsert.read_latest(spark, table, ["id"], ["timestamp", "offset"]).collect()}


def test_fresh_checkpoint_on_a_filled_table_loses_and_doubles_nothing(spark, scratch):
    table = os.path.join(scratch, "users")
    _users(os.path.join(scratch, "s1"), "1.json", ["u1", "u2", "u3"])
    _users(os.path.join(scratch, "s2"), "1.json", ["u3", "u4"], level="b")
    _run_users(spark, os.path.join(scratch, "s1"), table, os.path.join(scratch, "ck1"))
    _run_users(spark, os.path.join(scratch, "s2"), table, os.path.join(scratch, "ck2"))
    assert _levels(spark, table) == {"u1": "a", "u2": "a", "u3": "b", "u4": "b"}
    # the first query goes on in its own generation
    _users(os.path.join(scratch, "s1"), "2.json", ["u5"])
    _run_users(spark, os.path.join(scratch, "s1"), table, os.path.join(scratch, "ck1"))
    assert set(_levels(spark, table)) == {"u1", "u2", "u3", "u4", "u5"}
    assert spark.read.parquet(table).select("gen").distinct().count() == 2


def test_first_batch_on_a_snapshot_keeps_it(spark, scratch):
    table, snap = os.path.join(scratch, "users"), os.path.join(scratch, "snap")
    _users(os.path.join(scratch, "s1"), "1.json", ["u1", "u2", "u3", "u4", "u5"])
    _run_users(spark, os.path.join(scratch, "s1"), table, os.path.join(scratch, "ck1"))
    upsert.compact(spark, table, snap, ["id"], ["timestamp", "offset"])
    _users(os.path.join(scratch, "s2"), "1.json", ["u5", "u6"], level="b")
    _run_users(spark, os.path.join(scratch, "s2"), snap, os.path.join(scratch, "ck2"))
    want = {"u1": "a", "u2": "a", "u3": "a", "u4": "a", "u5": "b", "u6": "b"}
    assert _levels(spark, snap) == want
    upsert.compact(spark, snap, snap, ["id"], ["timestamp", "offset"])  # a second snapshot is a generation of its own
    assert _levels(spark, snap) == want


def test_snapshot_and_later_folder_are_one_table(spark, scratch):
    a, b = os.path.join(scratch, "a"), os.path.join(scratch, "b")
    for table, level, ids in ((a, "old", ["1", "2"]), (b, "new", ["2", "3"])):
        df = spark.createDataFrame([(i, level, 1) for i in ids], "id string, level string, v int")
        upsert.write_batch(df, table, 7 if table == a else 0, ["id"], ["v"])
    got = upsert.read_latest(spark, [a, b], ["id"], ["v"])
    assert rows(got, "id", "level") == [("1", "old"), ("2", "new"), ("3", "new")]


def test_replay_of_a_partitioned_batch(spark, scratch):
    def batch(*r):
        return spark.createDataFrame(list(r), "id string, d string, v int")
    upsert.write_batch(batch(("a", "2024-01-01", 1), ("b", "2024-01-02", 1)), scratch, 0, ["id"], ["v"], partition_by=["d"], writer="q1")
    for _ in range(2):
        upsert.write_batch(batch(("a", "2024-01-01", 2)), scratch, 1, ["id"], ["v"], partition_by=["d"], writer="q1")
    upsert.write_batch(batch(("c", "2024-01-01", 1)), scratch, 0, ["id"], ["v"], partition_by=["d"], writer="q2")
    got = upsert.read_latest(spark, scratch, ["id"], ["v"], partition_by=["d"])
    assert rows(got, "id", "d", "v") == [("a", "2024-01-01", 2), ("b", "2024-01-02", 1), ("c", "2024-01-01", 1)]
    assert spark.read.parquet(scratch).count() == 4


def test_rows_without_a_part_of_their_key_are_appended(spark, scratch):
    df = spark.createDataFrame([(None, "d1", 1), (None, "d1", 2), ("m", "d1", 3)], "mid string, log_date string, ts int")
    upsert.write_batch(df, scratch, 0, ["mid", "log_date"], ["ts"], partition_by=["log_date"])
    assert upsert.read_latest(spark, scratch, ["mid", "log_date"], ["ts"], partition_by=["log_date"]).count() == 3


def test_default_checkpoints_differ_by_table_and_source(spark):
    paths = {checkpoint_path(spark, "users", t, s) for t in ("a", "b") for s in ("x", "y", None)}
    assert len(paths) == 6 and checkpoint_path(spark, "users", "a", "x") in paths


def test_unreadable_user_table_fails_the_batch(spark, scratch):
    ids = spark.createDataFrame([("u1",)], "id string")
    assert jobs._read_users(spark, os.path.join(scratch, "none"), ids).count() == 0
    broken = os.path.join(scratch, "users", "gen=00000000-q", "batch_id=0")
    os.makedirs(broken)
    with open(os.path.join(broken, "part-0.parquet"), "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):  # noqa: B017
        jobs._read_users(spark, os.path.join(scratch, "users"), ids).count()


def test_tables_read_through_their_readers(spark, scratch):
    df = spark.createDataFrame([("m1", "2024-01-01", 5), ("m1", "2024-01-01", 3), ("m2", "2024-01-02", 1)], "mid string, log_date string, ts long")
    upsert.write_batch(df, scratch, 0, ["mid", "log_date"], ["ts"], keep="first", partition_by=["log_date"], writer="q")
    assert rows(tables.dau_table(spark, scratch, ["2024-01-01"]).select("mid", F.col("ts"))) == [("m1", 3)]


def test_a_job_set_back_to_its_old_checkpoint_outranks_older_changes(spark, scratch):
    table = os.path.join(scratch, "users")
    a, b = os.path.join(scratch, "a"), os.path.join(scratch, "b")
    _users(a, "1.json", ["u1", "u2"], level="t1", at="2024-01-01T00:00:01Z")
    _run_users(spark, a, table, os.path.join(scratch, "ck_a"))
    _users(b, "1.json", ["u1", "u2"], level="t2", at="2024-01-01T00:00:02Z")
    _run_users(spark, b, table, os.path.join(scratch, "ck_b"))
    _users(a, "2.json", ["u1"], level="t3", at="2024-01-01T00:00:03Z")
    _run_users(spark, a, table, os.path.join(scratch, "ck_a"))  # the older generation writes the newer change
    assert {r["id"]: r["user_level"] for r in tables.user_table(spark, table).collect()} == {"u1": "t3", "u2": "t2"}


def test_order_table_keeps_the_latest_change(spark, scratch):
    def batch(i, at, amount):
        return spark.createDataFrame([(i, amount, "2024-01-01", at)], "id string, total_amount double, create_date string, at string").select(
            "id", "total_amount", "create_date", F.to_timestamp("at").alias("timestamp"), F.lit(None).cast("long").alias("offset"))
    for writer, n, at, amount in (("q1", 0, "2024-01-01 00:00:01", 1.0), ("q2", 0, "2024-01-01 00:00:02", 2.0), ("q1", 1, "2024-01-01 00:00:03", 3.0)):
        upsert.write_batch(batch("o", at, amount), scratch, n, ["id"], ["timestamp", "offset"], partition_by=["create_date"], writer=writer)
    assert rows(tables.order_table(spark, scratch, ["2024-01-01"]), "id", "total_amount") == [("o", 3.0)]


def test_first_user_batch_without_valid_rows(spark, scratch):
    src, table = os.path.join(scratch, "s"), os.path.join(scratch, "users")
    os.makedirs(src)
    with open(os.path.join(src, "1.json"), "w") as f:
        f.write(json.dumps({"value": "no json", "timestamp": "2024-01-01T00:00:00Z"}) + "\n")
    _run_users(spark, src, table, os.path.join(scratch, "ck"))
    ids = spark.createDataFrame([("u1",)], "id string")
    assert jobs._read_users(spark, table, ids).count() == 0
    assert tables.user_table(spark, table).count() == 0
    _users(src, "2.json", ["u1"])
    _run_users(spark, src, table, os.path.join(scratch, "ck"))
    assert jobs._read_users(spark, table, ids).count() == 1
