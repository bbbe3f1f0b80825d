"""Application restart: a second process resumes from the checkpoint under
``spark.checkpoint.dir`` (no explicit checkpoint option) and adds only new data."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

from conftest import SF001
from shopstream.operators import dau
from shopstream.sources import tables
from shopstream.sources import testdata as td

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run_app(args, ckpt_root):
    env = dict(os.environ)
    env["PYSPARK_SUBMIT_ARGS"] = f"--master local[2] --conf spark.ui.enabled=false --conf spark.checkpoint.dir={ckpt_root} pyspark-shell"
    env["PYTHONPATH"] = REPO + os.pathsep + env.get("PYTHONPATH", "")
    subprocess.run([sys.executable, "-m", "shopstream.streaming.apps", *args], check=True, env=env,
                   cwd=REPO, timeout=600, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)


def test_second_process_resumes_from_checkpoint(spark, scratch):
    src, table, ckpt = (os.path.join(scratch, x) for x in ("logs", "dau", "ckpt"))
    logs = td.log_lines(spark, SF001).join(td.startup_log(spark, SF001).select("event_id", "log_date"), "event_id")
    first_day = logs.agg(F.min("log_date")).first()[0]
    early, late = logs.filter(F.col("log_date") == first_day), logs.filter(F.col("log_date") != first_day)

    def publish(part, name):
        part.select("value", F.timestamp_millis("arrival_ms").alias("timestamp")).write.json(src + name)

    # first run sees only the first day's file
    publish(early, "_a")
    args = ["dau", "--source-path", src + "_*", "--table", table, "--available-now"]
    _run_app(args, ckpt)
    n_first = tables.dau_table(spark, table).count()
    want_first = dau.dedup_daily(td.startup_log(spark, SF001).filter(F.col("log_date") == first_day)).count()
    assert n_first == want_first

    # the restarted process picks up only the new file
    publish(late, "_b")
    _run_app(args, ckpt)
    got = tables.dau_table(spark, table)
    assert got.count() == dau.dedup_daily(td.startup_log(spark, SF001)).count()
    # one checkpoint for this job on this table and source, and one generation: the same query went on
    (job,) = os.listdir(os.path.join(ckpt, "streams"))
    assert job.startswith("dau-") and os.path.isdir(os.path.join(ckpt, "streams", job, "commits"))
    written = spark.read.parquet(table).select("gen", "batch_id").distinct().collect()
    assert len(written) >= 2 and len({r["gen"] for r in written}) == 1
