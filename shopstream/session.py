"""Session construction and the few settings the operators rely on."""

from __future__ import annotations

import hashlib
import tempfile

from pyspark.sql import SparkSession

# SQL settings every job wants, unless the launcher has set them. Partition counts are left to
# the caller / cluster defaults; AQE coalesces small shuffles and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Time zone decides how epoch millis become log_date / log_hour.
    "spark.sql.session.timeZone": "UTC",
    # CDC after-images may repeat a column name; the last value wins, like a map put.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def get_spark(master: str | None = None, app_name: str = "shopstream",
              extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session. ``master`` is only set when given: on a cluster the
    launcher decides it. ``extra_conf`` wins over the launcher's settings (spark-submit,
    spark-defaults), and those win over ``DEFAULT_CONF``. A session that is there keeps its own."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    fresh = SparkSession.getActiveSession() is None
    spark = builder.getOrCreate()
    if fresh:
        launched = spark.sparkContext.getConf()
        for k, v in DEFAULT_CONF.items():
            if not launched.contains(k):
                spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("WARN")
    return spark


_LOCAL_ROOT: str | None = None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to shared storage and it is used as is (the
    RDD checkpoint dir is set from it when missing); a cluster session without it is an
    error, because a folder of one machine would be lost or unseen by the others. Only in
    local runs (tests) a scratch folder is created once per process and used instead.
    The returned path is the configured base, not the per-application sub-folder
    Spark creates for RDD checkpoints, so streaming checkpoints under it survive
    an application restart."""
    global _LOCAL_ROOT
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to shared storage")
        if _LOCAL_ROOT is None:
            _LOCAL_ROOT = tempfile.mkdtemp(prefix="shopstream-ckpt-")
        configured = _LOCAL_ROOT
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured


def checkpoint_path(spark: SparkSession, name: str, *identity: str | None) -> str:
    """A stable sub-folder of the checkpoint base for a streaming query: the same job on the
    same output and source resumes, any other starts afresh."""
    digest = hashlib.sha256("\0".join(x or "" for x in identity).encode()).hexdigest()[:16]
    return configured_join(ensure_checkpoint_dir(spark), "streams", f"{name}-{digest}")


def configured_join(base: str, *parts: str) -> str:
    """Join path parts with ``/`` (also for URIs such as ``hdfs://`` or ``s3a://``)."""
    return "/".join([base.rstrip("/"), *parts])
