"""Micro-batch sinks for ``foreachBatch``: keyed upserts and topic fan-out.

The file sinks are idempotent per query and ``batch_id``: a batch that is replayed after a failure
(the checkpoint records it as planned but not committed) rewrites its own output folder, so
their result is exactly-once, and a query with a fresh checkpoint writes to folders of its own.
The Kafka sink is at-least-once: a replayed batch is sent again, with the same keys; consumers
that keep the latest record per key are not affected.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.operators import upsert

# Fixed value: header of a Kafka record that carries the change time (epoch millis).
TIME_HEADER = "change_time_ms"


def upsert_sink(path: str, keys: Sequence[str], order: Sequence[str] = (),
                keep: str = "last", partition_by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing each batch as a keyed merge-on-read batch."""
    def write(df: DataFrame, batch_id: int) -> None:
        upsert.write_batch(df, path, batch_id, keys, order, keep, partition_by, upsert.query_id(df))
    return write


def batch_folder(df: DataFrame, path: str, batch_id: int) -> str:
    """Folder of this query's batch under ``path``."""
    gen = upsert.generation(df.sparkSession, path, upsert.query_id(df))
    return f"{path.rstrip('/')}/{upsert.GEN_COL}={gen}/{upsert.BATCH_COL}={int(batch_id)}"


def kafka_records(df: DataFrame) -> DataFrame:
    """``topic, key, value, headers``: records of one key go to one partition and keep their order there; the
    change time travels as a header."""
    key = F.col("key").cast("string") if "key" in df.columns else F.lit(None).cast("string")
    cols = ["topic", key.alias("key"), "value"]
    if "timestamp" in df.columns:
        stamp = F.unix_millis("timestamp").cast("string").cast("binary")
        cols.append(F.array(F.struct(F.lit(TIME_HEADER).alias("key"), stamp.alias("value"))).alias("headers"))
    return df.select(*cols)


def write_topics(df: DataFrame, batch_id: int, *, fmt: str = "kafka", path: str | None = None,
                 bootstrap_servers: str | None = None) -> None:
    """Send ``topic, value`` rows: one Kafka write for all topics, or (files) one
    folder per batch partitioned by topic, each row stamped with its ``timestamp``
    column when present (e.g. the change time), else the publish time - the record
    timestamp a Kafka topic would carry."""
    if fmt == "kafka":
        (kafka_records(df).write.format("kafka")
           .option("kafka.bootstrap.servers", bootstrap_servers).save())
    else:
        stamp = F.col("timestamp") if "timestamp" in df.columns else F.current_timestamp()
        key = F.col("key").cast("string") if "key" in df.columns else F.lit(None).cast("string")
        out = df.select("topic", key.alias("key"), "value", stamp.alias("timestamp"))
        out.write.mode("overwrite").partitionBy("topic").format(fmt).save(batch_folder(df, path, batch_id))


def fan_out(*writers: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Run several writers on one micro-batch, computing it once (persisted between
    the writes instead of recomputed per output)."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            for w in writers:
                w(df, batch_id)
        finally:
            df.unpersist()
    return write
