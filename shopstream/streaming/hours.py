"""Hour documents that the stream keeps up: each micro-batch publishes the documents of the days it has changed.

1. Keyed state (``changes``) holds what a device-day or an order counts for: date, hour and value. A row that takes the place of an
   earlier one (an earlier record of a device, a later version of an order) takes that one back, so what comes out are
   changes of hours, whatever the order of arrival.
2. A micro-batch sums its changes per hour and adds them to the hours of the batch before, 24 rows a day. Each batch writes
   all hours to a folder of its own; a replayed batch starts again from the folder before it and overwrites its own.

The work of a trigger follows its rows and the days kept, not the size of a day's table. The state is one small row per key and
passes through Python workers (Arrow batches): no built-in operator hands on the value that a new one replaces.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shopstream.functions import parse, timefmt
from shopstream.operators import alerts, kpi, upsert
from shopstream.streaming import jobs, sinks

KEPT_BATCHES = 20  # folders of hours that stay for readers and replays
_CHANGE = "date string, hour string, n long, value double"
_STATE = "first_order long, second_order long, date string, hour string, value double"
_HOURS = T.StructType([T.StructField("date", T.StringType()), T.StructField("hour", T.StringType()), T.StructField("n", T.LongType()),
                       T.StructField("value", T.DoubleType()), T.StructField("changed", T.BooleanType())])


def _replaced(first: bool, keep_ms: int) -> Callable:
    """State function: the earliest (``first``) or latest row of a key counts; hands on what it adds and what it takes back."""
    pick = min if first else max
    columns = ["first_order", "second_order", "date", "hour", "value"]

    def run(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held, new, latest = (state.get if state.exists else None), None, 0
        for part in parts:
            latest = max(latest, int(part["at"].max()))
            best = pick(zip(*(part[c].tolist() for c in columns), strict=True))
            new = best if new is None else pick(new, best)
        if new is None:
            return
        # of versions with one order the one that came last counts; a first record is only replaced by an earlier one
        wins = held is None or (new[:2] < tuple(held)[:2] if first else new[:2] >= tuple(held)[:2])
        out = []
        if wins:
            state.update(new)
            if held is None or tuple(held)[2:] != new[2:]:
                out = [(new[2], new[3], 1, new[4])] + ([] if held is None else [(held[2], held[3], -1, -held[4])])
        state.setTimeoutTimestamp(max(latest + keep_ms, state.getCurrentWatermarkMs() + 1))
        if out:
            yield pd.DataFrame(out, columns=["date", "hour", "n", "value"])
    return run


def _changes(rows: DataFrame, keys: list[str], first: bool, lateness: str, keep: str) -> DataFrame:
    """``rows``: keys, event_time, first_order, second_order, date, hour, value."""
    timed = rows.withColumn("at", F.unix_millis("event_time")).withWatermark("event_time", lateness)
    return timed.groupBy(*keys).applyInPandasWithState(_replaced(first, alerts.duration_ms(keep)), _CHANGE, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def dau_changes(lines: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Startup lines -> changes ``(date, hour, n, value)`` of the devices per hour: the earliest record of ``(mid, log_date)`` counts.
    A key is held for a day after its last record; records behind the watermark are left out."""
    logs = jobs.counted(parse.parse_startup(lines.select("value")), "dau_hours_rows", jobs.valid("dau"))
    rows = logs.filter(F.col("log_date").isNotNull()).select(
        "mid", "log_date", timefmt.ms_to_ts("ts").alias("event_time"), F.col("ts").alias("first_order"), F.lit(0).cast("long").alias("second_order"),
        F.col("log_date").alias("date"), F.col("log_hour").alias("hour"), F.lit(1.0).alias("value"))
    return _changes(rows, ["mid", "log_date"], True, lateness, "1 day")


def order_changes(lines: DataFrame, lateness: str = "1 hour", keep: str = "7 days") -> DataFrame:
    """Order lines -> changes of the amount per hour: the latest version of an order counts, once. ``keep``: how long after its last
    version an order can be replaced. A missing amount is 0; orders without a creation time belong to no hour."""
    orders = jobs.order_stream(lines).filter(F.col("create_date").isNotNull() & F.col("create_hour").isNotNull() & F.col("timestamp").isNotNull())
    rows = orders.select(
        "id", F.col("timestamp").alias("event_time"), F.unix_millis("timestamp").alias("first_order"), F.coalesce("offset", F.lit(-1)).cast("long").alias("second_order"),
        F.col("create_date").alias("date"), F.col("create_hour").alias("hour"), F.coalesce("total_amount", F.lit(0.0)).alias("value"))
    return _changes(rows, ["id"], False, lateness, keep)


CHANGES = {"dau": dau_changes, "order": order_changes}


def _batches(spark: SparkSession, folder: str) -> dict[int, str]:
    """Finished batches of a generation."""
    fs, hadoop = upsert.file_system(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(hadoop)] if fs.exists(hadoop) else []
    numbers = [int(n.partition("=")[2]) for n in names if n.startswith(f"{upsert.BATCH_COL}=")]
    return {b: path for b in sorted(numbers) if upsert.path_exists(spark, (path := f"{folder}/{upsert.BATCH_COL}={b}") + "/_SUCCESS")}


def read_hours(spark: SparkSession, path: str) -> DataFrame:
    """``date, hour, value`` as the last finished batch left them (of the newest generation)."""
    newest = upsert.generations(spark, path)[-1:]
    done = _batches(spark, f"{path.rstrip('/')}/{newest[0]}") if newest else {}
    hours = spark.read.schema(_HOURS).parquet(done[max(done)]) if done else spark.createDataFrame([], _HOURS)
    return hours.filter("n > 0").select("date", "hour", "value")


def hours_sink(table: str, metric: str, topic: str, **topics) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: add the changes to the hours, then publish the documents of the days they are part of."""
    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        own = sinks.batch_folder(df, table, batch_id)
        folder = own.rpartition("/")[0]
        done = _batches(spark, folder)
        before = [b for b in done if b < batch_id]
        now = df.select("date", "hour", "n", "value", F.lit(True).alias("changed"))
        if before:
            held = spark.read.schema(_HOURS).parquet(done[before[-1]])
            now = now.unionByName(held.withColumn("changed", F.lit(False)))
        # some rows a day: one file
        now.groupBy("date", "hour").agg(F.sum("n").alias("n"), F.sum("value").alias("value"), F.max("changed").alias("changed")).coalesce(1) \
           .write.mode("overwrite").parquet(own)
        hours = spark.read.schema(_HOURS).parquet(own)
        next_day = F.date_format(F.date_add(F.col("date").cast("date"), 1), "yyyy-MM-dd")
        days = hours.filter("changed").select(F.explode(F.array(F.col("date"), next_day)).alias("day")).distinct()
        docs = kpi.hour_documents(hours.filter("n > 0"), kpi.VALUE_TYPES[metric]).join(days, "day", "left_semi")
        sinks.write_topics(docs.select(F.lit(topic).alias("topic"), F.col("day").alias("key"), F.col("doc").alias("value")), batch_id, **topics)
        for b in before[:-KEPT_BATCHES]:
            fs, hadoop = upsert.file_system(spark, done[b])
            fs.delete(hadoop, True)
    return write


def start_hours(lines: DataFrame, metric: str, path: str, *, topics_fmt: str = "kafka", topics_path: str | None = None,
                bootstrap_servers: str | None = None, topic: str | None = None, lateness: str = "1 hour", **kw) -> StreamingQuery:
    """Keep the hours of ``metric`` (``dau`` or ``order``) in ``path`` and publish a day's document, keyed by day, with every batch that
    changes it. A fresh checkpoint reads its topic anew and counts in a generation of its own."""
    sink = hours_sink(path, metric, topic or f"hours_{metric}", fmt=topics_fmt, path=topics_path, bootstrap_servers=bootstrap_servers)
    return jobs.start(CHANGES[metric](lines, lateness), f"hours-{metric}", sink, target=path, **kw)
