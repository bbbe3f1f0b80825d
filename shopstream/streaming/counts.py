"""Batch counts kept as a table: what the jobs observe (rows in, rejected, new), written as each micro-batch ends.

The upstream printed these counts; here ``CountsListener`` turns the metrics of every query of the session into
JSON lines, one small file per query and batch. A batch that is replayed after a failure keeps its number and replaces its
own file, and a query that is restarted from its checkpoint keeps its id, so totals over the table count every
batch once, over any number of restarts. No Spark job runs for it.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from shopstream.operators.upsert import path_exists
from shopstream.session import configured_join

COUNTS_SCHEMA = "query string, query_id string, batch_id long, at string, metric string, field string, n long"


def metric_rows(progress) -> list[dict]:
    """One row per count that the batch of a progress report observed."""
    head = {"query": progress.name, "query_id": str(progress.id), "batch_id": progress.batchId, "at": progress.timestamp}
    return [{**head, "metric": metric, "field": field, "n": n}
            for metric, row in sorted(progress.observedMetrics.items()) for field, n in row.asDict().items() if n is not None]


class CountsListener(StreamingQueryListener):
    """Add it with ``spark.streams.addListener`` before the jobs start."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._conf, self.path = spark._jvm, spark._jsc.hadoopConfiguration(), path
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()
        self.failure: Exception | None = None

    def _end(self, query_id) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(str(query_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(event.id).clear()

    def onQueryProgress(self, event) -> None:
        rows = metric_rows(event.progress)
        if rows:
            try:
                self._write(event.progress, "".join(json.dumps(r) + "\n" for r in rows))
            except Exception as e:  # a report must not stop the job; the launcher tells of it
                self.failure = e

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(event.id).set()

    def _write(self, progress, text: str) -> None:
        folder = configured_join(self.path, f"query_id={progress.id}")
        hadoop = self._jvm.org.apache.hadoop.fs.Path(folder, f"{progress.batchId:012d}.json")
        out = hadoop.getFileSystem(self._conf).create(hadoop, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def wait(self, query_id, timeout: float = 60.0) -> bool:
        """Until all counts of a query that has ended are written (reports arrive in order, after the query itself has ended)."""
        return self._end(query_id).wait(timeout)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """``(query, query_id, batch_id, at, metric, field, n)``; nothing written yet: no rows."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], COUNTS_SCHEMA)
    return spark.read.schema(COUNTS_SCHEMA).json(path)


def total_counts(counts: DataFrame) -> DataFrame:
    """Sums over all batches: ``(query, metric, field, batches, n)``."""
    return counts.groupBy("query", "metric", "field").agg(F.count_distinct("query_id", "batch_id").alias("batches"), F.sum("n").alias("n"))
