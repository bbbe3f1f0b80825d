"""Streaming sources: one topic of JSON strings as a streaming DataFrame.

``read_topic`` returns ``value`` (the JSON text), ``timestamp`` (change or arrival time) and
``offset`` (order of records of one key, null in files) whatever the transport: Kafka in
production, a folder of JSON-lines / text / parquet files in tests (no Kafka jar ships with the
test image). ``max_per_trigger`` bounds a micro-batch like the upstream bounded poll.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream import schemas
from shopstream.streaming.sinks import TIME_HEADER

# Files of a topic root (``gen=../batch_id=../topic=..``) or of a single topic (then ``topic`` is null).
LINE_SCHEMA = T.StructType([T.StructField("value", T.StringType()),
                            T.StructField("timestamp", T.TimestampType()),
                            T.StructField("gen", T.StringType()),
                            T.StructField("batch_id", T.StringType()),
                            T.StructField("topic", T.StringType())])


def kafka_lines(records: DataFrame, keep_topic: bool) -> DataFrame:
    """Kafka records -> lines; the change time in the header wins over the record's own time."""
    sent = F.element_at(F.filter("headers", lambda h: h["key"] == TIME_HEADER), 1)["value"].cast("string").cast("long")
    cols = [F.col("value").cast("string").alias("value"),
            F.coalesce(F.timestamp_millis(sent), F.col("timestamp")).alias("timestamp"), F.col("offset")]
    return records.select(*cols, *([F.col("topic")] if keep_topic else []))


def read_topic(spark: SparkSession, topic: str, *, fmt: str = "kafka",
               bootstrap_servers: str | None = None, path: str | None = None,
               starting_offsets: str = "latest", max_per_trigger: int | None = None) -> DataFrame:
    """Stream of ``value, timestamp, offset`` for one topic (or comma-separated topics; then a
    ``topic`` column is kept so one source can feed several jobs).

    ``fmt="kafka"`` subscribes to the topic starting at ``starting_offsets``; offsets
    are tracked in the query checkpoint, not auto-committed. ``fmt="json"`` reads files with
    fields ``value``/``timestamp``: of a single topic, or a topic root whose other topics are left
    out; ``fmt="text"`` reads raw lines and stamps the file-discovery time."""
    several = "," in topic
    if fmt == "kafka":
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", bootstrap_servers)
                  .option("subscribe", topic)
                  .option("includeHeaders", "true")
                  .option("startingOffsets", starting_offsets))
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return kafka_lines(reader.load(), several)
    reader = spark.readStream
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    no_offset = F.lit(None).cast("long").alias("offset")
    if fmt == "text":
        return reader.text(path).select(F.col("value"), F.current_timestamp().alias("timestamp"), no_offset)
    lines = reader.schema(LINE_SCHEMA).format(fmt).load(path)
    wanted = lines.filter(F.col("topic").isNull() | F.col("topic").isin(*(t.strip() for t in topic.split(","))))
    return wanted.select("value", "timestamp", no_offset, *(["topic"] if several else []))


def read_change_lines(spark: SparkSession, topic: str | None = None, *, fmt: str = "kafka", bootstrap_servers: str | None = None,
                      path: str | None = None, starting_offsets: str = "latest", max_per_trigger: int | None = None) -> DataFrame:
    """Stream of the JSON text of change entries, from a Kafka topic or from JSON-lines files."""
    return read_topic(spark, topic or "changes", fmt="kafka" if fmt == "kafka" else "text", bootstrap_servers=bootstrap_servers, path=path,
                      starting_offsets=starting_offsets, max_per_trigger=max_per_trigger)


def read_changes(spark: SparkSession, topic: str | None = None, *, fmt: str = "kafka",
                 bootstrap_servers: str | None = None, path: str | None = None,
                 starting_offsets: str = "latest", max_per_trigger: int | None = None) -> DataFrame:
    """Stream of change entries (``schemas.CDC_ENTRY_SCHEMA``): from a Kafka topic or files that carry them as
    JSON, or from files of another format; a micro-batch takes ``max_per_trigger`` records (files) at most. A line
    that is no entry is a row of nulls."""
    if fmt in ("kafka", "json"):
        return changes_of(read_change_lines(spark, topic, fmt=fmt, bootstrap_servers=bootstrap_servers, path=path,
                                            starting_offsets=starting_offsets, max_per_trigger=max_per_trigger))
    reader = spark.readStream.schema(schemas.CDC_ENTRY_SCHEMA)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.format(fmt).load(path)


def changes_of(lines: DataFrame) -> DataFrame:
    """JSON lines -> change entries."""
    return lines.select(F.from_json("value", schemas.CDC_ENTRY_SCHEMA).alias("e")).select("e.*")
