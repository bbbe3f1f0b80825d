"""Command-line launcher for the streaming jobs.

    python -m shopstream.streaming.apps dau    --servers HOST:9092 --table PATH
    python -m shopstream.streaming.apps orders --servers HOST:9092 --table PATH
    python -m shopstream.streaming.apps alerts --servers HOST:9092 --table PATH
    python -m shopstream.streaming.apps users  --servers HOST:9092 --table PATH
    python -m shopstream.streaming.apps sales  --servers HOST:9092 --table PATH --users PATH
    python -m shopstream.streaming.apps sales-topics --servers HOST:9092 --table PATH --users PATH
    python -m shopstream.streaming.apps unmatched    --servers HOST:9092 --table PATH
    python -m shopstream.streaming.apps hours  --servers HOST:9092 --table PATH --metric dau|order
    python -m shopstream.streaming.apps intake --servers HOST:9092 --table ARCHIVE --source-topic logs
    python -m shopstream.streaming.apps cdc    --servers HOST:9092 --source-topic changes
    python -m shopstream.streaming.apps compact --table PATH --snapshot PATH --key id [--order ts]
                                                [--partition-by create_date] [--keep first]

``--source-path`` (with ``--format json|text|parquet``) reads topic files instead of
Kafka; a topic root (what ``cdc`` and ``intake`` write with ``--topics-path``) serves all
jobs, each takes its own topics. ``--rejects PATH`` keeps the lines a job cannot use (a folder per topic where
it reads several), ``--counts PATH`` the counts of every batch, ``--archive PATH`` (alerts) takes the lists of
alerts from the intake's archive. A job that fails ends the process. Checkpoints go under ``spark.checkpoint.dir`` unless ``--checkpoint`` is given.
The master and cluster settings come from ``spark-submit``.
"""

from __future__ import annotations

import argparse

from shopstream.operators import routing, upsert
from shopstream.session import configured_join, get_spark
from shopstream.sources import streams
from shopstream.streaming import hours, jobs
from shopstream.streaming.counts import CountsListener

DEFAULT_TOPICS = {
    "dau": routing.TOPIC_STARTUP,
    "orders": routing.TOPIC_ORDER,
    "alerts": routing.TOPIC_EVENT,
    "users": routing.TOPIC_USER,
    "intake": "logs",
    "cdc": "changes",
}


# The topics whose lines a job can reject, by the parser that reads them.
REJECTED_TOPICS = {
    "sales": {"orders": routing.TOPIC_ORDER, "details": routing.TOPIC_ORDER_DETAIL},
    "unmatched": {"orders": routing.TOPIC_ORDER, "details": routing.TOPIC_ORDER_DETAIL},
    "sales-topics": {"orders": routing.TOPIC_ORDER, "details": routing.TOPIC_ORDER_DETAIL, "users": routing.TOPIC_USER},
}


def await_all(spark, queries) -> None:
    """Until all queries have ended; the first one that fails stops the others and is raised."""
    try:
        while any(q.isActive for q in queries):
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
        for q in queries:
            if (failed := q.exception()) is not None:
                raise failed
    finally:
        for q in queries:
            q.stop()


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="shopstream.streaming.apps")
    p.add_argument("job", choices=["dau", "orders", "alerts", "users", "sales", "sales-topics", "unmatched", "hours", "intake", "cdc", "compact"])
    p.add_argument("--servers", help="Kafka bootstrap servers")
    p.add_argument("--source-topic")
    p.add_argument("--source-path")
    p.add_argument("--format", default="json")
    p.add_argument("--table", help="output table / index / archive folder")
    p.add_argument("--users", action="append", help="user table folder (sales job; repeatable: snapshot first)")
    p.add_argument("--rejects", help="folder for the lines the job cannot use")
    p.add_argument("--counts", help="folder of the counts that the batches report")
    p.add_argument("--archive", help="alerts: the intake's archive, to read the lists of alerts from")
    p.add_argument("--metric", default="dau", choices=sorted(hours.CHANGES), help="hours: what is counted")
    p.add_argument("--timezone", help="time zone of dates and hours (default: the launcher's, else UTC)")
    p.add_argument("--topics-path", help="topic folder when not publishing to Kafka")
    p.add_argument("--checkpoint")
    p.add_argument("--trigger", default=jobs.DEFAULT_TRIGGER)
    p.add_argument("--max-per-trigger", type=int)
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--snapshot", help="compact: folder of the new snapshot table")
    p.add_argument("--key", action="append", help="compact: key column (repeatable)")
    p.add_argument("--order", action="append", default=[], help="compact: ordering column (repeatable)")
    p.add_argument("--keep", default="last", choices=["last", "first"])
    p.add_argument("--partition-by", action="append", default=[], help="compact: date partition column")
    a = p.parse_args(argv)

    zone = {"spark.sql.session.timeZone": a.timezone} if a.timezone else None
    spark = get_spark(app_name=f"shopstream-{a.job}", extra_conf=zone)
    if a.job == "compact":
        # batch maintenance: fold all merge-on-read batches into one snapshot
        upsert.compact(spark, a.table, a.snapshot, a.key, a.order, a.keep, a.partition_by,
                       batch_first=a.keep == "last" and not a.order)
        return
    fmt = "kafka" if a.source_path is None else a.format

    def source(topic):
        return streams.read_topic(spark, topic, fmt=fmt, bootstrap_servers=a.servers,
                                  path=a.source_path, max_per_trigger=a.max_per_trigger)

    run = dict(checkpoint=a.checkpoint, trigger=a.trigger, available_now=a.available_now,
               source=a.source_path or f"{a.servers} {a.source_topic}")
    parser = {"dau": "dau", "order": "orders"}[a.metric] if a.job == "hours" else a.job
    topic = a.source_topic or DEFAULT_TOPICS.get(parser)
    topics_fmt = "kafka" if a.topics_path is None else "json"
    spark.streams.resetTerminated()
    counts = None
    if a.counts:
        counts = CountsListener(spark, a.counts)
        spark.streams.addListener(counts)
    queries = []
    try:
        queries.append(_start(a, spark, source, topic, topics_fmt, fmt, run))
        queries += _start_rejects(a, spark, source, topic, fmt, run, parser)
        await_all(spark, queries)
    finally:
        if counts:
            for q in queries:
                counts.wait(q.id)
            spark.streams.removeListener(counts)
    if counts and counts.failure:
        raise counts.failure


def _start(a, spark, source, topic, topics_fmt, fmt, run):
    """The job itself."""
    if a.job == "dau":
        return jobs.start_dau(source(topic), a.table, **run)
    if a.job == "orders":
        return jobs.start_orders(source(topic), a.table, **run)
    if a.job == "alerts":
        return jobs.start_alerts(source(topic), a.table, archive=a.archive, **run)
    if a.job == "users":
        return jobs.start_users(source(topic), a.table, **run)
    if a.job == "sales":
        return jobs.start_sales(source(routing.TOPIC_ORDER), source(routing.TOPIC_ORDER_DETAIL), a.users, a.table, **run)
    if a.job == "sales-topics":
        topics = ",".join((routing.TOPIC_ORDER, routing.TOPIC_ORDER_DETAIL, routing.TOPIC_USER))
        return jobs.start_sales_topics(source(topics), a.users[0], a.table, **run)
    if a.job == "unmatched":
        return jobs.start_unmatched(source(routing.TOPIC_ORDER), source(routing.TOPIC_ORDER_DETAIL), a.table, **run)
    if a.job == "hours":
        return hours.start_hours(source(topic), a.metric, a.table, topics_fmt=topics_fmt, topics_path=a.topics_path, bootstrap_servers=a.servers, **run)
    if a.job == "intake":
        return jobs.start_intake(source(topic), a.table, topics_fmt=topics_fmt, rejects_path=a.rejects,
                                 topics_path=a.topics_path, bootstrap_servers=a.servers, **run)
    entries = streams.read_changes(spark, topic, fmt=fmt, bootstrap_servers=a.servers, path=a.source_path,
                                   max_per_trigger=a.max_per_trigger)
    return jobs.start_cdc(entries, topics_fmt=topics_fmt, topics_path=a.topics_path, bootstrap_servers=a.servers, **run)


def _start_rejects(a, spark, source, topic, fmt, run, parser) -> list:
    """Queries that keep the lines the job cannot use (the intake does it itself)."""
    if not a.rejects or a.job == "intake":
        return []

    def start(lines, parser, path, name):
        own = {**run, "checkpoint": f"{a.checkpoint}-{name}" if a.checkpoint else None}
        return jobs.start_rejects(lines, parser, path, **own)
    if a.job == "cdc":
        lines = streams.read_change_lines(spark, topic, fmt=fmt, bootstrap_servers=a.servers, path=a.source_path, max_per_trigger=a.max_per_trigger)
        return [start(lines, "cdc", a.rejects, "rejects")]
    if a.job in REJECTED_TOPICS:
        return [start(source(t), parser, configured_join(a.rejects, parser), f"rejects-{parser}") for parser, t in REJECTED_TOPICS[a.job].items()]
    return [start(source(topic), parser, a.rejects, "rejects")]


if __name__ == "__main__":
    main()
