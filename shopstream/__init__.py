"""Real-time commerce analytics as PySpark DataFrame operators.

Layout:

* ``sources``    - readers for the raw feeds (log lines, CDC envelopes, Kafka/file
                   streams) and the adapters that shape the shared test tables into
                   the logical tables the operators consume.
* ``functions``  - column-level helpers (JSON parsing, masking, time keys).
* ``operators``  - ``DataFrame -> DataFrame`` transforms: DAU dedup, order landing,
                   sale joins, coupon alerts, keyed upserts, KPI reports, routing.
* ``plans``      - the named query catalogue used by ``__spark_entry__`` and the bench.
* ``streaming``  - Structured Streaming jobs wiring the same operators to
                   checkpointed, idempotent sinks.
"""

from shopstream.session import get_spark

__all__ = ["get_spark"]
