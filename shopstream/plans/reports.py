"""The two KPI reports over the tables the streaming jobs maintain.

* ``realtime_total(day)``       - devices of the day, the new-device placeholder and the
                                  order amount of the day, as rows or one JSON document.
* ``realtime_hour(day, kind)``  - ``dau`` or ``order`` per hour, today against yesterday,
                                  as rows or one JSON document; another kind gives None.

Both read only the date folders they need (the tables are partitioned by date).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopstream.operators import kpi
from shopstream.sources import tables


def realtime_total(spark: SparkSession, dau_path: str, order_path: str, day: str,
                   as_json: bool = False) -> DataFrame:
    rows = kpi.kpi_total(tables.dau_table(spark, dau_path, [day]),
                         tables.order_table(spark, order_path, [day]), day)
    return kpi.kpi_total_json(rows) if as_json else rows.select("id", "name", "value")


def realtime_hour(spark: SparkSession, dau_path: str, order_path: str, day: str, kind: str,
                  as_json: bool = False) -> DataFrame | None:
    days = [kpi.yesterday_of(day), day]
    readers = {"dau": lambda: tables.dau_table(spark, dau_path, days), "order": lambda: tables.order_table(spark, order_path, days)}
    if kind not in readers:
        return None
    source = readers[kind]()
    series = kpi.metric_hourly_compare(kind, source, source, day)
    return kpi.hourly_compare_json(series, "long" if kind == "dau" else "decimal(20,2)") if as_json else series
