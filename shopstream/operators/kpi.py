"""KPI reports: the daily total document and the today-vs-yesterday hour series.

Each report reads its table once: the two days of a comparison come from one scan
filtered on ``date IN (day, day-1)`` (partition pruning when the table is partitioned
by date) and are labelled, instead of two scans and a union.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ids and display names of the three KPI rows, and the device-count
# placeholder the upstream report always returns for new devices.
KPI_DAU = ("dau", "新增日活")
KPI_NEW_MID = ("new_mid", "新增用户")
KPI_ORDER_AMOUNT = ("order_amount", "新增交易额")
NEW_MID_VALUE = 233

TODAY, YESTERDAY = "today", "yesterday"
VALUE_TYPES = {"dau": "long", "order": "decimal(20,2)"}


def yesterday_of(day: str) -> str:
    return (_dt.date.fromisoformat(day) - _dt.timedelta(days=1)).isoformat()


def kpi_total(dau: DataFrame, orders: DataFrame, day: str, order_day: str | None = None) -> DataFrame:
    """Rows ``(ord, id, name, value)``: devices of the day, the new-device placeholder,
    and the order amount of the day (null when there are no orders). ``order_day``
    reads the amount for another day (defaults to ``day``)."""
    order_day = order_day or day
    def row(ord_, kpi, value):
        return F.struct(F.lit(ord_).alias("ord"), F.lit(kpi[0]).alias("id"),
                        F.lit(kpi[1]).alias("name"), value.cast("double").alias("value"))

    # the placeholder row rides on the device-count aggregate: one scan, two rows
    devices = (dau.filter(F.col("log_date") == day)
                  .agg(F.count(F.lit(1)).alias("n"))
                  .select(F.explode(F.array(row(1, KPI_DAU, F.col("n")),
                                            row(2, KPI_NEW_MID, F.lit(NEW_MID_VALUE)))).alias("r"))
                  .select("r.*"))
    amount = (orders.filter(F.col("create_date") == order_day)
                    .agg(F.sum("total_amount").alias("v"))
                    .select(row(3, KPI_ORDER_AMOUNT, F.col("v")).alias("r"))
                    .select("r.*"))
    return devices.unionByName(amount)


def kpi_total_json(kpi: DataFrame) -> DataFrame:
    """One row ``doc``: the KPI rows as a JSON array in ``ord`` order. Counts are
    written as integers, the amount with two decimals; a null amount is omitted."""
    as_amount = F.to_json(F.struct("id", "name", F.col("value").cast("decimal(20,2)").alias("value")))
    as_count = F.to_json(F.struct("id", "name", F.col("value").cast("long").alias("value")))
    item = F.when(F.col("id") == KPI_ORDER_AMOUNT[0], as_amount).otherwise(as_count)
    ordered = F.array_sort(F.collect_list(F.struct(F.col("ord"), item.alias("json"))))
    doc = F.concat(F.lit("["), F.array_join(F.transform(ordered, lambda r: r["json"]), ","), F.lit("]"))
    return kpi.agg(doc.alias("doc"))


def hourly_compare(df: DataFrame, day: str, date_col: str, hour_col: str, value: Column) -> DataFrame:
    """``series, hour, value`` for ``day`` (today) and the day before (yesterday)."""
    prev = yesterday_of(day)
    return (df.filter(F.col(date_col).isin(day, prev))
              .groupBy(F.when(F.col(date_col) == day, F.lit(TODAY)).otherwise(F.lit(YESTERDAY)).alias("series"),
                       F.col(hour_col).alias("hour"))
              .agg(value.alias("value")))


def dau_hourly_compare(dau: DataFrame, day: str) -> DataFrame:
    return hourly_compare(dau, day, "log_date", "log_hour", F.count(F.lit(1)))


def order_hourly_compare(orders: DataFrame, day: str) -> DataFrame:
    return hourly_compare(orders, day, "create_date", "create_hour", F.sum("total_amount"))


def metric_hourly_compare(kind: str, dau: DataFrame | None, orders: DataFrame | None,
                          day: str) -> DataFrame | None:
    """Metric switch: ``dau`` or ``order``; any other kind gives ``None`` (no document)."""
    if kind == "dau":
        return dau_hourly_compare(dau, day)
    if kind == "order":
        return order_hourly_compare(orders, day)
    return None


def hourly_compare_json(series: DataFrame, value_type: str = "long") -> DataFrame:
    """One row ``doc``: ``{"today":{"HH":v,...},"yesterday":{...}}`` with hours in order.
    A day without rows gives an empty object. ``value_type`` is ``long`` or ``decimal(20,2)``."""
    entry = F.struct(F.col("hour"), F.col("value").cast(value_type).alias("value"))
    grouped = series.groupBy("series").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("m"))
    pairs = grouped.agg(F.map_from_entries(F.collect_list(F.struct("series", "m"))).alias("mm"))
    empty = F.create_map().cast("map<string,%s>" % value_type)
    doc = F.struct(F.coalesce(F.col("mm")[TODAY], empty).alias(TODAY),
                   F.coalesce(F.col("mm")[YESTERDAY], empty).alias(YESTERDAY))
    return pairs.select(F.to_json(doc).alias("doc"))


def hour_documents(hours: DataFrame, value_type: str = "long") -> DataFrame:
    """``date, hour, value`` (a row an hour) -> ``day, doc`` for every day that has values: the document of ``hourly_compare_json`` for
    that day. A day's 24 hours are brought together once and stand in its own document and in the next day's. Rows without a date or
    hour belong to no document; an empty table gives an empty result."""
    entry = F.struct(F.col("hour"), F.col("value").cast(value_type).alias("value"))
    per_day = (hours.filter(F.col("date").isNotNull() & F.col("hour").isNotNull())
                    .groupBy("date").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("m")))
    next_day = F.date_format(F.date_add(F.col("date").cast("date"), 1), "yyyy-MM-dd")
    placed = per_day.select("m", F.explode(F.array(F.struct(F.col("date").alias("day"), F.lit(TODAY).alias("series")),
                                                   F.struct(next_day.alias("day"), F.lit(YESTERDAY).alias("series")))).alias("at"))
    both = placed.groupBy("at.day").agg(*[F.any_value(F.when(F.col("at.series") == s, F.col("m")), F.lit(True)).alias(s) for s in (TODAY, YESTERDAY)])
    empty = F.create_map().cast("map<string,%s>" % value_type)
    doc = F.struct(F.col(TODAY), F.coalesce(F.col(YESTERDAY), empty).alias(YESTERDAY))
    return both.filter(F.col(TODAY).isNotNull()).select("day", F.to_json(doc).alias("doc"))
