"""Order landing and order KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream import schemas
from shopstream.functions import masking, timefmt


def enrich_orders(orders: DataFrame, mask=masking.mask_tel_tail) -> DataFrame:
    """Derive ``create_date``/``create_hour`` from ``create_time`` and mask the phone,
    then lay the row out as the 20-column order table (missing columns are null)."""
    out = (orders.withColumn("create_date", timefmt.create_date("create_time"))
                 .withColumn("create_hour", timefmt.create_hour("create_time")))
    if mask is not None:
        out = out.withColumn("consignee_tel", mask("consignee_tel"))
    cols = []
    for c in schemas.ORDER_TABLE_COLUMNS:
        if c in out.columns:
            cols.append(F.col(c))
        else:
            cols.append(F.lit(None).cast("string").alias(c))
    return out.select(*cols)


def order_total(orders: DataFrame, day: str) -> DataFrame:
    """``sum(total_amount) where create_date = day``; null when the day has no orders."""
    return (orders.filter(F.col("create_date") == day)
                  .agg(F.sum("total_amount").alias("order_amount")))


def order_hourly(orders: DataFrame, day: str) -> DataFrame:
    """Amount per hour of ``day``: ``create_hour, order_amount``."""
    return (orders.filter(F.col("create_date") == day)
                  .groupBy("create_hour")
                  .agg(F.sum("total_amount").alias("order_amount")))
