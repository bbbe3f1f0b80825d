"""Sale detail: orders joined with their details, then with the latest user row.

* ``batch_full_join``   - orders FULL OUTER details within one micro-batch window
                          (rows that miss were cached upstream; ``match_kind`` tells).
* ``sale_join``         - the batch equivalent: orders INNER details.
* ``interval_join``     - orders INNER details whose arrival times are within a
                          tolerance (60 s): the net effect of the upstream cache.
* ``interval_full_join`` - the same with the orders and details that never meet (FULL OUTER);
                          ``full_rows`` is shared with the streaming form.
* ``user_latest``       - last row per user id.
* ``with_user``         - LEFT join of sales with users; age in whole years, 0 when
                          the user is unknown.

All joins are equi-joins on the order / user id, so Spark hash-partitions both sides
on the id (or broadcasts a side whose planned size is under the broadcast threshold);
the time bound of the interval join is a residual condition on the co-partitioned
rows, and in streaming it is what lets the state be evicted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.functions import timefmt
from shopstream.operators.dedup import latest_per_key

SALE_COLUMNS_NO_USER = ["order_detail_id", "order_id", "order_status", "create_time", "user_id",
                        "sku_id", "sku_price", "sku_name", "dt"]
SALE_COLUMNS = ["order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id",
                "user_gender", "user_age", "user_level", "sku_price", "sku_name", "dt"]

DEFAULT_TOLERANCE_S = 60
DEFAULT_BATCH_S = 5


def order_side(orders: DataFrame, *keep: str) -> DataFrame:
    return orders.select(F.col("id").alias("o_id"), F.col("user_id"), F.col("order_status"),
                         F.col("create_time"), F.col("create_date").alias("dt"),
                         F.col("ts").alias("o_ts"), *keep)


def detail_side(details: DataFrame, *keep: str) -> DataFrame:
    return details.select(F.col("id").alias("order_detail_id"), F.col("order_id"),
                          F.col("sku_id"), F.col("sku_name"),
                          F.col("order_price").cast("double").alias("sku_price"),
                          F.col("ts").alias("d_ts"), *keep)


def sale_row(j: DataFrame) -> DataFrame:
    return j.select("order_detail_id", F.col("o_id").alias("order_id"), "order_status",
                    "create_time", "user_id", "sku_id", "sku_price", "sku_name", "dt")


def batch_full_join(orders: DataFrame, details: DataFrame, batch_s: int = DEFAULT_BATCH_S) -> DataFrame:
    """Full outer join of orders and details that arrive in the same ``batch_s``-second
    micro-batch. ``match_kind`` is ``both``, ``order_only`` or ``detail_only``.

    Planned as ``details LEFT JOIN orders`` plus ``orders LEFT ANTI (distinct detail
    keys)`` rather than one FULL OUTER join: adaptive execution can split a skewed
    partition of the outer side of a left join, not of a full outer join, and an
    order with a third of all details would otherwise land in one task. The anti
    side only sees de-duplicated keys (combined map-side). Order ids are unique."""
    o = order_side(orders).withColumn("o_batch", timefmt.floor_to("o_ts", batch_s * 1000))
    d = detail_side(details).withColumn("d_batch", timefmt.floor_to("d_ts", batch_s * 1000))
    with_order = d.join(o, (d.order_id == o.o_id) & (d.d_batch == o.o_batch), "left")
    matched = with_order.select(
        F.col("order_id"), F.col("order_detail_id"),
        F.when(F.col("o_id").isNotNull(), F.lit("both")).otherwise(F.lit("detail_only")).alias("match_kind"),
        F.col("o_ts"), F.col("d_ts"))
    keys = d.select(F.col("order_id").alias("k_id"), F.col("d_batch").alias("k_batch")).distinct()
    lonely = o.join(keys, (o.o_id == keys.k_id) & (o.o_batch == keys.k_batch), "left_anti")
    order_only = lonely.select(F.col("o_id").alias("order_id"),
                               F.lit(None).cast("string").alias("order_detail_id"),
                               F.lit("order_only").alias("match_kind"), F.col("o_ts"),
                               F.lit(None).cast("long").alias("d_ts"))
    return matched.unionByName(order_only)


def sale_join(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Every (order, detail) pair with the same order id."""
    o, d = order_side(orders), detail_side(details)
    return sale_row(o.join(d, o.o_id == d.order_id, "inner"))


def interval_condition(o_ts: Column, d_ts: Column, tolerance_s: int) -> Column:
    tol = tolerance_s * 1000
    return (d_ts >= o_ts - F.lit(tol)) & (d_ts <= o_ts + F.lit(tol))


def interval_join(orders: DataFrame, details: DataFrame,
                  tolerance_s: int = DEFAULT_TOLERANCE_S) -> DataFrame:
    """(order, detail) pairs with the same order id whose arrival times differ by at
    most ``tolerance_s`` seconds (epoch-millis ``ts`` on both inputs)."""
    o, d = order_side(orders), detail_side(details)
    cond = (o.o_id == d.order_id) & interval_condition(o.o_ts, d.d_ts, tolerance_s)
    return sale_row(o.join(d, cond, "inner"))


def full_rows(j: DataFrame) -> DataFrame:
    """Rows of an outer join of both sides -> ``order_id, order_detail_id, match_kind, o_ts, d_ts``."""
    kind = (F.when(F.col("order_detail_id").isNull(), F.lit("order_only"))
             .when(F.col("o_id").isNull(), F.lit("detail_only")).otherwise(F.lit("both")))
    return j.select(F.coalesce("o_id", "order_id").alias("order_id"), "order_detail_id", kind.alias("match_kind"), "o_ts", "d_ts")


def interval_full_join(orders: DataFrame, details: DataFrame, tolerance_s: int = DEFAULT_TOLERANCE_S) -> DataFrame:
    """Orders FULL OUTER details with the same order id and arrival times within ``tolerance_s`` seconds: what the
    interval join pairs, and what it drops on either side.

    Planned as ``details LEFT JOIN orders`` (whose skewed side can be split) plus the orders without a detail in reach. These are
    found on details reduced to their first and last arrival per order and span of ``tolerance_s``: an order's reach holds one whole
    span, so a span's first or last arrival lies in it if any of its arrivals does. The reduction is combined map-side."""
    o, d = order_side(orders), detail_side(details)
    matched = d.join(o, (d.order_id == o.o_id) & interval_condition(o.o_ts, d.d_ts, tolerance_s), "left")
    span = timefmt.floor_to("d_ts", tolerance_s * 1000)
    spans = d.groupBy(F.col("order_id").alias("k_id"), span.alias("k_span")).agg(F.min("d_ts").alias("k_first"), F.max("d_ts").alias("k_last"))
    tol = F.lit(tolerance_s * 1000)
    in_reach = (o.o_id == spans.k_id) & (spans.k_last >= o.o_ts - tol) & (spans.k_first <= o.o_ts + tol)
    lonely = o.join(spans, in_reach, "left_anti").select(
        "o_id", F.lit(None).cast("string").alias("order_id"), F.lit(None).cast("string").alias("order_detail_id"),
        "o_ts", F.lit(None).cast("long").alias("d_ts"))
    return full_rows(matched).unionByName(full_rows(lonely))


def one_per_detail(sales_df: DataFrame) -> DataFrame:
    """One sale row per ``order_detail_id``: the latest by create time, then by all other columns,
    so that a replay picks the same row."""
    rest = [c for c in SALE_COLUMNS if c not in ("order_detail_id", "create_time")]
    return latest_per_key(sales_df.select(*SALE_COLUMNS), ["order_detail_id"], ["create_time", *rest])


def user_latest(users: DataFrame, order=("seq",)) -> DataFrame:
    """Latest row per user ``id`` by ``order`` (change sequence / change time)."""
    return latest_per_key(users, ["id"], list(order))


def with_user(sales_df: DataFrame, users: DataFrame, as_of: Column) -> DataFrame:
    """Left join with the user dimension: ``user_gender``, ``user_level`` (null when the
    user is unknown) and ``user_age`` (0 when unknown)."""
    u = users.select(F.col("id").alias("u_id"), F.col("gender").alias("user_gender"),
                     F.col("user_level"),
                     timefmt.age_in_years("birthday", as_of).alias("_age"))
    j = sales_df.join(u, sales_df.user_id == u.u_id, "left")
    return j.withColumn("user_age", F.coalesce(F.col("_age"), F.lit(0))).select(*SALE_COLUMNS)
