"""Readers for the tables the streaming jobs maintain (DAU, orders, sale details,
alerts, users), with the report-date predicate applied where it prunes folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream import schemas
from shopstream.operators import upsert


def dau_table(spark: SparkSession, path: str, days=None) -> DataFrame:
    """DAU rows; with ``days`` only those ``log_date`` folders are read."""
    where = F.col("log_date").isin(*days) if days else None
    return upsert.read_latest(spark, path, ["mid", "log_date"], ["ts"], keep="first", where=where,
                              batch_first=False, partition_by=["log_date"], schema=schemas.DAU_TABLE)


def order_table(spark: SparkSession, path: str, days=None) -> DataFrame:
    """Order rows of the latest change; with ``days`` only those ``create_date`` folders are read."""
    where = F.col("create_date").isin(*days) if days else None
    return upsert.read_latest(spark, path, ["id"], ["timestamp", "offset"], where=where,
                              batch_first=False, partition_by=["create_date"], schema=schemas.ORDER_TABLE)


def sale_table(spark: SparkSession, path: str, days=None) -> DataFrame:
    """Sale detail rows (one per ``order_detail_id``); with ``days`` only those order
    dates (``dt`` folders) are read."""
    where = F.col("dt").isin(*days) if days else None
    return upsert.read_latest(spark, path, ["order_detail_id"], where=where, partition_by=["dt"], schema=schemas.SALE_TABLE)


def user_table(spark: SparkSession, path: str | list[str], only: DataFrame | None = None) -> DataFrame:
    """User rows of the latest change, of the ids in ``only`` if it is given. Several folders are one table (a snapshot first)."""
    return upsert.read_latest(spark, path, ["id"], ["timestamp", "offset"], batch_first=False, only=only, schema=schemas.USER_TABLE)


def keyed_table(spark: SparkSession, path: str, key: str, order=()) -> DataFrame:
    """Latest row per ``key`` of an index-like table (sale details, alerts)."""
    return upsert.read_latest(spark, path, [key], list(order))


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """Save rows as the catalogue table ``name``, hashed into ``buckets`` by ``key`` and sorted by it in each. Tables of as many
    buckets on the keys of a join (orders by ``id``, their details by ``order_id``; sales by ``user_id``, users by ``id``) are joined
    without an exchange, however large they are.

    The rows are brought together by bucket first, so a bucket is one file (its sort order then holds too). A key that
    holds a large share of the rows is one bucket and one task of the join: where that is too much, join the plain
    tables instead, whose exchange adaptive execution can split."""
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)
