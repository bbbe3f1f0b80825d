"""Daily active devices: drop devices already seen that day, keep one row per device
per day, and report daily / hourly counts.

Key is ``(mid, log_date)`` on both the seen side and the output (the upstream job read
the seen set under the processing date but wrote it under the event date; keying on the
event date removes the midnight double count).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream import schemas
from shopstream.operators.dedup import first_per_key

DAU_KEY = ["mid", "log_date"]

# A seen filter is a table of ``buckets`` bitmaps (4 KB each, at most 16 MB by default: this bounds its broadcast).
FILTER_BUCKETS = 4096
_BITS = 32_768  # of one bitmap of ``bitmap_construct_agg``
_PROBES = 3


def filter_unseen(logs: DataFrame, seen: DataFrame, keys=DAU_KEY) -> DataFrame:
    """Anti join against the seen ``(mid, log_date)`` set.

    No broadcast hint: the seen set grows with the number of devices, so the planner
    broadcasts it only when its estimated size is under
    ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks the real size at run time)
    and otherwise shuffles both sides on the key."""
    return logs.join(seen.select(*keys).distinct(), on=list(keys), how="left_anti")


def _probes(keys) -> tuple[Column, list[Column]]:
    """(hash for the bucket, places in its bitmap) of a key, from disjoint bits of one 64-bit hash."""
    h = F.xxhash64(*keys)
    places = [F.pmod(F.shiftrightunsigned(h, 15 * i), F.lit(_BITS)) for i in range(_PROBES)]
    return F.shiftrightunsigned(h, 15 * _PROBES), places


def seen_filter(seen: DataFrame, keys=DAU_KEY, buckets: int = FILTER_BUCKETS) -> DataFrame:
    """``(bucket, bits)``: a Bloom filter of the seen keys, blocked so that all bits of a key lie in one bitmap. Bits are set by
    an aggregate that is combined before its shuffle; the result has ``buckets`` rows at most, whatever the number of keys (more keys
    only mean more suspects). Meant to be kept per day and read by every batch."""
    high, places = _probes(keys)
    return (seen.select(F.pmod(high, F.lit(buckets)).cast("int").alias("bucket"), F.explode(F.array(*places)).alias("place"))
                .groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bits")))


def _bit(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return F.getbit(byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1


def filter_unseen_by_filter(logs: DataFrame, seen: DataFrame, known: DataFrame, keys=DAU_KEY, buckets: int = FILTER_BUCKETS) -> DataFrame:
    """``filter_unseen`` with the filter ``known`` of the seen keys (``seen_filter`` with as many ``buckets``): rows that it
    rejects are new and skip the anti join's shuffle, the suspects take it. Exact: the filter has no false negatives."""
    high, places = _probes(keys)
    small = F.broadcast(known.select(F.col("bucket").alias("_bucket"), "bits"))  # buckets * 4 KB at most
    marked = logs.withColumn("_bucket", F.pmod(high, F.lit(buckets)).cast("int")).join(small, "_bucket", "left")
    suspect = F.col("bits").isNotNull()
    for place in places:
        suspect = suspect & _bit(F.col("bits"), place)
    # a null key is never seen
    suspect = F.coalesce(suspect, F.lit(False)) & ~F.greatest(*[F.col(k).isNull() for k in keys])
    marked = marked.withColumn("_suspect", suspect).drop("_bucket", "bits")
    new = marked.filter(~F.col("_suspect")).drop("_suspect")
    return new.unionByName(filter_unseen(marked.filter("_suspect").drop("_suspect"), seen, keys).select(*new.columns))


def dedup_daily(logs: DataFrame, order=("ts", "event_id")) -> DataFrame:
    """First record per device and day, ordered by ``ts`` then a tiebreak column."""
    order = [c for c in order if c in logs.columns]
    return first_per_key(logs, DAU_KEY, order)


def new_devices(logs: DataFrame, seen: DataFrame, order=("ts", "event_id"), known: DataFrame | None = None) -> DataFrame:
    """First record per device and day among devices not yet seen that day; ``known`` is a ``seen_filter`` that tells
    most new devices without the seen set.

    Same result as ``dedup_daily(filter_unseen(logs, seen))`` (the anti join drops
    whole keys, so it commutes with the per-key pick) but planned the other way
    round: the per-key aggregate is combined map-side first, so a device that holds
    a third of all rows reaches the join as one row."""
    first = dedup_daily(logs, order)
    return filter_unseen(first, seen) if known is None else filter_unseen_by_filter(first, seen, known)


def dau_rows(logs: DataFrame) -> DataFrame:
    """The 11 DAU table columns in sink order."""
    return logs.select(*schemas.DAU_COLUMNS)


def dau_total(dau: DataFrame, day: str) -> DataFrame:
    """``count(*) where log_date = day`` -> one row ``dau_total`` (0 when empty)."""
    return dau.filter(F.col("log_date") == day).agg(F.count(F.lit(1)).alias("dau_total"))


def dau_hourly(dau: DataFrame, day: str) -> DataFrame:
    """Devices per hour of ``day``: ``log_hour, dau``."""
    return (dau.filter(F.col("log_date") == day)
               .groupBy("log_hour").agg(F.count(F.lit(1)).alias("dau")))


def filter_counts(logs: DataFrame, seen: DataFrame) -> DataFrame:
    """Counts around the seen filter: rows in, rows that pass the filter, and devices
    left after the in-batch dedup (``n_in, n_unseen, n_new``). Rows are counted per
    key before the join (map-side combined), so the join sees one row per key."""
    per_key = logs.groupBy(*DAU_KEY).agg(F.count(F.lit(1)).alias("_n"))
    marked = per_key.join(seen.select(*DAU_KEY).distinct().withColumn("_seen", F.lit(True)),
                          on=DAU_KEY, how="left")
    unseen = F.col("_seen").isNull()
    return marked.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_in"),
        F.coalesce(F.sum(F.when(unseen, F.col("_n"))), F.lit(0)).alias("n_unseen"),
        F.count_if(unseen).alias("n_new"),
    )
