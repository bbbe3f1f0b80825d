"""Operator 11, centroid clustering with bit-plane popcounts.

1. Components become integers and are cut into the bit planes of their two's complement: plane k of a vector is one
   uint64 that holds bit k of all 64 components. The planes are stored once; they are all that the rounds read.
2. A dot product with a centroid is a weighted sum of popcounts, of each plane of the vector ANDed with each plane of the centroid;
   all of it is integer arithmetic, so distances, ties and means are exact and don't depend on how rows are dealt.
3. A round reads the planes once. A task hands on 65 sums for each centroid (components and count), whatever its rows; the
   driver gets centroids * 65 numbers a round and divides them. A hot cluster is therefore never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import stored

DIM = 64
LIMIT = 1 << 27  # components saturate here: 64 squares of twice as much still fit a long
STRIP = 4096     # vectors compared at a time


def plane_weights(width: int) -> np.ndarray:
    """What a bit of each plane is worth; the highest plane is the sign."""
    weights = np.int64(1) << np.arange(width, dtype=np.int64)
    weights[-1] = -weights[-1]
    return weights


def plane_count(low: int, high: int) -> int:
    """Planes that hold every number from ``low`` to ``high``."""
    return max((-1 - low if low < 0 else low).bit_length(), (-1 - high if high < 0 else high).bit_length()) + 1


def packed_planes(x: np.ndarray, width: int) -> np.ndarray:
    """(n, 64) integers -> (n, width) planes of 64 bits."""
    bits = (x[:, None, :] >> np.arange(width)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<u8")[:, :, 0]


def unpacked(planes: np.ndarray) -> np.ndarray:
    """(n, width) planes -> (n, 64) integers."""
    width = planes.shape[1]
    bits = np.unpackbits(np.ascontiguousarray(planes)[:, :, None].view(np.uint8), axis=2, bitorder="little")
    out = np.zeros((len(planes), DIM), np.int64)
    for k, weight in enumerate(plane_weights(width)):
        out += weight * bits[:, k]
    return out


def dot_products(planes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """(n, width) and (m, width) planes -> (n, m) exact dot products, by weighted AND-popcounts."""
    weights = plane_weights(planes.shape[1])
    columns = np.ascontiguousarray(planes.T)
    out = np.zeros((len(others), len(planes)), np.int64)
    for c, other in enumerate(others):
        for k in np.flatnonzero(other):
            out[c] += weights[k] * (weights @ np.bitwise_count(columns & other[k]))
    return out.T


def squares(planes: np.ndarray) -> np.ndarray:
    """Squared lengths, by the same popcounts of a vector with itself."""
    weights = plane_weights(planes.shape[1])
    out = np.zeros(len(planes), np.int64)
    for k, weight in enumerate(weights):
        out += weight * (np.bitwise_count(planes & planes[:, k, None]) @ weights)
    return out


def nearest(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, the smaller one of a tie; squared distance) of each vector."""
    distance = squares(planes)[:, None] - 2 * dot_products(planes, centroids) + squares(centroids)
    cluster = np.argmin(distance, axis=1)
    return cluster, distance[np.arange(len(planes)), cluster]


def _plane_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, STRIP):
                batch = whole.slice(at, STRIP)
                x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, DIM)
                planes = packed_planes(x, width)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([p.tobytes() for p in planes], pa.binary())], names=["id", "planes"])
    return run


def _strips(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for whole in batches:
        for at in range(0, whole.num_rows, STRIP):
            batch = whole.slice(at, STRIP)
            planes = np.frombuffer(b"".join(batch.column("planes").to_pylist()), "<u8").reshape(-1, width)
            yield batch.column(0), planes


def _sum_rows(centroids: np.ndarray, width: int):
    """Rows (cluster, place, n): sums of the components of a task's vectors by cluster; the last place is their count."""
    own = packed_planes(centroids, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(own), DIM + 1), np.int64)
        for _, planes in _strips(batches, width):
            cluster, _ = nearest(planes, own)
            order = np.argsort(cluster, kind="stable")
            begin = np.flatnonzero(np.append(True, np.diff(cluster[order]) > 0))
            some = cluster[order][begin]
            total[some, :DIM] += np.add.reduceat(unpacked(planes[order]), begin)
            total[some, DIM] += np.diff(np.append(begin, len(order)))
        cluster, place = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cluster.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(total[cluster, place])],
                                         names=["cluster", "place", "n"])
    return run


def _assigned_rows(centroids: np.ndarray, width: int):
    own = packed_planes(centroids, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, planes in _strips(batches, width):
            cluster, distance = nearest(planes, own)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])
    return run


def moved(centroids: np.ndarray, planes: DataFrame, width: int) -> np.ndarray:
    """Centroids after a round: the floor of the mean of their vectors; empty ones stay."""
    sums = [[0] * (DIM + 1) for _ in centroids]
    rows = planes.mapInArrow(_sum_rows(centroids, width), "cluster int, place int, n long")
    for r in rows.groupBy("cluster", "place").agg(F.sum("n").alias("n")).collect():
        sums[r["cluster"]][r["place"]] = r["n"]
    return np.array([[s // n[DIM] for s in n[:DIM]] if n[DIM] else c.tolist() for c, n in zip(centroids, sums, strict=True)], np.int64)


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = 40, rounds: int = 5,
                    scale: int = 256, salt: str = "2") -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)``, one row per kept input row.

    Kept are vectors of exactly 64 components, none of them null or non-finite; each component x becomes floor(scale * x) and
    saturates at 2**27 on either side, so that a squared distance always fits a long. The first centroids are the kept vectors with the
    smallest SHA-256 of ``salt:id`` (ties, that is repeated ids: the smaller vector); fewer vectors give fewer centroids. Vectors
    without an id are clustered but start no centroid; if none has an id, the smallest vectors start them. Repeated rows count each
    time. Without a kept vector the result is empty.
    """
    spark = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>")
    sound = (F.size(v) == DIM) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(v, lambda x: F.greatest(F.lit(-LIMIT).cast("long"), F.least(F.lit(LIMIT).cast("long"), F.floor(x * float(scale)))))
    kept = vectors.where(sound).select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))
    schema = "vec_id long, cluster int, distance long"

    low, high = kept.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    if low is None:
        empty = spark.createDataFrame([], schema)
        return empty.select("*", *[F.lit(None).cast(t).alias(c) for c, t in
                                   (("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))])
    width = plane_count(low, high)
    named = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    first = kept.select(named.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(clusters).collect()
    first = [r for r in first if r["h"] is not None] or first
    centroids = np.array([r["v"] for r in first], np.int64)

    planes = stored(kept.mapInArrow(_plane_rows(width), "id long, planes binary"), "vector-planes")
    for _ in range(rounds):
        centroids = moved(centroids, planes, width)
    assigned = stored(planes.mapInArrow(_assigned_rows(centroids, width), schema), "vector-clusters")

    spread = {r["cluster"]: r["n"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    rows = [(c, spread.get(c, 0), sum(spread.values()), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for c, x in enumerate(centroids.tolist())]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster").select(  # a row a centroid
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
