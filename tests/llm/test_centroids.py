"""Centroid clustering against plain integer arithmetic, planes, ties and edge cases."""

import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shopstream.llm import centroids
from shopstream.llm.oracle import OP11
from shopstream.llm.queries import op11_centroid_clustering
from tests.conftest import SF001

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute_force(rows, clusters, rounds):
    """rows: (id, vector) -> {id: (cluster, distance, cluster_inertia, inertia, digest)}, all in Python integers."""
    kept = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows]
    means = [v for _, v in sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept)[:clusters]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, m, strict=True)), c) for c, m in enumerate(means))
    for _ in range(rounds):
        own = [[v for _, v in kept if nearest(v)[1] == c] for c in range(len(means))]
        means = [[sum(col) // len(vs) for col in zip(*vs, strict=True)] if vs else m for vs, m in zip(own, means, strict=True)]
    best = {i: nearest(v) for i, v in kept}
    spread = [sum(d for d, c in best.values() if c == k) for k in range(len(means))]
    return {i: (c, d, spread[c], sum(spread), hashlib.sha256(",".join(map(str, means[c])).encode()).hexdigest()) for i, (d, c) in best.items()}


def as_dict(df):
    return {r["vec_id"]: tuple(r)[1:] for r in df.collect()}


def test_planes_hold_the_numbers_and_popcounts_their_products():
    rnd = np.random.default_rng(1)
    for low, high in ((-300, 290), (0, 1), (-1, 0), (-(1 << 27), 1 << 27), (5, 5)):
        x = rnd.integers(low, high + 1, (50, 64))
        x[0], x[1] = low, high
        planes = centroids.packed_planes(x, centroids.plane_count(low, high))
        assert np.array_equal(centroids.unpacked(planes), x)
        assert np.array_equal(centroids.dot_products(planes, planes[:7]), x @ x[:7].T)
        assert np.array_equal(centroids.squares(planes), (x * x).sum(axis=1))


@pytest.mark.parametrize("strip", [3, 4096])
def test_equals_brute_force(spark, monkeypatch, strip):
    monkeypatch.setattr(centroids, "STRIP", strip)
    rnd = np.random.default_rng(2)
    rows = [(i, rnd.normal(0, 1 if i % 3 else 40, 64).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(5)] + [(200, [0.0] * 64), (201, [0.001] * 64), (202, [-0.001] * 64)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(7)
    assert as_dict(centroids.cluster_vectors(df, clusters=8, rounds=3)) == brute_force(rows, 8, 3)


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    rows = [(i, [1.0] * 64) for i in range(6)]
    got = as_dict(centroids.cluster_vectors(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA), clusters=4, rounds=2))
    assert {v[0] for v in got.values()} == {0} and got == brute_force(rows, 4, 2)


def test_shared_table_and_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF001}/embeddings.parquet'")
    res = con.execute(OP11)
    names = [c[0] for c in res.description]
    want = sorted(tuple(r[names.index(c)] for c in sorted(names)) for r in res.fetchall())
    got = op11_centroid_clustering(spark, SF001)
    assert sorted(tuple(r) for r in got.select(*sorted(got.columns)).collect()) == want


def test_edge_cases(spark):
    inf, nan, good = float("inf"), float("nan"), [0.5] * 64
    rows = [(1, good, 0), (2, None, 0), (3, [], 0), (4, [0.5] * 63, 0), (5, [None, *good[1:]], 0), (6, [nan, *good[1:]], 0), (7, [-inf, *good[1:]], 0),
            (None, good, 0), (8, [1e300, *good[1:]], None), (8, [1e300, *good[1:]], None), (9, [-0.0] * 64, 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("cluster", F.lit("x")).withColumn("planes", F.lit(1)).withColumn("v", F.lit(2)).withColumn("h", F.lit(3))
    got = centroids.cluster_vectors(df, clusters=2, rounds=1).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0) for r in got) == [(False, 1), (False, 8), (False, 8), (False, 9), (True, 0)]
    assert all(r["distance"] >= 0 for r in got)
    nameless = centroids.cluster_vectors(df.where("vec_id is null"), clusters=2)
    assert [(r["vec_id"], r["cluster"], r["distance"]) for r in nameless.collect()] == [(None, 0, 0)]
    empty = centroids.cluster_vectors(df.where("vec_id between 2 and 7"))
    assert empty.count() == 0 and empty.columns == nameless.columns and empty.dtypes == nameless.dtypes
