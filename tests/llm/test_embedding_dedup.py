"""Embedding near-dedup against brute force, recall of the candidate search, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopstream.llm import embedding_dedup
from tests.llm.helpers import union_find

SCHEMA = "vec_id long, embedding array<float>, label int"


def clustered(rnd, n, dim=32, centres=12):
    base = rnd.standard_normal((centres, dim))
    out = []
    for i in range(n):
        noise = rnd.choice([0.0, 0.1, 0.25, 0.35, 0.5])
        v = base[rnd.integers(centres)] + noise * rnd.standard_normal(dim)
        out.append((i, v.astype(np.float32).tolist(), int(rnd.integers(3))))
    return out


def brute(rows, threshold=0.93):
    ok = [v is not None and lab is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    links = []
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], np.float64), np.array(rows[j][1], np.float64)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links.append((i, j))
    root = union_find(len(rows), links)
    low = {}
    for i, r in enumerate(root):
        if rows[i][0] is not None:
            low[r] = min(low.get(r, rows[i][0]), rows[i][0])
    n = np.bincount(np.array(links, int).ravel(), minlength=len(rows))
    return sorted((rows[i][0] if rows[i][0] is not None else -1, int(n[i]), low.get(root[i], -1)) for i in range(len(rows)))


@pytest.mark.parametrize("block", [16, 2048])
def test_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", block)
    rows = clustered(np.random.default_rng(1), 260)
    rows += [(300 + i, rows[0][1], rows[0][2]) for i in range(40)] + [(400, [2 * x for x in rows[0][1]], rows[0][2])]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_recall_of_the_calibrated_count_at_the_threshold():
    rnd = np.random.default_rng(3)
    a = rnd.standard_normal((4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rnd.standard_normal((4000, 64))
    b -= (b * a).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * b
    lines = embedding_dedup.random_lines(64)
    count = embedding_dedup.calibrated_count(embedding_dedup.PROJECTIONS, embedding_dedup.WINDOW, embedding_dedup.MISS)
    width = embedding_dedup.WINDOW * embedding_dedup.deviation(0.93)
    hit = (np.abs(a @ lines - b @ lines) <= width).sum(axis=1) >= count
    assert hit.mean() > 0.999
    far = embedding_dedup.candidates((a @ lines)[:500], (a @ lines)[500:1000], width, count).mean()
    assert far < 0.05  # most unrelated pairs are never verified


def test_calibrated_count_is_the_binomial_quantile():
    assert embedding_dedup.calibrated_count(10, 100.0, 1e-6) == 10
    assert embedding_dedup.calibrated_count(32, 2.0, 0.5) in (30, 31)


def test_edge_cases(spark):
    assert embedding_dedup.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1),
            (8, [inf, 1.0], 1), (9, [1.0, None], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (None, [0.0, 1.0], 1), (1, [1.0, 0.0], 1),
            (12, [1e-30, 0.0], 1), (13, [3e38, 0.0], 1), (14, [-1.0, 0.0], 1), (14, [-1.0, 0.0], 1)]
    table = spark.createDataFrame(rows, SCHEMA)
    table = table.withColumn("node", F.lit("x")).withColumn("h", F.lit(1)).withColumn("links", F.lit(1))
    got = embedding_dedup.near_vectors(table).collect()
    assert sorted((r["vec_id"] or -1, r["n_links"], r["component_id"] or -1) for r in got) == brute(rows)
    assert {r["vec_id"] for r in got if r["kept"]} == {1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 14, None}


def test_links_next_to_the_threshold_don_t_depend_on_the_other_candidates():
    rnd = np.random.default_rng(5)
    a = rnd.standard_normal((300, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    for i, j in ((3, 9), (7, 200)):
        threshold = float(np.einsum("ij,ij->i", a[[i]], a[[j]])[0])
        for t in (threshold, np.nextafter(threshold, 2)):
            pairs = np.array([(i, j)] + [(x, y) for x in range(50) for y in range(300)])
            one = embedding_dedup.near_pairs(a, a, pairs[:1, 0], pairs[:1, 1], t, dense=False)[0]
            many = [embedding_dedup.near_pairs(a, a, pairs[:, 0], pairs[:, 1], t, dense=d) for d in (False, True)]
            assert one == many[0][0] == many[1][0] == (threshold >= t)
            assert np.array_equal(*many)
