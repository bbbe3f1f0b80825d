"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is an aggregation (combined before the shuffle) and an equi-join. What is aggregated is stored
before it is joined, so that both sides of the join have an exchange of their own and the engine's skew handling can split
a hub that touches a third of all rows; nothing is collected but two numbers a round. Rounds grow with the logarithm of the largest component.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import cut


def union_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components of ``a[i]`` and ``b[i]`` within a task; ``label`` holds each one's smallest member."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (deeper := label[label] != label).any():
            label[deeper] = label[label[deeper]]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u moves to the smallest of u and its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = cut(both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m")))
    return (both.where("v > u").join(low, "u")
            .select(F.col("m").alias("a"), F.col("v").alias("b"))
            .where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours move to the smallest of them. Edges have a < b."""
    low = cut(edges.groupBy("b").agg(F.min("a").alias("m")))
    moved = edges.join(low, "b").where("a <> m").select(F.col("m"), F.col("a").alias("c"))
    own = low.select("m", F.col("b").alias("c"))
    return moved.unionByName(own).select(F.col("m").alias("a"), F.col("c").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of longs -> ``(node, root)``, root the smallest node of the component.

    Nodes without an edge to another node are not returned. Loops, repeated edges and nulls are
    ignored; an empty table gives an empty result.
    """
    edges = cut(edges.where("a is not null and b is not null and a <> b")
                .select(F.least("a", "b").cast("long").alias("a"),
                        F.greatest("a", "b").cast("long").alias("b")).distinct())
    before = _state(edges)
    while before[0]:
        edges = cut(_small_star(cut(_large_star(edges))))
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(roots)
