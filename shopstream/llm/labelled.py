"""Labelled rows for the classifiers, and the small fits that run on their feature vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import fold, text_rows


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, folds: int, max_rows: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, body, y)``: texts of at most ``max_rows`` labelled ids whose crc32 modulo ``folds`` is not 0.

    Ids are taken in the order of a hash, so the sample doesn't depend on partitions or order. Null
    labels and ids are left out; an id with several labels has the largest. ``max_rows`` ids of 12 bytes are
    the proven bound of the broadcast side.
    """
    ids = (labels.where(F.col(target).isNotNull() & (fold(F.col(id_col), folds) != 0))
           .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(target).cast("int")).alias("y"))
           .orderBy(F.xxhash64("id"), "id").limit(max_rows))
    return text_rows(docs, id_col, text_col).join(F.broadcast(ids), "id")


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def logistic_fit(x: np.ndarray, y: np.ndarray, prior: np.ndarray, ridge: float, steps: int = 40) -> np.ndarray:
    """Coefficients with the least logistic loss plus ``ridge`` / 2 * squared distance from ``prior`` (Newton's
    method, each step halved until the loss falls)."""
    w = prior.astype(float).copy()

    def loss(w):
        z = x @ w
        return np.logaddexp(0, z).sum() - (y * z).sum() + ridge / 2 * ((w - prior) ** 2).sum()
    now = loss(w)
    for _ in range(steps):
        p = sigmoid(x @ w)
        grad = x.T @ (p - y) + ridge * (w - prior)
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step, size = np.linalg.solve(hess, grad), 1.0
        while (new := loss(w - size * step)) > now and size > 1e-4:
            size /= 2
        if new >= now - 1e-9:
            break
        w, now = w - size * step, new
    return w
