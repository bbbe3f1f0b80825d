"""Operator 4, quality classifier: Bradley-Terry pairwise ranking.

A document's strength is linear in its features; the chance that a good document beats a bad one is the
logistic function of their difference. The weights minimise the logistic loss on feature differences
of (good, bad) pairs from a bounded sample of labelled training rows. The cut between accepted and rejected is
a quantile of the training strengths: the one that agrees with most of the labels. Scores are
the strengths through a monotone map that puts the cut at ``THRESHOLD``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.llm.common import fold
from shopstream.llm.labelled import labelled_sample, logistic_fit, sigmoid

THRESHOLD = 0.3
MAX_LABELLED = 20_000
PAIRS = 32  # partners of each row of the rarer class
_PLAIN = b".,;:'\"-()?"
_SYMBOLS = bytes(c for c in range(0x21, 0x7F) if not bytes([c]).isalnum() and c not in _PLAIN)
_UPPER = bytes(range(0x41, 0x5B))
_LETTERS = _UPPER + bytes(range(0x61, 0x7B))
_DIGITS = bytes(range(0x30, 0x3A))
_CONTROL = bytes(c for c in range(0x20) if c not in b"\t\n\x0b\x0c\r") + b"\x7f"
FEATURES = ["symbols", "upper", "digits", "control", "repeat_next", "repeat_any", "top_word", "repeat_lines",
            "word_length", "long_words", "length"]


def features(body: bytes) -> list[float]:
    """What can be told of any whole text, empty ones too, in a bounded range each."""
    size = max(1, len(body))
    letters = len(body) - len(body.translate(None, _LETTERS))
    upper = len(body) - len(body.translate(None, _UPPER))
    words = body.lower().split()
    n = len(words)
    counts = Counter(words)
    lines = body.split(b"\n")
    some = n / (n + 10)  # shares of few words say little
    following = sum(map(bytes.__eq__, words, words[1:])) if n > 1 else 0
    return [
        ((size - len(body.translate(None, _SYMBOLS))) / size) ** 0.5 if body else 0.0,
        upper / (letters + 20),
        ((size - len(body.translate(None, _DIGITS))) / size) ** 0.5 if body else 0.0,
        ((size - len(body.translate(None, _CONTROL))) / size) ** 0.5 if body else 0.0,
        some * following / n if n else 0.0,
        # words per distinct word beyond what longer texts have anyway (vocabulary grows as a power of the length)
        max(0.0, np.log(max(1, n) / max(1, len(counts))) - 0.15 * np.log1p(n / 100)),
        some * (max(counts.values()) / n) if n else 0.0,
        1 - len(set(lines)) / len(lines),
        min(3.0, sum(map(len, words)) / n / 10) if n else 0.0,
        sum(len(w) > 40 for w in words) / n if n else 0.0,
        np.log1p(n) / 10,
    ]


@dataclass
class Model:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))
    centre: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))
    scale: np.ndarray = field(default_factory=lambda: np.ones(len(FEATURES)))
    cut: float = 0.0
    slope: float = 1.0
    offset: float = 0.0  # logit of the score at the cut

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -20, 20) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * (self.strength(x) - self.cut) + self.offset)


def pairs(good: int, bad: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Indices of PAIRS partners for every row of the rarer class, and of every row of the other at least once."""
    rnd = np.random.default_rng(seed)
    few = min(good, bad)
    n = max(good, bad, few * PAIRS)
    a, b = np.resize(rnd.permutation(good), n), np.resize(rnd.permutation(bad), n)
    return a, rnd.permutation(b)


def best_quantile(strength: np.ndarray, y: np.ndarray) -> float:
    """The quantile level at which accepting what is above agrees with most labels (the middle of equals)."""
    order = np.argsort(strength, kind="stable")
    s, y = strength[order], y[order]
    right = np.append(0, np.cumsum(y == 0)) + np.append(np.cumsum((y == 1)[::-1])[::-1], 0)
    split = np.append(True, np.append(s[1:] > s[:-1], True))  # not between ties
    best = np.flatnonzero(split & (right == right[split].max()))
    return float(best[len(best) // 2]) / len(s)


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Without rows of both labels there is nothing to rank: all scores are 0.5."""
    if not len(y) or y.min() == y.max():
        return Model()
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    z = np.clip((x - centre) / scale, -20, 20)
    good, bad = z[y == 1], z[y == 0]
    a, b = pairs(len(good), len(bad))
    diff = good[a] - bad[b]
    zero = np.zeros(z.shape[1])
    weights = logistic_fit(diff, np.ones(len(diff)), zero, ridge=max(1.0, len(diff) / 1000))
    model = Model(weights, centre, scale)
    s = model.strength(x)
    level = best_quantile(s, y)
    s_sorted = np.sort(s)
    at = int(round(level * len(s)))
    model.cut = float((s_sorted[max(0, at - 1)] + s_sorted[min(len(s) - 1, at)]) / 2)
    spread = np.stack([s - model.cut, np.ones(len(s))], axis=1)
    model.slope = float(max(0.1, logistic_fit(spread, y.astype(float), np.array([1.0, 0.0]), ridge=1.0)[0]))
    model.offset = float(np.log(THRESHOLD / (1 - THRESHOLD)))
    return model


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [features(b or b"") for b in batch.column("body").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(values, pa.list_(pa.float64()))], names=["y", "x"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", target: str = "quality",
          folds: int = 5, max_labelled: int = MAX_LABELLED) -> Model:
    """Fit on at most ``max_labelled`` labelled rows outside the held-out fold (a bounded sample)."""
    sample = labelled_sample(docs, labels, target, folds, max_labelled, id_col, text_col)
    rows = sample.select("y", "body").mapInArrow(_feature_rows, "y int, x array<double>").toPandas()
    if not len(rows):
        return Model()
    return fit(np.array(rows["x"].tolist()), rows["y"].to_numpy())


def _score_rows(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(b or b"") for b in batch.column("body").to_pylist()]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(model.score(x))], names=["row", "score"])
    return run


def scored(docs: DataFrame, model: Model, text_col: str, keep: list[str]) -> DataFrame:
    """``(row, score)`` per input row: a struct of the columns ``keep``, and the score of the whole text (null: empty)."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("body"))
    out = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(_score_rows(model), out)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5,
                   max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per input row.

    The score depends on the text alone, so repeated rows have equal scores; null and empty texts get
    the score of an empty text. Without labels of both kinds all scores are 0.5. Rows without an id are
    never held out. An empty table gives an empty result.
    """
    model = train(docs, labels, id_col, text_col, folds=folds, max_labelled=max_labelled)
    doc_id = F.col(f"row.`{id_col}`").cast("long")
    return scored(docs, model, text_col, [id_col]).select(
        doc_id.alias("doc_id"), F.coalesce(fold(doc_id, folds) == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, in their own columns, whose score reaches the threshold."""
    model = train(docs, labels, id_col, text_col, **options)
    return scored(docs, model, text_col, docs.columns).where(F.col("score") >= THRESHOLD).select("row.*")


