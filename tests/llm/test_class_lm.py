"""Class-based model: counts and base score against brute force, clustering against exhaustive moves, probabilities that sum to one."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopstream.llm import class_lm
from tests.llm.helpers import documents


def two_languages(n=240, seed=1):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        letter = rnd.choice("ab")
        out.append(" ".join(f"{letter}{min(int(rnd.expovariate(.05)), 400)}" for _ in range(rnd.randrange(1, 60))))
    return out


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [*(t for t in low.split(" ") if t), "</s>"]


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


@pytest.mark.parametrize("block", [3_000, 32 << 20])
def test_counts_and_base_score_match_brute_force_and_the_model_beats_it(spark, monkeypatch, block):
    monkeypatch.setattr(class_lm, "TASK_BYTES", block)
    monkeypatch.setattr(class_lm, "CORE", 64)
    monkeypatch.setattr(class_lm, "CLASSES", 8)
    rows = [*enumerate(two_languages()), (900, ""), (901, None), (902, "A1 a1\x0bnever-seen É é"), (None, "a1 a2 nowhere"), (0, "a1 a1")]
    got = class_lm.lm_scores(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    count = Counter(t for i, x in rows if i is not None and not is_held(i) for t in tokens(x))
    n, v = sum(count.values()), len(count)
    want = sorted((i if i is not None else -1, is_held(i), len(tokens(x)), sum(count[t] > 0 for t in tokens(x)), n) for i, x in rows)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got) == want
    base = sorted(round(sum(np.log10((count[t] + 1) / (n + v + 1)) for t in tokens(x)), 6) for _, x in rows)
    assert np.allclose(sorted(r["base_score"] for r in got), base, atol=1e-5)
    held = [r for r in got if r["held_out"]]
    assert len(held) > 20 and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert all(np.isfinite(r["score"]) and r["score"] <= 0 for r in got)


def test_bigrams_of_core_words_cover_all_training_documents(spark):
    texts = two_languages(60)
    core = [b"a1", b"b1", b"a2", class_lm.END]
    got = class_lm.core_bigrams(class_lm.text_rows(documents(spark, texts)), core, 7, 2)
    want = np.zeros((4, 4))
    for i, t in enumerate(texts):
        if not is_held(i):
            seq = [class_lm.END, *class_lm.words_of(t.encode())]
            for a, b in zip(seq, seq[1:], strict=False):
                if a in core and b in core:
                    want[core.index(a), core.index(b)] += 1
    assert (got == want).all()


def likelihood(counts, cls, k):
    onehot = np.eye(k)[cls]
    grid = onehot.T @ counts @ onehot

    def f(x):
        return (x * np.log(np.maximum(x, 1e-300))).sum()
    return f(grid) - f(grid.sum(axis=0)) - f(grid.sum(axis=1))


@pytest.mark.parametrize("seed", range(8))
def test_exchange_ends_where_no_single_move_helps(seed):
    counts = np.random.default_rng(seed).poisson(1.5, (14, 14)).astype(float)
    cls = class_lm.exchange(counts, 4, sweeps=100)
    best = likelihood(counts, cls, 4)
    assert best >= likelihood(counts, np.arange(14) % 4, 4) - 1e-9
    for w in range(14):
        for k in range(4):
            other = cls.copy()
            other[w] = k
            assert likelihood(counts, other, 4) <= best + 1e-6


@pytest.mark.parametrize("tokens", [70_000, 1 << 24])
def test_places_are_packed_and_read_back(tokens):
    places = np.array([0, 1, 65_536, 69_999])
    assert class_lm.widened(class_lm.narrowed(places, tokens), tokens).tolist() == places.tolist()


def test_probabilities_of_every_history_sum_to_one():
    rnd = np.random.default_rng(2)
    classes, discount = 5, 0.4
    counts = [rnd.integers(1, 9, rnd.integers(1, 6)) for _ in range(classes)]
    total, kinds = np.array([c.sum() for c in counts], float), np.array([len(c) for c in counts], float)
    moves = rnd.integers(0, 20, (classes + 1, classes + 1)).astype(float)
    p = 10 ** class_lm.transition_logs(moves, total, kinds, discount)
    for history in range(classes + 1):
        known = sum(p[history, k] * ((c - discount) / total[k]).sum() for k, c in enumerate(counts))
        assert abs(known + p[history, -1] - 1) < 1e-9


def test_edge_cases(spark):
    assert class_lm.lm_scores(documents(spark, [])).count() == 0
    held = next(i for i in range(100) if is_held(i))
    only = class_lm.lm_scores(documents(spark, [(held, "a b c"), (None, "a")])).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in only) == [(2, 0, 0, 0.0, 0.0), (4, 0, 0, 0.0, 0.0)]
    docs = documents(spark, [(1, "x y"), (1, "x y"), (3, "word " * 100_000)]).withColumn("c", F.lit("x")).withColumn("block", F.lit(1)).withColumn("id", F.lit("x"))
    got = class_lm.lm_scores(docs).collect()
    assert sorted(r["n_tokens"] for r in got) == [3, 3, 100_001] and len({r["score"] for r in got if r["doc_id"] == 1}) == 1


def test_every_training_word_is_moved_by_all_its_neighbours(spark, monkeypatch):
    """Two languages of rare words beside one frequent word: only neighbours outside the core tell the languages apart."""
    monkeypatch.setattr(class_lm, "CORE", 2)
    monkeypatch.setattr(class_lm, "CLASSES", 3)
    monkeypatch.setattr(class_lm, "TASK_BYTES", 2_000)
    rnd = random.Random(6)
    texts = [f"the {' '.join(rnd.choice('xy') + str(rnd.randrange(40)) for _ in range(1))} " + " ".join(f"{'pq'[k % 2]}{rnd.randrange(40)}" for k in range(20)) for _ in range(300)]
    rows = class_lm.text_rows(documents(spark, texts))
    held_rows = class_lm.stored(rows.mapInArrow(class_lm._block_rows, class_lm.blocks.SCHEMA), "test-blocks")
    start = spark.createDataFrame([(bytearray(b"the"), 0), (bytearray(class_lm.END), 1)], "piece binary, cls int")
    history = []
    got = {bytes(r["piece"]): r["cls"] for r in class_lm.clustered(held_rows, start, 7, 2, history).collect()}
    training = [[class_lm.END, *class_lm.words_of(t.encode())] for i, t in enumerate(texts) if not is_held(i)]
    assert set(got) == {w for t in training for w in t}
    grid = np.zeros((3, 3))
    for t in training:
        for a, b in zip(t, t[1:], strict=False):
            grid[got[a], got[b]] += 1
    assert len(history) > 1 and max(history) > history[0]
    assert abs(class_lm.gain_over_independence(grid) - max(history)) < 1e-6 * max(history)


@pytest.mark.parametrize("counts", [[], [1, 1, 2], [254, 255, 256, 1, 1 << 40, 255]])
def test_counts_and_planes_are_packed_and_read_back(counts):
    n = np.array(counts, np.int64)
    assert class_lm._long(class_lm._short(n), len(n)).tolist() == counts
    table = class_lm.pa.table({"n": class_lm.pa.array([class_lm._planes(n), None, class_lm._planes(n)], class_lm.pa.binary())})
    assert class_lm._from_planes(table, "n", np.int64).tolist() == counts * 2
