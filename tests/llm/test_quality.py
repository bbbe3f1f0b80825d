"""Quality classifier: ranking, threshold by quantile, held-out accuracy, edge cases."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from shopstream.llm import quality
from tests.conftest import SF01
from tests.llm.helpers import documents, prose


def labels_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def corpus(n=400):
    rnd = random.Random(1)
    texts, labels = [], []
    for i in range(n):
        good = rnd.random() < .75
        text = prose(i, rnd.randrange(1, 200))
        if not good:
            words = text.split() + ["more"] * 3
            text = rnd.choice([" | ".join(words), " ".join(w.upper() + "!!" for w in words), " ".join([words[0]] * 50), " ".join(w + "$$$" for w in words)])
        texts.append(text)
        labels.append((i, int(good), 0))
    return texts, labels


def test_separates_clean_text_from_junk_it_has_not_seen(spark):
    texts, labels = corpus()
    rows = quality.quality_scores(documents(spark, texts), labels_table(spark, labels)).collect()
    assert len(rows) == len(texts)
    truth = {i: q for i, q, _ in labels}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95


def test_held_out_accuracy_on_the_shared_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (rows["predicted"] == rows["quality"]).mean() > 0.95


def test_held_out_labels_change_nothing(spark):
    texts, labels = corpus(200)
    swapped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    a, b = (sorted(map(tuple, quality.quality_scores(documents(spark, texts), labels_table(spark, x)).collect())) for x in (labels, swapped))
    assert a == b


def test_pairs_use_every_row_of_the_rarer_label():
    a, b = quality.pairs(100, 7)
    assert len(a) == len(b) == 224 and set(b) == set(range(7)) and set(a) == set(range(100))


def test_best_quantile_is_the_one_that_agrees_with_most_labels():
    s, y = np.array([5., 1, 2, 3, 4, 4]), np.array([1, 0, 0, 1, 1, 1])
    assert quality.best_quantile(s, y) == 2 / 6
    rnd = np.random.default_rng(0)
    for _ in range(50):
        s, y = rnd.integers(0, 6, 12).astype(float), rnd.integers(0, 2, 12)
        cut = int(round(quality.best_quantile(s, y) * 12))
        order = np.argsort(s, kind="stable")
        agree = (y[order][:cut] == 0).sum() + (y[order][cut:] == 1).sum()
        assert agree == max(((s < t) & (y == 0)).sum() + ((s >= t) & (y == 1)).sum() for t in [*range(7)])


def test_edge_cases(spark):
    texts, labels = corpus(100)
    assert quality.quality_scores(documents(spark, []), labels_table(spark, labels)).count() == 0
    none = quality.quality_scores(documents(spark, texts[:5]), labels_table(spark, [])).collect()
    assert {r["score"] for r in none} == {0.5}
    one = quality.quality_scores(documents(spark, texts), labels_table(spark, [(i, 1, 0) for i in range(100)])).collect()
    assert {r["score"] for r in one} == {0.5}
    rows = [*enumerate(texts), (None, texts[0]), (200, None), (201, ""), (0, texts[0]), (202, "x" * 300_000), (203, "\x00\x01 �")]
    docs = documents(spark, rows).withColumn("score", F.lit("s")).withColumn("row", F.lit("r")).withColumn("y", F.lit("y")).withColumn("body", F.lit(1))
    dirty = labels_table(spark, [*labels, (None, 1, 1), (5, None, 0), (3, labels[3][1], 0)])
    got = quality.quality_scores(docs, dirty).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[0][0]["score"] == by[0][1]["score"] == by[None][0]["score"] and by[None][0]["held_out"] is False
    assert by[200][0]["score"] == by[201][0]["score"]
    kept = quality.accepted(docs, dirty)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["predicted"] for r in got)
