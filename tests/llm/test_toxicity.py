"""Toxicity: automaton against edit distance, contexts, held-out accuracy, edge cases."""

import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopstream.llm import toxicity
from tests.conftest import SF01
from tests.llm.helpers import documents, prose


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


WORDS = st.text("abcé", min_size=2, max_size=7)


@settings(max_examples=400, deadline=None)
@given(st.sets(WORDS, min_size=1, max_size=12), WORDS, st.integers(1, 2))
def test_automaton_and_trie_find_the_closest_term(terms, word, errors):
    best = min((distance(word, t), t) for t in terms)
    assert toxicity.Trie(terms, errors).near(word) == ((best[1], best[0]) if best[0] <= errors else None)


def labels_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def corpus(n=500):
    rnd = random.Random(2)
    texts, labels = [], []
    for i in range(n):
        words, bad = prose(i, rnd.randrange(20, 120)).split(), rnd.random() < .25
        if bad:
            for _ in range(rnd.randrange(2, 5)):
                words.insert(rnd.randrange(len(words)), rnd.choice(["blockhead", "scoundrel", "numbskull"]))
        texts.append(" ".join(words))
        labels.append((i, 1, int(bad)))
    return texts, labels


def test_learns_terms_and_catches_misspelled_ones(spark):
    texts, labels = corpus()
    n = len(texts)
    more = ["you are a blokhead and a scoundrell w1 w2 w3 w4 w5 w6 w7 w8", "a quiet line of w1 w2 w3 w4 w5 w6 w7"]
    rows = {r["doc_id"]: r for r in toxicity.toxicity_scores(documents(spark, texts + more), labels_table(spark, labels)).collect()}
    held = [i for i in range(n) if rows[i]["held_out"]]
    assert held == [i for i in range(n) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([rows[i]["predicted"] == labels[i][2] for i in held]) > 0.95
    assert rows[n]["predicted"] == 1 and rows[n + 1]["predicted"] == 0
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= .5) for r in rows.values())


def test_quoted_terms_are_told_from_abuse():
    model = toxicity.Model(counts={"blockhead": (30, 0)}, toxic=100, clean=900, weights=toxicity.PRIOR)
    scorer = toxicity.Scorer(model)
    quoted = scorer.features('the word "blockhead" is old')
    plain = scorer.features("what a blockhead is this")
    assert quoted[1] == 0 and quoted[3] > 0 and plain[1] > 0 and plain[3] == 0
    assert scorer.score("what a blockhead you are") > scorer.score('he said "blockhead" is a word')
    assert scorer.features('a "blockhead" is a blockhead all the same, so it is no quotation at this place')[1] > 0


def test_held_out_accuracy_on_the_shared_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity_scores(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (rows["predicted"] == rows["toxic"]).mean() > 0.9


def test_edge_cases(spark):
    texts, labels = corpus(200)
    assert toxicity.toxicity_scores(documents(spark, []), labels_table(spark, labels)).count() == 0
    assert {r["score"] for r in toxicity.toxicity_scores(documents(spark, texts[:4]), labels_table(spark, [])).collect()} == {0.0}
    rows = [*enumerate(texts), (None, texts[0]), (300, None), (301, ""), (0, texts[0]), (302, "w " * 200_000), (303, '""""')]
    docs = documents(spark, rows).withColumn("score", F.lit("s")).withColumn("id", F.lit("r")).withColumn("word", F.lit(1))
    got = toxicity.toxicity_scores(docs, labels_table(spark, [*labels, (None, 1, 1), (5, 1, None), labels[3]])).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r["score"])
    assert by[0][0] == by[0][1] == by[None][0] and by[300] == by[301]
