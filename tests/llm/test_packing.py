"""Packing: optimal boundaries against brute force, batches against the budget, edge cases."""

import itertools
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopstream.llm import packing
from tests.llm.helpers import documents, prose


def padding(lengths, bounds):
    return sum(min(b for b in bounds if b >= n) - n for n in lengths)


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=25), st.integers(1, 5))
def test_boundaries_have_the_least_padding(lengths, buckets):
    distinct = sorted(set(lengths))
    counts = [lengths.count(n) for n in distinct]
    got = packing.optimal_boundaries(distinct, counts, [n * c for n, c in zip(distinct, counts, strict=True)], buckets)
    assert got == sorted(got) and len(got) <= buckets and got[-1] == max(lengths)
    best = min(padding(lengths, [*c, distinct[-1]]) for k in range(min(buckets, len(distinct)))
               for c in itertools.combinations(distinct[:-1], k))
    assert padding(lengths, got) == best


def test_no_lengths_no_boundaries():
    assert packing.optimal_boundaries([], [], [], 4) == []


def check(rows, budget):
    batches = defaultdict(list)
    for r in rows:
        assert r["n_tokens"] <= r["padded_to"]
        batches[r["batch_id"]].append(r)
    buckets = defaultdict(list)
    for b, group in batches.items():
        assert len({r["bucket"] for r in group}) == 1
        assert sorted(r["slot"] for r in group) == list(range(len(group)))
        size = max(1, budget // max(1, group[0]["padded_to"]))
        assert len(group) <= size
        buckets[group[0]["bucket"]].append((b, len(group), size))
    assert sorted(batches) == list(range(len(batches)))
    for group in buckets.values():
        assert all(n == size for _, n, size in sorted(group)[:-1])  # all but the last are full


@pytest.mark.parametrize("slice_rows", [7, 100_000])
def test_batches_fill_the_budget_whatever_the_slices(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(packing, "SLICE_ROWS", slice_rows)
    texts = [prose(i, 1 + i * i % 90) for i in range(150)] + [prose(9, 30)] * 60 + ["", None, "one", prose(3, 3000)]
    docs = documents(spark, texts)
    rows = packing.pack(docs, packing.word_count(F.col("text")), buckets=5, budget=200).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {i: len((t or "").split()) for i, t in enumerate(texts)}
    bounds = sorted({r["padded_to"] for r in rows})
    lengths = [len((t or "").split()) for t in texts]
    distinct = sorted(set(lengths))
    assert bounds == packing.optimal_boundaries(distinct, [lengths.count(n) for n in distinct], [n * lengths.count(n) for n in distinct], 5)
    check(rows, 200)


def test_edge_cases(spark):
    count = packing.word_count(F.col("text"))
    assert packing.pack(documents(spark, []), count).count() == 0
    docs = documents(spark, [(None, "a b"), (1, "a b c"), (1, "a b c"), (None, None)]).withColumn("bucket", F.lit("x")).withColumn("slice", F.lit("y"))
    rows = packing.pack(docs, count, buckets=2, budget=6).collect()
    assert len(rows) == 4
    check(rows, 6)


def test_long_lengths_share_bins_but_keep_their_largest(spark):
    lengths = spark.range(4090, 200_000).select(F.col("id").alias("n"), packing.length_bin(F.col("id")).alias("bin"))
    row = lengths.agg(F.min(F.col("bin") - F.col("n")), F.max((F.col("bin") - F.col("n")) / F.col("n")), F.countDistinct("bin")).first()
    assert row[0] >= 0 and row[1] < 0.001 and row[2] < 7000


def test_a_third_of_all_rows_under_one_id_is_dealt_over_slices(spark, monkeypatch):
    """The rows of a null or repeated id do not meet in one window."""
    monkeypatch.setattr(packing, "SLICE_ROWS", 50)
    docs = spark.range(900).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("a b").alias("text"))
    packed = packing.pack(docs, packing.word_count(F.col("text")), buckets=1, budget=40)
    check(packed.collect(), 40)
    assert packed.where("doc_id is null").count() == 300
    # rows of the null id in its fullest slice: the windows' partitions are by bucket and slice
    dealt = packed._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(doc_id" in dealt and any("xxhash64(doc_id" in line and "row#" in line.split("xxhash64(")[1] for line in dealt.splitlines())
