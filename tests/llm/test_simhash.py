"""SimHash near-dedup against brute force, and its defined edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash

from shopstream.llm import components, simhash
from shopstream.llm.common import cut
from tests.llm.helpers import documents, prose, union_find


def brute_fingerprint(text, words=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    tokens = [t for t in low.split(" ") if t]
    shingles = [" ".join(tokens[i:i + words]) for i in range(len(tokens) - words + 1)] if len(tokens) >= words else ([" ".join(tokens)] if tokens else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def test_fingerprints_and_components_match_brute_force(spark):
    rnd = random.Random(7)
    base = [prose(i, 60) for i in range(12)]
    texts = list(base)
    for i in range(90):
        words = base[i % 4].split()
        for _ in range(rnd.randrange(4)):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(50)}"
        texts.append(" ".join(words))
    texts += ["", None, " \t\n", "One", "one two\x0bTHREE", base[0], "É é", "é é"]
    rows = {r["id"]: (r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash.near_duplicates(documents(spark, texts)).collect()}
    fps = [brute_fingerprint(t) for t in texts]
    assert [rows[i][0] for i in range(len(texts))] == fps
    links = [(i, j) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 4]
    assert [rows[i][1] for i in range(len(texts))] == union_find(len(texts), links)


@pytest.mark.parametrize("seed", range(6))
def test_index_keeps_every_component_of_dense_and_sparse_sets(seed):
    rnd = random.Random(seed)
    fps = {rnd.getrandbits(64) for _ in range(300)}
    for _ in range(6):
        centre = rnd.getrandbits(64)
        for _ in range(rnd.choice([5, 400])):
            x = centre
            for _ in range(rnd.randrange(7)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
    fps = np.array(sorted(fps), np.uint64)
    rank = fps.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    got = []
    for k, mask in enumerate(simhash.segment_masks(4)):
        value = (fps & np.uint64(mask & (2**64 - 1))).view(np.int64)
        order = np.lexsort((rank, value))
        label = simhash.GrayIndex(np.stack([np.full(len(fps), k), value[order]], axis=1), fps[order], 4).link()
        got += [(int(order[i]), int(order[label[i]])) for i in range(len(fps))]
    near = np.argwhere(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)
    assert union_find(len(fps), got) == union_find(len(fps), near.tolist())
    assert all(bin(int(fps[a]) ^ int(fps[b])).count("1") <= 4 or union_find(len(fps), near.tolist())[a] == union_find(len(fps), near.tolist())[b] for a, b in got[:20])


def test_segment_masks_cover_all_bits_once():
    masks = [m & (2**64 - 1) for m in simhash.segment_masks(4)]
    assert sum(masks) == 2**64 - 1 and all(a & b == 0 for i, a in enumerate(masks) for b in masks[:i])


def test_edge_cases(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    docs = documents(spark, [(1, "a b c d e f"), (None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (None, "zz yy xx ww vv")])
    docs = docs.withColumn("fp", docs["doc_id"]).withColumn("id", docs["lang"]).withColumn("component_id", docs["lang"])
    rows = sorted((r["id"] or -1, r["component_id"] or -1) for r in simhash.near_duplicates(docs).collect())
    assert rows == [(-1, -1), (-1, 1), (1, 1), (5, 1), (5, 1)]
    kept = simhash.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, -1, 1]
    long = documents(spark, [prose(1, 200_000)])
    assert simhash.near_duplicates(long).first()["component_id"] == 0


def test_texts_that_share_an_id_and_rows_that_cannot_be_ordered(spark):
    """Different texts under one id both stay; rows that repeat id and text give one, also with a map among the columns."""
    docs = documents(spark, [(1, prose(1, 60)), (1, prose(2, 60)), (2, prose(3, 60)), (2, prose(3, 60)), (3, prose(3, 60)), (None, prose(3, 60))])
    docs = docs.withColumn("m", F.create_map(F.lit("a"), F.col("doc_id"))).withColumn("_row", F.lit(1)).withColumn("h", F.lit(2)).withColumn("root", F.lit(3))
    kept = simhash.one_of_each_group(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in rows) == sorted([(1, prose(1, 60)), (1, prose(2, 60)), (2, prose(3, 60)), (-1, prose(3, 60))])
    assert simhash.one_of_each_group(docs.limit(0)).count() == 0


def test_near_copies_under_one_id_are_one_document(spark):
    text = prose(4, 400)
    docs = documents(spark, [(7, text), (7, text + " "), (7, text.upper()), (9, text)])
    kept = simhash.one_of_each_group(docs).collect()
    assert [r["doc_id"] for r in kept] == [7]


def test_a_hub_s_joins_can_be_split(spark):
    """Both sides of the joins around a hub have an exchange of their own, so adaptive execution splits it."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        edges = cut(spark.range(1, n).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") - 1).alias("a"), F.col("id").alias("b")).where("a < b").repartition(8))
        last = cut(edges.select((n - F.col("b")).alias("a"), (n - F.col("a")).alias("b")))  # the hub is the largest node
        for step, graph in ((components._large_star, edges), (components._small_star, last)):
            out = step(graph)
            out.collect()
            assert "skew=true" in out._jdf.queryExecution().executedPlan().toString(), step
        roots = {r["node"]: r["root"] for r in components.connected_components(edges).collect()}
        assert len(roots) == n and set(roots.values()) == {0}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
