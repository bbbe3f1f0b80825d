"""Benchmark decontamination against exact containment by brute force, and edge cases."""

import random
import re

from pyspark.sql import functions as F

from shopstream.llm import decontaminate
from tests.llm.helpers import documents, prose


def shingles(texts):
    out = set()
    for t in texts:
        w = [x for x in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        out |= {" ".join(w[i:i + 5]) for i in range(len(w) - 4)}
    return out


def brute(docs, items, share=0.8):
    ds, bs = {i: shingles([t]) for i, t in docs}, {i: shingles([t]) for i, t in items}
    return sorted((d, b, len(y), len(x & y)) for d, x in ds.items() for b, y in bs.items() if y and len(x & y) / len(y) >= share)


def items_table(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_matches_brute_force_for_short_long_scattered_and_edited_passages(spark):
    rnd = random.Random(5)
    items = [(i, prose(i, rnd.randrange(5, 160), 5000)) for i in range(60)]
    docs = []
    for d in range(150):
        words = prose(1000 + d, rnd.choice([0, 3, 40, 400, 4000]), 5000).split()
        for _ in range(rnd.randrange(3)):
            passage = rnd.choice(items)[1].split()
            for _ in range(rnd.randrange(3)):
                passage[rnd.randrange(len(passage))] = "changed"
            if rnd.random() < .4:  # in two pieces, far apart
                half = len(passage) // 2
                words[0:0] = passage[:half + 2]
                passage = passage[half - 2:]
            at = rnd.randrange(len(words) + 1)
            words[at:at] = [p.upper() + "," for p in passage]
        docs.append((d, " ".join(words)))
    got = decontaminate.contained_items(documents(spark, docs), items_table(spark, items)).collect()
    want = brute(docs, items)
    assert len(want) > 40
    assert sorted(r[:4] for r in map(tuple, got)) == want
    assert all(abs(r["containment"] - r["n_shared"] / r["n_shingles"]) < 1e-12 for r in got)


def test_edge_cases(spark):
    items = [(1, "a b c d e f g"), (2, "short one"), (3, None), (None, "p q r s t u"), (4, "a b c d e f g"), (1, "a b c d e f g")]
    empty = documents(spark, [])
    assert decontaminate.contained_items(empty, items_table(spark, items)).count() == 0
    assert decontaminate.contained_items(documents(spark, ["a b c d e f g"]), items_table(spark, [])).count() == 0
    docs = documents(spark, [(7, "x a b c d e f g x"), (8, "a b c d"), (8, None), (9, ""), (None, "a b c d e f g"), (10, "short one"), (7, "a b c"), (11, "P Q R S T U")])
    docs = docs.withColumn("item_id", F.lit(1)).withColumn("id", F.lit("x")).withColumn("shingle", F.lit("x"))
    got = sorted(tuple(r)[:4] for r in decontaminate.contained_items(docs, items_table(spark, items)).collect())
    assert got == [(7, 1, 3, 3), (7, 4, 3, 3)]
    kept = decontaminate.without_contaminated(docs, items_table(spark, items))
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 8, 8, 9, 10, 11]


def test_a_full_filter_changes_nothing(spark):
    items = [(i, prose(i, 20, 50)) for i in range(30)]
    docs = [(i, prose(100 + i, 50, 50) + " " + (items[i % 30][1] if i % 3 else "")) for i in range(40)]
    got = decontaminate.contained_items(documents(spark, docs), items_table(spark, items), filter_bits=4).collect()
    assert sorted(tuple(r)[:4] for r in got) == brute(docs, items)


def test_no_item_of_a_few_shingles_is_missed(spark):
    """Items of one to eight shingles, copied into the first block and the middle of long documents."""
    items = [(i, prose(i, 5 if i < 500 else 5 + i % 8, 9000)) for i in range(800)]
    docs = []
    for i, text in items:
        words = prose(5000 + i, 120, 9000).split()
        at = 3 if i % 2 else 60
        docs.append((i, " ".join([*words[:at], text, *words[at:]])))
    got = decontaminate.contained_items(documents(spark, docs), items_table(spark, items)).collect()
    assert sorted(tuple(r)[:4] for r in got) == brute(docs, items)
    only_short = decontaminate.contained_items(documents(spark, docs), items_table(spark, items[:500])).collect()
    assert sorted(tuple(r)[:4] for r in only_short) == brute(docs, items[:500])


def test_a_shared_opening_makes_no_candidates(spark):
    """Short items and documents that open alike: candidates come from the shingles that tell the items apart."""
    opening = "which of the following is the"
    items = [(i, f"{opening} {prose(i, 3 + i % 3, 9000)}") for i in range(120)]
    docs = [(d, f"{opening} {prose(3000 + d, 40, 9000)}" + (f" {items[d][1]}" if d < 60 else "")) for d in range(300)]
    held = spark.createDataFrame([(i, s.encode()) for i, t in docs for s in shingles([t])], "id long, shingle binary")
    index = spark.createDataFrame([(i, s.encode()) for i, t in items for s in shingles([t])], "item long, shingle binary")
    sizes = index.groupBy("item").agg(F.count(F.lit(1)).alias("n_shingles"))
    found = {tuple(r) for r in decontaminate._short_candidates(held, index, sizes, index, 0.8).collect()}
    assert len(found) < 200 < 300 * 120
    want = brute(docs, items)
    assert {w[:2] for w in want} <= found
    got = decontaminate.contained_items(documents(spark, docs), items_table(spark, items)).collect()
    assert len(want) >= 60 and sorted(tuple(r)[:4] for r in got) == want


def test_an_item_of_short_and_long_rows(spark):
    items = [(1, "a b c d e f"), (1, " ".join(f"w{i}" for i in range(6))), (1, " ".join(f"x{i}" for i in range(14))), (2, "p q r s t")]
    docs = [(i, " ".join(t for _, t in some)) for i, some in enumerate([items[:3], items[:2], items[1:3], items])]
    got = decontaminate.contained_items(documents(spark, docs), items_table(spark, items), containment=0.5).collect()
    ds, bs = {i: shingles([t]) for i, t in docs}, {k: shingles([t for i, t in items if i == k]) for k in (1, 2)}
    want = sorted((d, b, len(y), len(x & y)) for d, x in ds.items() for b, y in bs.items() if len(x & y) / len(y) >= 0.5)
    assert sorted(tuple(r)[:4] for r in got) == want
