"""Licence scan: matching statistics and base phrases against brute force, chained spans, edge cases."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopstream.llm import licenses
from tests.conftest import SF001
from tests.llm.helpers import documents, prose


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", low) if w]


def brute_base(text, phrases):
    w = words(text)
    hits = [(i, label) for p, label in phrases.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in hits]
    return len(w), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({b for _, b in hits}))


SEQ = st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=9)


@settings(max_examples=300, deadline=None)
@given(st.lists(SEQ, min_size=1, max_size=5), st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=5))
def test_automaton_knows_every_run_and_its_places(sequences, run):
    auto = licenses.Automaton(sequences)
    want = sorted((n, i + len(run) - 1) for n, s in enumerate(sequences) for i in range(len(s) - len(run) + 1) if s[i:i + len(run)] == run)
    state = auto.find(run)
    if run:
        assert (state is not None) == bool(want)
        if want:
            assert sorted(auto.places[state]) == want


@settings(max_examples=300, deadline=None)
@given(st.lists(SEQ, min_size=1, max_size=4), st.lists(SEQ, min_size=1, max_size=3), st.lists(st.sampled_from([b"a", b"b", b"c", b"z"]), max_size=40))
def test_base_phrases_and_maximal_matches(templates, phrases, text):
    spec = {" ".join(x.decode() for x in p): f"p{i}" for i, p in enumerate(phrases)}
    scanner = licenses.Scanner(spec, {"t": [" ".join(x.decode() for x in t) for t in templates]})
    bases, runs = scanner.scan(text)
    want = sorted((i, label) for p, label in spec.items() for i in range(len(text)) if text[i:i + len(p.split())] == [x.encode() for x in p.split()])
    assert sorted(bases) == want
    every = [w for w, _ in scanner.phrases + scanner.templates]

    def inside(run):
        return any(run == s[i:i + len(run)] for s in every for i in range(len(s)))
    maximal = {(i, j) for i in range(len(text)) for j in range(i + licenses.MIN_RUN, len(text) + 1) if inside(text[i:j])
               and not (j < len(text) and inside(text[i:j + 1])) and not (i and inside(text[i - 1:j]))}
    assert {(s, e) for s, e, _ in runs} == maximal


def test_matches_brute_force_on_documents(spark):
    rnd = random.Random(4)
    lines = ["All rights reserved.", "CC-BY", "cc by cc by", "GNU General Public License, version 3", "all rights", "reserved", "general public", "license",
             "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."]
    texts = ["\n".join(rnd.choice(lines) if rnd.random() < .4 else prose(i * 50 + k, 5) for k in range(rnd.randrange(12))) for i in range(200)] + ["", None, "ALL", "é all rights reserved é"]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(t, licenses.PHRASES)
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert ("mit" in r["labels"].split(",")) == ("MIT License" in (t or ""))
        assert ("apache-2.0" in r["labels"].split(",")) == ("Apache" in (t or ""))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])


def test_chains_bridge_small_changes_and_report_spans(spark):
    full = licenses.TEMPLATES["mit"][1].split()
    edited = full[:12] + ["really"] + full[12:20] + full[22:]
    far = full[:15] + prose(1, 60).split() + full[15:]
    rows = licenses.scan_licenses(documents(spark, [" ".join(["x"] * 5 + edited + ["y"]), " ".join(far), " ".join(full[:10])])).orderBy("doc_id").collect()
    span = rows[0]["spans"][0]
    assert rows[0]["labels"] == "mit" and span["first"] == 5 and span["last"] == 4 + len(edited) and 0.9 < span["coverage"] < 1
    assert rows[1]["labels"] == rows[2]["labels"] == ""


def test_shared_tables_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for r in licenses.scan_licenses(docs).join(docs.select("doc_id", "text"), "doc_id").collect():
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(r["text"], licenses.PHRASES)


def test_edge_cases(spark):
    assert licenses.scan_licenses(documents(spark, [])).count() == 0
    docs = documents(spark, [(None, "all rights reserved"), (1, "cc by"), (1, "cc by"), (2, "general public license " * 20_000)])
    docs = docs.withColumn("labels", F.lit(1)).withColumn("id", F.lit("x")).withColumn("body", F.lit("x"))
    got = sorted((r["doc_id"] or -1, r["n_base"], r["labels"]) for r in licenses.scan_licenses(docs).collect())
    assert got == [(-1, 1, "reserved"), (1, 1, "cc-by"), (1, 1, "cc-by"), (2, 20_000, "gpl")]


def test_every_place_of_a_notice_is_reported(spark):
    notice = licenses.TEMPLATES["mit"][1].split()
    edited = notice[:12] + ["really"] + notice[12:]
    filler = prose(3, 40).split()
    places, text = [], []
    for part in (notice, filler, edited, notice, notice[:9], filler, notice):
        if part is notice or part is edited:
            places.append((len(text), len(text) + len(part) - 1))
        text += part
    row = licenses.scan_licenses(documents(spark, [" ".join(text)])).first()
    assert [(s["label"], s["first"], s["last"]) for s in row["spans"]] == [("mit", a, b) for a, b in places]


def test_short_notices_back_to_back_are_told_apart():
    scanner = licenses.Scanner({}, {"t": ["a b c d e f g"]})
    text = " ".join(["a b c x e f g"] * 50)
    spans = scanner.result(text.encode())["spans"]
    assert [(s["first"], s["last"]) for s in spans] == [(7 * i, 7 * i + 6) for i in range(50)]
