"""Token counts against the library itself, pre-token classes over all code points, edge cases."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopstream.llm import blocks, token_counts
from tests.conftest import SF001
from tests.llm.helpers import documents, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_pre_tokens_are_the_library_s_for_every_code_point(library):
    cutter = token_counts.Cutter(open(PATH, encoding="utf-8").read())
    bad = []
    for c in [*range(0x3000), *(x for x in range(0x3000, 0x110000, 7) if not 0xD800 <= x < 0xE000), 0x2209D, 0x1E6C0, 0x10940]:
        text = f"a{chr(c)}1 {chr(c)}! {chr(c)} \n{chr(c)}'ll"
        if cutter.pre_tokens(text) != [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]:
            bad.append(c)
    assert not [c for c in bad if not 0xD800 <= c < 0xE000]


def texts():
    rnd = random.Random(6)
    parts = ["don't", "we'll", "  ", "\n\n", "\t", "<|endoftext|>", "<|end", "oftext|>", "é", "日本語", "👩‍👧", "123", "a1b2", "…", "\x85", "​", " ", "'S", "\r\n", "\x00", "\x001"]
    return ["".join(rnd.choice([rnd.choice(parts), f" {prose(i * 99 + k, 1)}"]) for k in range(rnd.randrange(60))) for i in range(250)]


@pytest.mark.parametrize(("block", "sums"), [(2_000, 1 << 24), (2_000, 3), (32 << 20, 1 << 24)])
def test_counts_are_the_library_s(spark, library, monkeypatch, block, sums):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", block)
    monkeypatch.setattr(token_counts, "MAX_SUMS", sums)
    rows = [*texts(), "", None, "<|endoftext|><|endoftext|>", " ", "word " * 30_000, "x" * 5000]
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in token_counts.count_tokens(documents(spark, rows), PATH).collect()}
    assert got == {i: (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(rows)}


def test_packed_columns_are_read_back_without_loops():
    values, ends = np.array([1, 2, 3, 70_000], np.uint32), np.array([2, 2, 2, 4])
    column = blocks.packed(values, ends, np.array([True, False, True, True]))
    assert column.null_count == 1
    for cut in (column, pa.concat_arrays([pa.array([b"\x09\x00\x00\x00"]), column]).slice(1), pa.chunked_array([column.slice(0, 1), column.slice(1)])):
        got, many = blocks.gathered(cut, np.uint32)
        assert got.tolist() == values.tolist() and many.tolist() == [2, 0, 0, 2]
    assert blocks.gathered(pa.chunked_array([], pa.binary()), np.uint16)[0].tolist() == []


def test_shared_tables(spark, library):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for r in token_counts.count_tokens(docs, PATH).join(docs.select("doc_id", "text"), "doc_id").collect():
        assert r["n_tokens"] == len(library.encode(r["text"], add_special_tokens=False).ids)


def test_edge_cases(spark, library):
    assert token_counts.count_tokens(documents(spark, []), PATH).count() == 0
    docs = documents(spark, [(None, "a b"), (1, "a b c"), (1, "a b c"), (None, None)]).withColumn("piece", F.lit("x")).withColumn("n_tokens", F.lit(3))
    got = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in token_counts.count_tokens(docs, PATH).collect())
    assert got == [(-1, 0, 0), (-1, 3, 2), (1, 5, 3), (1, 5, 3)]
    with pytest.raises(ValueError):
        token_counts.Cutter(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())


def test_rows_of_a_hot_pre_token_are_dealt_over_tasks(spark):
    rows = spark.range(64).selectExpr("id AS block", "cast(' the' AS binary) AS piece", "false AS head", "cast(repeat('x', 4000) AS binary) AS at", "cast('' AS binary) AS n")
    rare = rows.selectExpr("block", "cast('rare' AS binary)", "head", "cast('xx' AS binary)", "n")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = token_counts._together(rows.union(rare)).select("piece", F.spark_partition_id().alias("task")).groupBy("piece", "task").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = [r["count"] for r in tasks if r["piece"] == b" the"]
    assert len(hot) >= 6 and max(hot) < 32 and [r["count"] for r in tasks if r["piece"] == b"rare"] == [64]
