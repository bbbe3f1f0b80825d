"""Token alignment against plain loops over both libraries, pointer jumping, corpus counts, edge cases."""

import base64
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopstream.llm import alignment
from tests.conftest import SF001
from tests.llm.helpers import documents, prose

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sides():
    """(encode, bytes of an id) of both libraries, the first one's bytes from its file of ranks."""
    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    ranks = {int(n): base64.b64decode(t) for t, n in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    b = sentencepiece.SentencePieceProcessor(model_file=PATH_B)

    def of_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece.startswith("<0x") else piece.replace("▁", " ").encode()
    return (lambda t: a.encode(" " + t, add_special_tokens=False).ids, ranks.__getitem__), (lambda t: b.encode(t), of_b)


def brute_force(sides, texts):
    docs = []
    for text in texts:
        tokens = [encode(text or "") for encode, _ in sides]
        spelled = [[of(i) for i in ids] for ids, (_, of) in zip(tokens, sides, strict=True)]
        if not text or any(b"".join(s) != b" " + text.encode() for s in spelled):
            docs.append(([], [], [], []))
            continue
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in spelled]
        groups, links, begin = [], [], [0, 0]
        for cut in sorted(set(ends[0]) & set(ends[1])):
            at = [e.index(cut) + 1 for e in ends]
            groups.append(tuple(tokens[k][begin[k]:at[k]] for k in (0, 1)))
            links.append((tokens[0][at[0] - 1], tokens[1][at[1] - 1]))
            begin = at
        docs.append((*tokens, groups, links))
    counts = Counter(pair for d in docs for pair in d[3])
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for a, b, groups, links in docs:
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


def rows(df):
    return sorted(((r["doc_id"] if r["doc_id"] is not None else -1), *tuple(r)[1:]) for r in df.collect())


def texts():
    rnd = random.Random(8)
    parts = ["don't", "  ", "\n\n", "\t", "<|endoftext|>", "<s>", "<unk>", "<0x41>", "é", "e\u0301", "日本語", "👩‍👧", "1234567", "…", "\x85", "\u00a0", "ﬁ", "\r\n", "\x00", "internationalization"]
    out = ["".join(rnd.choice([rnd.choice(parts), f" {prose(i * 99 + k, 1)}"]) for k in range(rnd.randrange(40))) for i in range(150)]
    return [*out, "", None, " ", "   ", "a▁b", "▁", "x", "the the the", "the the the", "word " * 5000, "z" * 3000]


@pytest.mark.parametrize(("block", "remembered"), [(500, 20), (8 << 20, 1 << 18)])
def test_equals_plain_loops_over_the_libraries(spark, sides, monkeypatch, block, remembered):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    monkeypatch.setattr(alignment, "REMEMBERED", remembered)
    got = rows(alignment.align_tokens(documents(spark, texts()).repartition(3), PATH_A, PATH_B))
    assert got == [(i, *want) for i, want in enumerate(brute_force(sides, texts()))]


def test_shared_table(spark, sides):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    held = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    want = brute_force(sides, [t for _, t in held])
    assert rows(alignment.align_tokens(docs, PATH_A, PATH_B)) == [(i, *w) for (i, _), w in zip(held, want, strict=True)]


def test_pointers_reach_the_terminal_token_of_long_components():
    a, b = np.arange(2, 4001, 2), np.append(np.arange(1, 4000, 2), 4000)   # ends meet at the last byte only
    top_a, top_b = alignment.terminals(a, b)
    assert set(top_a) == set(top_b) == {len(a) - 1}
    top_a, top_b = alignment.terminals(np.array([1, 3, 4]), np.array([1, 2, 4]))
    assert top_a.tolist() == [0, 2, 2] and top_b.tolist() == [0, 2, 2]
    assert [x.tolist() for x in alignment.terminals(np.empty(0, np.int64), np.empty(0, np.int64))] == [[], []]


def test_edge_cases(spark, sides):
    assert alignment.align_tokens(documents(spark, []), PATH_A, PATH_B).count() == 0
    some = [(None, "a b"), (1, "a b c"), (1, "a b c"), (None, None)]
    docs = documents(spark, some).withColumn("block", F.lit("x")).withColumn("pair", F.lit(3)).withColumn("links", F.map_from_arrays(F.array(F.lit(1)), F.array(F.lit(2))))
    want = [(-1 if i is None else i, *w) for (i, _), w in zip(some, brute_force(sides, [t for _, t in some]), strict=True)]
    assert rows(alignment.align_tokens(docs, PATH_A, PATH_B)) == sorted(want)
    only_empty = alignment.align_tokens(documents(spark, ["", None]), PATH_A, PATH_B)
    assert rows(only_empty) == [(0, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")]
