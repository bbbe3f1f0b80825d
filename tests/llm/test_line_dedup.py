"""Line dedup against a brute-force version, and its defined edge cases."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from shopstream.llm import line_dedup
from tests.llm.helpers import documents, prose


def key(line):
    line = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)


def brute(rows):
    held = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                held[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        rest = [x for x in lines if not (len(key(x)) >= 20 and len(held[key(x)]) >= 3 and i is not None and i != max(held[key(x)]))]
        out.append((i if i is not None else -1, len(lines), len(lines) - len(rest), hashlib.sha256("\n".join(rest).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("bits", [1 << 30, 1 << 17])
def test_matches_brute_force(spark, bits):
    rnd = random.Random(3)
    pool = [prose(i, rnd.randrange(1, 9)) for i in range(40)] + ["ÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉ", "éééééééééééééééé", "  ", ""]
    rows = []
    for i in range(120):
        lines = [rnd.choice(pool) if rnd.random() < .5 else prose(1000 * i + k, 6) for k in range(rnd.randrange(8))]
        lines = [rnd.choice(["", " ", "\t"]) + (x.upper() if rnd.random() < .3 else x) + rnd.choice(["", "\r", "\x0b"]) for x in lines]
        rows.append((i, "\n".join(lines)))
    rows += [(200, None), (201, ""), (None, pool[0] + "\n" + pool[5]), (5, pool[1])]
    got = line_dedup.dedup_lines(documents(spark, rows), max_bits=bits).select("row.doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    assert sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in got) == brute(rows)


def test_a_full_filter_makes_suspects_but_no_wrong_results(spark):
    rows = [(i, "\n".join(prose(50 * i + k, 8) for k in range(50))) for i in range(800)]
    rows += [(1000 + i, "the very same line in all of these") for i in range(5)]
    got = line_dedup.dedup_lines(documents(spark, rows), max_bits=1 << line_dedup.CHUNK_BITS).groupBy().sum("n_dropped").first()[0]
    assert got == 4


def test_edge_cases(spark):
    assert line_dedup.dedup_lines(documents(spark, [])).count() == 0
    same = "this line is in every one of the documents"
    docs = documents(spark, [(i, f"{same}\nown {i}") for i in range(4)] + [(3, same)])
    docs = docs.withColumn("kept", docs["lang"]).withColumn("row", docs["lang"]).withColumn("id", docs["lang"])
    out = line_dedup.with_lines_dropped(docs)
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    texts = sorted((r["doc_id"], r["text"], r["n_chars"], r["kept"]) for r in out.collect())
    assert texts == [(0, "own 0", 5, "en"), (1, "own 1", 5, "en"), (2, "own 2", 5, "en"), (3, same, len(same), "en"), (3, f"{same}\nown 3", len(same) + 6, "en")]


def test_merge_of_filter_pieces_counts_bits_met_twice():
    import pyarrow as pa
    pieces = pa.RecordBatch.from_arrays([pa.array([0, 0, 0]), pa.array([np.array(x, np.uint32).tobytes() for x in ([1, 2], [2, 3], [4])], pa.binary()),
                                         pa.array([np.array(x, np.uint32).tobytes() for x in ([], [], [1])], pa.binary())], names=["chunk", "once", "twice"])
    import zlib
    packed = next(line_dedup._merge(iter([pieces]))).column(1)[0].as_py()
    assert np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8))).tolist() == [1, 2]
