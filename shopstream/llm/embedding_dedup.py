"""Operator 9, embedding near-dedup: collision-counting projections.

1. Equal vectors of a label become one node with the number of its rows. Unit vectors are projected onto
   ``PROJECTIONS`` random lines.
2. The vectors of a label are sorted by the first projection and cut into blocks. Two vectors at the threshold
   differ by a normal variate of known width on every line, so only blocks within the first line's window (recall
   1 - 6e-7) are compared; each pair of blocks is a task, so a hot label is spread over many.
3. In a pair of blocks, every vector opens a window around its own projection on each line; the lines on which another
   vector falls into it are counted per pair. Pairs with at least the calibrated count are candidates: the largest count that a
   pair at the threshold reaches with probability ``1 - MISS`` (binomial, lines are independent).
4. Candidates are verified by cosine in double precision. A task hands on the number of links of each vector and one link to the
   first of its local component, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import Memo, stored
from shopstream.llm.components import connected_components, union_labels

PROJECTIONS = 32
WINDOW = 2.0      # half width of a window, in standard deviations of a pair at the threshold
FIRST_WINDOW = 5.0
MISS = 1e-6
BLOCK_ROWS = 2048
STRIP = 256       # queries compared at a time
SEED = 9


def deviation(threshold: float) -> float:
    """Standard deviation on a random line of the difference of two unit vectors at that cosine."""
    return sqrt(max(0.0, 2 - 2 * threshold))


def calibrated_count(lines: int, window: float, miss: float) -> int:
    """The largest count that a pair at the threshold reaches with probability ``1 - miss`` at least."""
    p = erf(window / sqrt(2))
    below = 0.0
    for k in range(lines + 1):
        below += comb(lines, k) * p**k * (1 - p) ** (lines - k)
        if below > miss:
            return k
    return lines


def random_lines(dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, PROJECTIONS))


def _unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, label, many, v) -> (node, label, many, dim, first, unit, lines) with unit vectors and projections as bytes."""
    known = Memo(random_lines)
    for batch in batches:
        dims, first, units, lines = [], [], [], []
        for v in batch.column("v").to_pylist():
            x = np.array(v, np.float64)
            x /= np.abs(x).max()  # no overflow in the norm
            x /= np.sqrt(x @ x)
            at = x @ known[len(x)]
            dims.append(len(x))
            first.append(float(at[0]))
            units.append(x.tobytes())
            lines.append(at.tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), batch.column("label"), batch.column("many"), pa.array(dims, pa.int32()), pa.array(first, pa.float64()),
             pa.array(units, pa.binary()), pa.array(lines, pa.binary())], names=["node", "label", "many", "dim", "first", "unit", "lines"])


_BLOCK = "label string, dim int, block long, low double, high double, nodes binary, many binary, unit binary, lines binary"


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted vectors -> a row for each run of at most BLOCK_ROWS vectors of one label and dimension."""
    held, key = [], None

    def block():
        node, many, first, unit, lines = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]], pa.string()), pa.array([key[1]], pa.int32()), pa.array([node[0]], pa.int64()), pa.array([first[0]]), pa.array([first[-1]]),
             pa.array([np.array(node, np.int64).tobytes()], pa.binary()), pa.array([np.array(many, np.int64).tobytes()], pa.binary()),
             pa.array([b"".join(unit)], pa.binary()), pa.array([b"".join(lines)], pa.binary())],
            names=["label", "dim", "block", "low", "high", "nodes", "many", "unit", "lines"])
    for batch in batches:
        for label, dim, *row in zip(*(batch.column(c).to_pylist() for c in ("label", "dim", "node", "many", "first", "unit", "lines")), strict=True):
            if held and (key != (label, dim) or len(held) >= BLOCK_ROWS):
                yield block()
                held = []
            key = (label, dim)
            held.append(row)
    if held:
        yield block()


def candidates(a: np.ndarray, b: np.ndarray, width: float, count: int) -> np.ndarray:
    """Which pairs (row of a, row of b) collide in the windows of at least ``count`` lines."""
    hits = np.zeros((len(a), len(b)), np.uint8)
    for k in range(a.shape[1]):
        hits += np.abs(a[:, k, None] - b[None, :, k]) <= width
    return hits >= count


def near_pairs(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float, dense: bool) -> np.ndarray:
    """Which candidates (a[i], b[j]) have a cosine of the threshold or more. Many candidates take a matrix product, but next to
    the threshold the sum by rows decides, so that a link doesn't depend on who else is a candidate."""
    out = np.zeros(len(i), bool)
    rest = np.arange(len(i))
    if dense:
        cosine = (a @ b.T)[i, j]
        out = cosine >= threshold
        rest = np.flatnonzero(np.abs(cosine - threshold) < 1e-9)
    for at in range(0, len(rest), 65536):
        some = rest[at:at + 65536]
        out[some] = np.einsum("ij,ij->i", a[i[some]], b[j[some]]) >= threshold
    return out


def _compare(threshold: float, count: int):
    """The one or two blocks of a pair -> (node, links, root)."""
    width = WINDOW * deviation(threshold) * (1 + 1e-9)

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["side"])
        node, many, unit, lines = [], [], [], []
        for r in rows:
            n = len(r["nodes"]) // 8
            node.append(np.frombuffer(r["nodes"], np.int64))
            many.append(np.frombuffer(r["many"], np.int64))
            unit.append(np.frombuffer(r["unit"], np.float64).reshape(n, -1))
            lines.append(np.frombuffer(r["lines"], np.float64).reshape(n, -1).astype(np.float32))
        own = len(rows) == 1
        a, b = 0, len(rows) - 1
        start = 0 if own else len(node[0])  # of the second block's vectors in the joint numbering
        nodes, weight = (node[0], many[0]) if own else (np.concatenate(node), np.concatenate(many))
        links, label = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
        for at in range(0, len(node[a]), STRIP):
            strip = slice(at, at + STRIP)
            found = candidates(lines[a][strip], lines[b], width + 1e-5, count)
            i, j = np.nonzero(found)
            if own:
                i, j = i[j > i + at], j[j > i + at]
            if not len(i):
                continue
            near = near_pairs(unit[a][strip], unit[b], i, j, threshold, dense=len(i) * 16 > found.size)
            i, j = i[near] + at, j[near] + start
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            union_labels(label, i, j)
        some = np.flatnonzero(links)
        return pa.table({"node": nodes[some], "links": links[some], "root": nodes[label[some]]})
    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 threshold: float = 0.93) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row.

    Vectors of equal, non-null labels and equal length link at a cosine of ``threshold`` or more, in double precision. Null and empty
    vectors, zero vectors and those with null or non-finite components link with nothing, nor do rows without a
    label: no links, their own component, kept. Rows that repeat a vector are links of each other, also where they repeat the id. A row
    without an id links and counts, but names no component. An empty table gives an empty result.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    sound = (F.col("label").isNotNull() & F.col("v").isNotNull()
             & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0))
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    hashed = rows.where("sound").withColumn("h", F.xxhash64("label", "v"))
    nodes = stored(hashed.groupBy("h", "label", "v").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("many"))
                   .withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    n = nodes.count()
    units = nodes.select("node", "label", "many", "v").mapInArrow(
        _unit_rows, "node long, label string, many long, dim int, first double, unit binary, lines binary")
    cut = (stored(units, "vector-units").repartitionByRange(max(1, -(-n // BLOCK_ROWS)), "label", "dim", "first")
           .sortWithinPartitions("label", "dim", "first"))
    blocks = stored(cut.mapInArrow(_block_rows, _BLOCK), "vector-blocks")

    count = calibrated_count(PROJECTIONS, WINDOW, MISS)
    a = blocks.select("label", "dim", F.col("block").alias("a"), "low", "high")
    b = blocks.select("label", "dim", F.col("block").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"))
    within = FIRST_WINDOW * deviation(threshold)
    pairs = stored(a.join(b, ["label", "dim"]).where(  # each pair of blocks once, in their order
        ((F.col("low") < F.col("low_b")) | ((F.col("low") == F.col("low_b")) & (F.col("a") <= F.col("b")))) & (F.col("low_b") - F.col("high") <= within))
        .select("a", "b"), "block-pairs")
    content = blocks.select("block", "nodes", "many", "unit", "lines")
    sides = pairs.select("a", "b", F.col("a").alias("block"), F.lit(0).alias("side")).unionByName(
        pairs.where("a <> b").select("a", "b", F.col("b").alias("block"), F.lit(1).alias("side")))
    found = stored(sides.join(content, "block").groupBy("a", "b").applyInArrow(
        _compare(threshold, count), "node long, links long, root long"), "vector-links")

    roots = connected_components(found.select(F.col("root").alias("a"), F.col("node").alias("b")))
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = stored(nodes.select("node", "h", "label", "v", "low", "many").join(linked, "node", "left").join(roots, "node", "left")
                   .select("h", "label", "v", "low", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"),
                           F.coalesce("root", "node").alias("root")), "vector-components")
    low = named.groupBy("root").agg(F.min("low").alias("component_id"))
    known = named.join(low, "root").select("h", "label", "v", "n_links", "component_id")
    out = hashed.join(known, ["h", "label", "v"]).select(F.col("id"), "n_links", "component_id")
    alone = rows.where("not sound").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return out.unionByName(alone).select(F.col("id").alias("vec_id"), "n_links", "component_id",
                                         F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))
