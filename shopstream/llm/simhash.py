"""Operator 2, SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints: 64-bit SimHash over the XXH64 (seed 42) of word shingles, repeats included.

Search for all fingerprints at most ``max_bits`` bits apart, over the distinct fingerprints:

* The top nodes of the index are masked bit patterns of ``max_bits + 1`` disjoint segments: two
  fingerprints within the distance agree in all bits of one segment at least (pigeonhole), so every link
  lies under a top node they share. The top nodes are what the cluster shuffles by; each fingerprint
  is sent ``max_bits + 1`` times, whatever the size of the input.
* Under a top node the fingerprints stand in Gray order (rank = prefix XOR of the bits), so neighbours share
  long patterns. Runs of ``FANOUT`` neighbours form a node, runs of nodes a node above; each node holds
  the bits on which all below it agree. A search adds, on the way down, the differences to the bits a
  node fixes beyond its parent's, and drops the whole group once the sum exceeds the distance.
* A group is also dropped when all of it is already in the component of the query: a ball of
  thousands of near copies costs about a pass over it, not all its pairs, and no connection is lost. Each
  task hands on one link per fingerprint (to the first of its local component), never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import binary_views, stored, text_rows
from shopstream.llm.components import connected_components, union_labels

FANOUT = 16
QUERIES = 512       # fingerprints searched at a time
FRONTIER = 1 << 20  # (query, node) pairs held at a time
SEED = 42


def shingle_hashes(body: bytes, words: int) -> np.ndarray:
    """XXH64 of each shingle; fewer words than a shingle: of the whole sequence; none: empty."""
    tokens = body.lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
    starts = np.empty_like(ends)
    starts[0] = 0
    starts[1:] = ends[:-1]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], SEED) for s, e in
                     zip(starts[: 1 - words].tolist(), (ends[words - 1:] - 1).tolist(), strict=True)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes; no hashes: zero."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].astype(">u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(shingle_hashes(b, words)) for b in binary_views(batch.column("body"))], np.uint64)
            rest = batch.drop_columns(["body"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(fps.view(np.int64))], names=[*rest.schema.names, "fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """``(id, fp)``: one row per input row, fp the 64 bits as a signed long."""
    return text_rows(docs, id_col, text_col).mapInArrow(_fingerprints(words), "id long, fp long")


def gray_rank(fp: Column) -> Column:
    """Place of a bit string in Gray order: prefix XOR of its bits."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


def segment_masks(max_bits: int) -> list[int]:
    """``max_bits + 1`` disjoint masks that cover 64 bits, as signed longs."""
    edges = [round(i * 64 / (max_bits + 1)) for i in range(max_bits + 2)]
    masks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:], strict=False)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


class GrayIndex:
    """Hierarchical index over one task's fingerprints, sorted by (top node, Gray rank)."""

    def __init__(self, top: np.ndarray, fps: np.ndarray, max_bits: int):
        self.fps, self.max_bits, n = fps, max_bits, len(fps)
        self.group = np.cumsum(np.append(False, (top[1:] != top[:-1]).any(axis=1))) if n else np.empty(0, np.int64)
        # levels[0]: leaves; each level: first child of a node, its shared bits and their pattern
        self.mask = [np.full(n, ~np.uint64(0))]
        self.pattern = [fps]
        self.first, self.leaf = [np.arange(n + 1)], [np.arange(n + 1)]
        group = self.group
        conj, disj = fps, fps
        while n:
            begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            size = np.diff(np.append(begin, len(group)))
            place = np.arange(len(group)) - np.repeat(begin, size)
            start = np.flatnonzero(place % FANOUT == 0)
            conj, disj = np.bitwise_and.reduceat(conj, start), np.bitwise_or.reduceat(disj, start)
            group = group[start]
            self.first.append(np.append(start, len(place)))
            self.leaf.append(np.append(self.leaf[-1][start], n))
            mask = ~(conj ^ disj)
            self.mask.append(mask)
            self.pattern.append(conj & mask)
            if size.max() <= FANOUT:
                break
        self.top_begin = np.searchsorted(group, np.arange(self.group[-1] + 2 if n else 0))
        self.label = np.arange(n)

    def _refresh(self) -> None:
        self.low, self.high = [self.label], [self.label]
        for first in self.first[1:]:
            self.low.append(np.minimum.reduceat(self.low[-1], first[:-1]))
            self.high.append(np.maximum.reduceat(self.high[-1], first[:-1]))

    def _search(self, queries: np.ndarray) -> None:
        """Link each query with the later fingerprints of its group within the distance."""
        top = len(self.mask) - 1
        g = self.group[queries]
        n = self.top_begin[g + 1] - self.top_begin[g]
        q, node = np.repeat(queries, n), _ranges(self.top_begin[g], n)
        stack = [(top, q, node, np.zeros(len(q), np.uint8), np.zeros(len(q), np.uint64))]
        while stack:
            level, q, node, acc, fixed = stack.pop()
            if len(q) > FRONTIER:
                cut = len(q) // 2
                stack += [(level, *(x[half] for x in (q, node, acc, fixed))) for half in (slice(cut, None), slice(cut))]
                continue
            mask = self.mask[level][node]
            acc = acc + np.bitwise_count((self.fps[q] ^ self.pattern[level][node]) & mask & ~fixed)
            own = self.label[q]
            keep = (acc <= self.max_bits) & (self.leaf[level][node + 1] - 1 > q) & ~(
                (self.low[level][node] == own) & (self.high[level][node] == own))
            q, node, acc, mask = q[keep], node[keep], acc[keep], mask[keep]
            if not len(q):
                continue
            if level == 0:
                union_labels(self.label, q, node)
                self._refresh()
                continue
            begin = self.first[level][node]
            n = self.first[level][node + 1] - begin
            stack.append((level - 1, np.repeat(q, n), _ranges(begin, n), np.repeat(acc, n), np.repeat(mask, n)))

    def link(self) -> np.ndarray:
        """For each fingerprint the index of the first one of its component in this task."""
        n = len(self.fps)
        if n > 1:
            near = np.flatnonzero((np.bitwise_count(self.fps[1:] ^ self.fps[:-1]) <= self.max_bits)
                                  & (self.group[1:] == self.group[:-1]))
            union_labels(self.label, near, near + 1)  # Gray neighbours first: they make most of a dense ball one component
            self._refresh()
            for at in range(0, n, QUERIES):
                self._search(np.arange(at, min(n, at + QUERIES)))
        return self.label


def _ranges(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """begin[0], begin[0]+1, ... n[0] numbers, then those of begin[1], and so on."""
    total = int(n.sum())
    return np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n)


def _local_links(max_bits: int):
    def links(parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        seg, value, fp = (np.concatenate([p.column(i).to_numpy() for p in parts]) for i in range(3))
        label = GrayIndex(np.stack([seg.astype(np.int64), value], axis=1), fp.view(np.uint64), max_bits).link()
        linked = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(fp[label[linked]]), pa.array(fp[linked])], names=["a", "b"]) if len(linked) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if rows >= FRONTIER:  # enough for one index: close it at the last border between top nodes
                seg, value = (np.asarray(batch.column(i)) for i in range(2))
                last = held[-1]
                other = np.flatnonzero((seg != last.column(0)[last.num_rows - 1].as_py())
                                       | (value != last.column(1)[last.num_rows - 1].as_py()))
                if len(other):
                    held.append(batch.slice(0, other[0]))
                    if (out := links(held)) is not None:
                        yield out
                    held, rows, batch = [], 0, batch.slice(other[0])
            held.append(batch)
            rows += batch.num_rows
        if held and (out := links(held)) is not None:
            yield out
    return run


def near_pairs(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp``: not every pair within ``max_bits`` bits,
    but enough of them that the connected components are the same."""
    routed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in segment_masks(max_bits)])).alias("seg", "value"))
    ordered = (routed.repartition("seg", "value").withColumn("rank", gray_rank(F.col("fp")))
               .sortWithinPartitions("seg", "value", "rank").select("seg", "value", "fp"))
    return ordered.mapInArrow(_local_links(max_bits), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                    max_bits: int = 4) -> DataFrame:
    """``(id, fp, component_id)``, one row per input row: the 64-bit fingerprint and the smallest id
    that can be reached over links of at most ``max_bits`` differing bits, the row's own included.

    A null, empty or blank text has fingerprint zero and links like any other. A text of fewer words
    than a shingle is one shingle. Repeated rows share fingerprint and component. A row without an id
    links too, but names no component; its component_id is null only if no linked row has an id. An
    empty table gives an empty result.
    """
    prints = stored(fingerprints(docs, id_col, text_col, words), "fingerprints")
    named = components(prints, max_bits)
    low = named.groupBy("root").agg(F.min("low").alias("component_id"))
    return prints.join(named.join(low, "root").select("fp", "component_id"), "fp").select("id", "fp", "component_id")


def components(prints: DataFrame, max_bits: int) -> DataFrame:
    """``(fp, low, root)`` of distinct fingerprints: the smallest id that has it, and the component it is in."""
    nodes = prints.groupBy("fp").agg(F.min("id").alias("low"))
    roots = connected_components(near_pairs(prints.select("fp").distinct(), max_bits))
    return stored(nodes.join(roots, nodes["fp"] == roots["node"], "left")
                  .select("fp", "low", F.coalesce("root", "fp").alias("root")), "components")


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                      max_bits: int = 4) -> DataFrame:
    """Of each component the document, in its own columns, with the smallest id; of several texts under that id the one with the
    smallest hash, of rows that repeat both one (by the hash of their columns, maps left out). Texts that are no near copies
    of each other both stay, also under one id. Rows without an id cannot name their group and stay. An empty table gives an
    empty result."""
    text_hash = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))
    prints = stored(text_rows(docs, id_col, text_col).withColumn("h", F.xxhash64("body"))
                    .mapInArrow(_fingerprints(words), "id long, h long, fp long"), "fingerprints")
    named = components(prints, max_bits).select("fp", "root")
    chosen = (prints.where("id is not null").join(named, "fp").groupBy("root").agg(F.min(F.struct("id", "h")).alias("k"))
              .select(F.col("k.id").alias("_keep_id"), F.col("k.h").alias("_keep_hash")).distinct())
    order = F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind])
    rows = docs.select(F.col(id_col).cast("long").alias("_keep_id"), text_hash.alias("_keep_hash"), order.alias("_order"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    kept = (rows.join(chosen, ["_keep_id", "_keep_hash"], "left_semi").groupBy("_keep_id", "_keep_hash")
            .agg(F.min_by("_row", "_order").alias("_row")))
    return kept.select("_row.*").unionByName(docs.where(F.col(id_col).isNull()))
