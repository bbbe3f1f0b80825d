"""Operator 10, benchmark decontamination: size-partitioned MinHash containment search.

A short test item inside a long document has a tiny Jaccard similarity with it, so documents are cut
to the items' scale: items of ``SMALLEST`` shingles and more are partitioned by size into classes (up to ``u`` shingles, u
doubling); for each class that has items, documents are cut into windows of 2u shingles that overlap by half, each with
a MinHash signature of ``HASHES`` values; any equal value makes the pair a candidate. An item of n shingles, u/2 < n <= u,
that is contained to c meets a window that holds all its shared shingles with a chance of c * n / (2u + (1 - c) * n) a
hash. At c = 0.8 that is 0.19 at the least, a miss of 4e-5 in 48 hashes, if it is in the document's first block, which
one window only holds; elsewhere two windows hold it. Shared shingles that are scattered, each in two windows of its own, meet one
with a chance of about c * (2n / (n + 2u) - n / (n + 3u)) a hash, 0.21 at the least: a miss of 2e-5.
Shorter items have too few shingles for their windows: a document that holds an item to c lacks n - ceil(c * n) of its shingles
at the most, so it has one of any of them and one more. Documents with one of that many of the item's rarest shingles (by
the number of documents that hold them) are candidates: none is missed, and an opening that all documents share makes none.

Only window values that are in a bit map of the items' values (fixed size, broadcast) leave the task
that reads the document. Candidates are verified by exact shingle containment over whole
document and item, comparing shingle texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstream.llm.common import ALNUM, Memo, bit_filter, chunks, in_filter, mix, stored, text_rows

WORDS = 5
HASHES = 48
SMALLEST = 8       # u of the first size class, and shingles of the smallest item that is searched by windows
FILTER_BITS = 24   # 2 MB a filter
_ODD = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
_ADD = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB))


def _shingles(bodies: list[bytes], memo: Memo):
    """Words of all bodies in a row, hash of each shingle, its first word, and the document it is in."""
    words, ends = [], []
    for body in bodies:
        words += body.translate(ALNUM).split()
        ends.append(len(words))
    ends = np.array(ends)
    n = np.maximum(np.diff(np.append(0, ends)) - (WORDS - 1), 0)
    w = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    if len(w) < WORDS:
        return words, np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    h = np.zeros(len(w) - WORDS + 1, np.uint64)
    for k in range(WORDS):
        h = h * np.uint64(0xD1342543DE82EF95) + w[k:len(w) - WORDS + 1 + k]
    doc = np.repeat(np.arange(len(bodies)), n)
    begin = np.append(0, ends[:-1])
    first = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n)
    return words, mix(h[first]), first, doc


def _key(values: np.ndarray, hash_no, size: int) -> np.ndarray:
    """Signature values told apart by hash function and size class."""
    return mix(values ^ np.asarray((size << 8) + hash_no + 1, np.uint64))


def size_class(n: int) -> int:
    """Smallest u of SMALLEST, 2 * SMALLEST, ... that is not below n; 0 for items without windows."""
    if n < SMALLEST:
        return 0
    u = SMALLEST
    while u < n:
        u *= 2
    return u


def _word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, size class, key, shingle, shingle's hash): signature rows have no shingle, shingle rows no key. Class 0 has no signatures."""
    memo = Memo(_word_hash)
    for ids, bodies in chunks(batches):
        for i, body in zip(ids, bodies, strict=True):
            words, h, first, _ = _shingles([body], memo)
            if not len(h):
                continue
            h, at = np.unique(h, return_index=True)
            u = size_class(len(h))
            low = np.array([(h * _ODD[k] + _ADD[k]).min() for k in range(HASHES)], np.uint64)
            keys = _key(low, np.arange(HASHES), u).view(np.int64)[:HASHES if u else 0]
            texts = [b" ".join(words[s:s + WORDS]) for s in first[at]]
            rows = len(keys) + len(h)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * rows, pa.int64()), pa.array([u] * rows, pa.int64()),
                 pa.array([*keys.tolist(), *[None] * len(h)], pa.int64()),
                 pa.array([*[None] * len(keys), *texts], pa.binary()),
                 pa.array([*[None] * len(keys), *h.view(np.int64).tolist()], pa.int64())],
                names=["id", "size", "key", "shingle", "hash"])


def _levels(owner: np.ndarray, largest: int) -> list[tuple]:
    """Blocks of SMALLEST shingles that start anew in each document, then of two blocks each, up to the
    largest size: (shingles, first of each block in the level below, its document, whether the next is of the same)."""
    out, u, width = [], SMALLEST, SMALLEST
    while True:
        new = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        place = np.arange(len(owner)) - np.repeat(new, np.diff(np.append(new, len(owner))))
        start = np.flatnonzero(place % width == 0)
        owner = owner[start]
        out.append((u, start, owner, owner[1:] == owner[:-1]))
        if u >= largest:
            return out
        u, width = u * 2, 2


def _doc_hits(shared, sizes: list[int], bits: int):
    """Rows (id, key, shingle) of what a document shares with the items' filters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_filter, shingle_filter = (np.frombuffer(x, np.uint8) for x in shared.value)
        memo = Memo(_word_hash)
        for ids, bodies in chunks(batches):
            words, h, first, doc = _shingles(bodies, memo)
            if not len(h):
                continue
            levels = _levels(doc, max(sizes)) if sizes else []
            found_doc, found_key = [], []
            for k in range(HASHES if sizes else 0):
                low = h * _ODD[k] + _ADD[k]
                for u, start, owner, same in levels:
                    low = np.minimum.reduceat(low, start)
                    if u in sizes:
                        window = low.copy()  # a block and the next one of its document
                        np.minimum(low[:-1], low[1:], out=window[:-1], where=same)
                        key = _key(window, k, u)
                        hit = np.flatnonzero(in_filter(key_filter, key, bits))
                        found_doc.append(owner[hit])
                        found_key.append(key[hit])
            docs, keys = (np.concatenate(x) if x else np.empty(0, np.uint64) for x in (found_doc, found_key))
            pairs = np.unique(np.stack([docs.astype(np.uint64), keys], axis=1), axis=0) if len(docs) else np.empty((0, 2), np.uint64)
            hit = np.flatnonzero(in_filter(shingle_filter, h, bits))
            texts = {(int(doc[p]), b" ".join(words[first[p]:first[p] + WORDS])) for p in hit}
            out_id = [ids[d] for d in pairs[:, 0].tolist()] + [ids[d] for d, _ in texts]
            if out_id:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out_id, pa.int64()), pa.array([*pairs[:, 1].view(np.int64).tolist(), *[None] * len(texts)], pa.int64()),
                     pa.array([*[None] * len(pairs), *[t for _, t in texts]], pa.binary())], names=["id", "key", "shingle"])
    return run


def _short_candidates(held: DataFrame, shingles: DataFrame, sizes_of: DataFrame, short: DataFrame, containment: float) -> DataFrame:
    """``(id, item)`` of documents and short items by the items' rarest shingles. An item of several rows that are short ones only in
    part has any shingle of those as one to find it by."""
    documents = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("documents"))
    small = sizes_of.where(F.col("n_shingles") < SMALLEST)
    least = F.greatest(F.lit(1), F.ceil(F.lit(containment) * F.col("n_shingles") - 1e-9))
    # SMALLEST - 1 rows an item at the most
    rarest = F.row_number().over(Window.partitionBy("item").orderBy(F.coalesce("documents", F.lit(0)), "shingle"))
    index = (shingles.join(small, "item").join(documents, "shingle", "left").withColumn("place", rarest)
             .where(F.col("place") <= F.col("n_shingles") - least + 1).select("item", "shingle"))
    mixed = short.join(small, "item", "left_anti").select("item", "shingle")
    return held.join(index.union(mixed), "shingle").select("id", "item")


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_id: str = "item_id", item_text: str = "text", containment: float = 0.8,
                    filter_bits: int = FILTER_BITS) -> DataFrame:
    """Pairs ``(doc_id, item_id, n_shingles, n_shared, containment)`` of documents that contain at least
    that share of an item's distinct shingles (five words, A-Z lower-cased, split at ASCII
    characters other than letters and digits).

    Items and documents of fewer than five words, null and empty texts have no shingle and pair with nothing.
    Rows that share an id are one document (or item) with the shingles of all of them; rows without an id cannot be
    named and give no pair. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    known = stored(text_rows(items, item_id, item_text).where("id is not null").mapInArrow(
        _item_rows, "id long, size long, key long, shingle binary, hash long"), "items")
    classes = {r[0] for r in known.select("size").distinct().collect()}  # 0 or a power of two each: a few rows
    sizes = sorted(classes - {0})
    shared = spark.sparkContext.broadcast((bit_filter(known.where("key is not null").select("key"), filter_bits),
                                           bit_filter(known.where("hash is not null").select(F.col("hash").alias("key")), filter_bits)))
    rows = text_rows(docs, id_col, text_col).where("id is not null")
    hits = stored(rows.mapInArrow(_doc_hits(shared, sizes, filter_bits), "id long, key long, shingle binary"), "item-hits")
    signatures = known.where("key is not null").select(F.col("id").alias("item"), "key").distinct()
    candidates = hits.where("key is not null").select("id", "key").join(signatures, "key").select("id", "item").distinct()
    shingles = known.where("shingle is not null").select(F.col("id").alias("item"), "shingle").distinct()
    sizes_of = shingles.groupBy("item").agg(F.count(F.lit(1)).alias("n_shingles"))
    held = hits.where("shingle is not null").select("id", "shingle").distinct()
    if 0 in classes:
        short = known.where("shingle is not null and size = 0").select(F.col("id").alias("item"), "shingle").distinct()
        candidates = candidates.union(_short_candidates(held, shingles, sizes_of, short, containment)).distinct()
    shared_n = (candidates.join(held, "id").join(shingles, ["item", "shingle"])
                .groupBy("id", "item").agg(F.count(F.lit(1)).alias("n_shared")))
    return (shared_n.join(sizes_of, "item").withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
            .where(F.col("containment") >= containment)
            .select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_shingles", "n_shared", "containment"))


def without_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, in their own columns, that contain no item. Rows without an id stay."""
    bad = contained_items(docs, items, id_col, text_col, **options).select(F.col("doc_id").alias("_contaminated")).distinct()
    return docs.join(bad, docs[id_col].cast("long") == bad["_contaminated"], "left_anti")
