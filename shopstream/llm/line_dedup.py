"""Operator 8, line dedup: two Bloom filters, once-seen and twice-seen, over hashes of line keys.

1. Each task sets the bits of its documents' line hashes; per bit it keeps "set once" and "set
   twice or more". Pieces of the filters are merged bit by bit (twice = twice or met in two
   pieces), so the merge needs no order and only filter bits are shuffled, no lines.
2. A line whose bits are all in the twice-seen filter is a suspect. The filter has no false
   negatives, so every line found in two documents is one. Only suspects are shuffled.
3. Suspects are counted exactly by their text: documents holding the key, and the one to keep it.

Filter size: ``bits_per_line`` bits for each line of the input, at most ``max_bits`` (2^30 bits,
128 MB: the bound of what is broadcast). Beyond it more lines become suspects and take the exact
way; results never change.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.llm.common import ASCII_SPACE, binary_views, stored, text_rows

HASHES = 4
CHUNK_BITS = 17  # bits of a filter piece, as a power of two
FLUSH = 1 << 21  # positions a task gathers before it hands them on


def line_key(line: bytes) -> bytes:
    return line.strip(ASCII_SPACE).lower()  # bytes.lower changes A-Z alone


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars)


def _keys(body: bytes, min_chars: int) -> set[bytes]:
    out = set()
    for line in body.split(b"\n"):
        if len(line) >= min_chars:
            key = line_key(line)
            if _long_enough(key, min_chars):
                out.add(key)
    return out


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """HASHES bit positions of each hash (double hashing), one row a hash."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    i = np.arange(HASHES, dtype=np.uint64)
    return (hashes[:, None] + i[None, :] * step[:, None]) & np.uint64(bits - 1)


def _hash(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))


_PIECE = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("once", T.BinaryType()),
                       T.StructField("twice", T.BinaryType())])


def _fill(bits: int, min_chars: int):
    """Task side of the filters: rows (chunk, offsets set once, offsets set more often)."""
    def pieces(hashes: list[np.ndarray]) -> pa.RecordBatch:
        found, times = np.unique(_positions(np.concatenate(hashes), bits).ravel(), return_counts=True)
        chunk = (found >> np.uint64(CHUNK_BITS)).astype(np.int64)
        offset = (found & np.uint64((1 << CHUNK_BITS) - 1)).astype(np.uint32)
        names, first = np.unique(chunk, return_index=True)
        ends = np.append(first[1:], len(chunk))
        once, twice = [], []
        for s, e in zip(first, ends, strict=True):
            part, many = offset[s:e], times[s:e] > 1
            once.append(part[~many].tobytes())
            twice.append(part[many].tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array(once, pa.binary()), pa.array(twice, pa.binary())],
            names=_PIECE.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for body in binary_views(batch.column(0)):
                if keys := _keys(body, min_chars):
                    held.append(_hash(list(keys)))
                    n += len(keys) * HASHES
                if n >= FLUSH:
                    yield pieces(held)
                    held, n = [], 0
        if held:
            yield pieces(held)
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pieces of a chunk meet here, one after the other: state is two bit maps a chunk."""
    once: dict[int, np.ndarray] = {}
    twice: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, a, b in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if chunk not in once:
                once[chunk] = np.zeros(1 << CHUNK_BITS, bool)
                twice[chunk] = np.zeros(1 << CHUNK_BITS, bool)
            a, b = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
            twice[chunk][a[once[chunk][a]]] = True
            twice[chunk][b] = True
            once[chunk][a] = True
            once[chunk][b] = True
    rows = [(c, zlib.compress(np.packbits(m).tobytes(), 1)) for c, m in twice.items() if m.any()]
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in rows], pa.int64()), pa.array([z for _, z in rows], pa.binary())],
            names=["chunk", "packed"])


def twice_filter(rows: DataFrame, bits: int, min_chars: int) -> bytes:
    """The twice-seen filter as packed bits (``bits`` / 8 bytes, a bounded size)."""
    pieces = rows.select("body").mapInArrow(_fill(bits, min_chars), _PIECE)
    merged = pieces.repartition("chunk").mapInArrow(_merge, "chunk long, packed binary")
    out = np.zeros(bits >> 3, np.uint8)
    size = 1 << CHUNK_BITS >> 3
    for row in merged.toLocalIterator():
        part = np.frombuffer(zlib.decompress(bytes(row["packed"])), np.uint8)
        at = row["chunk"] * size
        out[at:at + size] = part[: len(out) - at]
    return out.tobytes()


def _suspects(shared, bits: int, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filt = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            ids, keys = [], []
            for i, body in zip(batch.column(0).to_pylist(), binary_views(batch.column(1)), strict=True):
                found = _keys(body, min_chars)
                keys += found
                ids += [i] * len(found)
            if keys:
                at = _positions(_hash(keys), bits)
                hit = ((filt[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1).all(axis=1)
                pick = np.flatnonzero(hit)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[p] for p in pick], pa.int64()), pa.array([keys[p] for p in pick], pa.binary())],
                    names=["id", "key"])
    return run


def filter_bits(n_lines: int, bits_per_line: int, max_bits: int) -> int:
    return min(max_bits, max(1 << CHUNK_BITS, 1 << max(0, n_lines * bits_per_line - 1).bit_length()))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3,
                   min_chars: int = 20, bits_per_line: int = 16, max_bits: int = 1 << 30) -> DataFrame:
    """``(id, keys)``: for each document the keys of the lines it loses. Rows without an id are no
    document that could hold or keep a line; rows that share an id are one document."""
    spark = docs.sparkSession
    rows = text_rows(docs, id_col, text_col).where("id is not null")
    lines = rows.agg(F.sum(F.length("body") - F.length(F.replace(F.col("body").cast("string"), F.lit("\n"), F.lit("")).cast("binary")) + 1)).first()[0]
    bits = filter_bits(lines or 0, bits_per_line, max_bits)
    shared = spark.sparkContext.broadcast(twice_filter(rows, bits, min_chars))
    suspects = stored(rows.mapInArrow(_suspects(shared, bits, min_chars), "id long, key binary"), "line-suspects")
    held = suspects.groupBy("key", "id").agg(F.lit(1).alias("one"))
    # stored, so that the join below has an exchange of its own on either side and a hot line is split
    repeated = stored(held.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keeper"))
                      .where(F.col("n") >= min_docs).select("key", "keeper"), "repeated-lines")
    return (suspects.join(repeated, "key").where("id <> keeper")
            .groupBy("id").agg(F.collect_set("key").alias("keys")))


def _apply(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, lines, dropped, digest = [], [], [], []
            for body, keys in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                body = body or b""
                parts, gone = body.split(b"\n"), set(keys or ())
                rest = [x for x in parts if len(x) < min_chars or line_key(x) not in gone] if gone else parts
                text = b"\n".join(rest)
                keep.append(text)
                lines.append(len(parts))
                dropped.append(len(parts) - len(rest))
                digest.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], pa.array(keep, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()),
                 pa.array(dropped, pa.int64()), pa.array(digest, pa.string())],
                names=[*batch.schema.names[2:], "kept", "n_lines", "n_dropped", "kept_sha256"])
    return run


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3,
                min_chars: int = 20, **sizes) -> DataFrame:
    """Drop lines that repeat across documents.

    Lines are split at ``\\n``; the key of a line is the line stripped of ASCII white space with A-Z
    lower-cased. Keys of at least ``min_chars`` code points found in at least ``min_docs``
    documents lose all their lines but those of the largest id holding them. A null or empty
    text is one empty line and stays empty; a row without an id keeps all its lines and counts for no key;
    rows with one id are one document. An empty table gives an empty result.

    Returns one row per input row: ``row`` (a struct of all the input columns, whatever their names),
    ``kept`` (the text that stays), ``n_lines``, ``n_dropped``, ``kept_sha256``.
    """
    gone = repeated_lines(docs, id_col, text_col, min_docs, min_chars, **sizes)
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("body"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"))
    joined = rows.join(gone, "id", "left").select("body", "keys", "row")
    out = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("kept", T.StringType()),
                        T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
                        T.StructField("kept_sha256", T.StringType())])
    return joined.mapInArrow(_apply(min_chars), out)


def with_lines_dropped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with repeated lines gone, in the columns they came with; ``n_chars``, if there,
    is counted anew."""
    out = dedup_lines(docs, id_col, text_col, **options)
    columns = []
    for c in docs.columns:
        if c == text_col:
            columns.append(F.col("kept").alias(c))
        elif c == "n_chars":
            columns.append(F.length("kept").cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(f"row.`{c}`").alias(c))
    return out.select(*columns)


__all__ = ["dedup_lines", "with_lines_dropped", "repeated_lines", "line_key", "filter_bits"]
