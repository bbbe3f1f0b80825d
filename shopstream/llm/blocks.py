"""Inverted blocks: what each block of documents holds of every distinct piece of text.

A block is a bounded run of documents of one input partition. A row of a block is a distinct piece (a
pre-token or a word) with the places it has in the block, packed into bytes; one more row, the
header, has the block's documents. Bringing the rows together with a table of pieces, and gathering what it
says by block, gives each document what it needs, while a piece takes part once a block, not once a
place: a piece that every document holds costs a row a block.

Block numbers are made of the partition, the run in the partition and the number of documents, so a
task that runs again makes the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

from shopstream.llm.common import chunks

BLOCK_BYTES = 8 << 20   # text bytes of a block
BLOCK_DOCS = 60_000     # documents of a block (their numbers fit 16 bits)
SCHEMA = "block long, piece binary, head boolean, at binary, n binary"
NAMES = ["block", "piece", "head", "at", "n"]
_DOC_BITS = 17
_RUN_BITS = 18


def block_docs(block):
    """Number of documents of a block (or of each of an array of blocks)."""
    return block & ((1 << _DOC_BITS) - 1)


class Index(dict):
    """Number of each key in the order of its first appearance."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def runs(batches: Iterator[pa.RecordBatch], pieces: Callable, block_bytes: int | None = None) -> Iterator[tuple]:
    """(block, index, numbers of all pieces, pieces of each document, ids, sizes) a block.

    ``pieces(body)`` lists the pieces of a document; documents keep their order.
    """
    block_bytes = block_bytes or BLOCK_BYTES
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    run, index, numbers, counts, ids, sizes, size = 0, Index(), [], [], [], [], 0

    def closed():
        return (part << _RUN_BITS | run) << _DOC_BITS | len(ids), index, np.concatenate(numbers), np.array(counts), ids, np.array(sizes)
    for some_ids, bodies in chunks(batches):
        got = [pieces(b) for b in bodies]
        n = [len(g) for g in got]
        numbers.append(np.fromiter((index[p] for g in got for p in g), np.uint32, sum(n)))
        counts += n
        ids += some_ids
        some_sizes = [len(b) for b in bodies]
        sizes += some_sizes
        size += sum(some_sizes)
        if size >= block_bytes or len(ids) >= BLOCK_DOCS // 2:
            yield closed()
            run, index, numbers, counts, ids, sizes, size = run + 1, Index(), [], [], [], [], 0
    if ids:
        yield closed()


def header_piece(block: int) -> bytes:
    """A key of its own for each header row: no piece is a NUL followed by digits."""
    return b"\x00%d" % block


def packed(values: np.ndarray, ends: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """Binary column out of all values in a row and where each row's end; rows that aren't valid (null) have none."""
    size = values.dtype.itemsize
    mask = None if valid is None else pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
    return pa.Array.from_buffers(pa.binary(), len(ends), [mask, pa.py_buffer(np.append(0, ends * size).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def rows(block: int, pieces: list[bytes], at: pa.Array, n: pa.Array | None, ids: list, sizes: np.ndarray) -> pa.RecordBatch:
    """Rows of a block, the header last."""
    known = np.array([i is not None for i in ids], np.int64)
    head = np.concatenate([np.array([i or 0 for i in ids], np.int64), known, sizes.astype(np.int64)]).tobytes()
    count = len(pieces)
    n = pa.nulls(count, pa.binary()) if n is None else n
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(count + 1, block)), pa.array([*pieces, header_piece(block)], pa.binary()), pa.array([False] * count + [True]),
         pa.concat_arrays([at, pa.array([head], pa.binary())]), pa.concat_arrays([n, pa.nulls(1, pa.binary())])], names=NAMES)


def header(content: bytes) -> tuple[list, np.ndarray]:
    """(ids, sizes) of a block's documents, from its header row."""
    ids, known, sizes = np.frombuffer(content, np.int64).reshape(3, -1)
    return [int(i) if k else None for i, k in zip(ids, known, strict=True)], sizes


def gathered(column, kind) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a binary column in a row, and how many each row has (nulls: none), without a loop over rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.binary())
    if not len(column):
        return np.empty(0, kind), np.empty(0, np.int64)
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(offsets, width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    values = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.empty(0, np.uint8)
    return np.frombuffer(values.tobytes(), kind), np.diff(ends) // np.dtype(kind).itemsize
