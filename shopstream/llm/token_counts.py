"""Operator 7, token counts: pieces counted once per distinct pre-token, joined to per-document frequencies.

1. Texts are cut at the tokenizer's special strings and into pre-tokens. Blocks of documents (see ``blocks``) hold for
   every distinct pre-token the documents it is in and how often.
2. The blocks' rows are brought together and sorted by pre-token (the shuffle and sort of a sort-merge join): the library
   encodes every distinct pre-token of the corpus once, and its number of tokens is joined to the frequencies. Rows of a pre-token
   that many documents of a block hold go to tasks by block, too: a hot pre-token is split, and encoded once in each.
3. Each task sums per document what it has joined before it hands it on, and the sums are gathered by block. No token
   ids of any document are ever made, and the text is read once.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm import blocks
from shopstream.llm.common import Memo, text_rows

HOT_BYTES = 512     # places of a pre-token in a block from which on its rows are dealt by block
MAX_SUMS = 1 << 24  # documents that a task holds sums of before it hands them on

#: fixed value: the byte-level pre-tokenizer's pattern
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Cutter:
    """Cuts a text into what the tokenizer encodes on its own: pre-tokens and special strings."""

    def __init__(self, tokenizer_json: str):
        self.source = tokenizer_json
        spec = json.loads(tokenizer_json)
        pre = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space"):
            raise ValueError("only byte-level tokenizers without a normalizer or prefix space are supported")
        special = [t["content"] for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("special strings that reach beyond themselves are not supported")
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.find = regex.compile(PATTERN).findall
        # code points that newer Unicode tables than the library's may class otherwise
        self.unassigned = Memo(lambda c: unicodedata.category(c) == "Cn")

    @cached_property
    def library(self):
        """The tokenizer itself, loaded where it is needed; a task has one core, so it starts no threads."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.source)

    def pre_tokens(self, text: str) -> list[str]:
        if not text.isascii() and any(self.unassigned[c] for c in set(text)):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return self.find(text)

    def pieces(self, text: str) -> list[str]:
        if self.special is None:
            return self.pre_tokens(text)
        out = []
        for i, part in enumerate(self.special.split(text)):
            if i % 2:
                out.append(part)
            elif part:
                out += self.pre_tokens(part)
        return out


def _block_rows(shared):
    """Rows of each block: a distinct pre-token, the documents that hold it, and how often (null: once each)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(shared.value)
        for block, index, numbers, counts, ids, sizes in blocks.runs(batches, lambda b: cutter.pieces(b.decode("utf-8", "replace"))):
            pairs = numbers.astype(np.uint64) << np.uint64(32)
            pairs |= np.repeat(np.arange(len(ids), dtype=np.uint32), counts)
            pairs.sort()
            first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])) if len(pairs) else np.empty(0, np.int64)
            times = np.diff(np.append(first, len(pairs)))
            pairs = pairs[first]
            ends = np.searchsorted(pairs >> np.uint64(32), np.arange(len(index)), side="right")
            at = blocks.packed((pairs & np.uint64(0xFFFFFFFF)).astype(np.uint16), ends)
            # how often is only kept for pre-tokens that a document holds more than once
            many = np.diff(np.append(0, ends))
            several = np.maximum.reduceat(times, np.append(0, ends[:-1])) > 1 if len(ends) else np.empty(0, bool)
            n = blocks.packed(times[np.repeat(several, many)].astype(np.uint32), np.cumsum(many * several), several)
            yield blocks.rows(block, [p.encode() for p in index], at, n, ids, sizes)
    return run


class _Sums:
    """Sums of the documents of many blocks, in one array."""

    def __init__(self):
        self.first: dict[int, int] = {}
        self.used, self.total = 0, np.zeros(1 << 16, np.int64)

    def add(self, block: np.ndarray, at: np.ndarray, many: np.ndarray, values: np.ndarray) -> None:
        """``at[i]``: the document in its block; ``many``: pairs of each row."""
        names, which = np.unique(block, return_inverse=True)
        for b in names.tolist():
            if b not in self.first:
                self.first[b] = self.used
                self.used += int(blocks.block_docs(b))
        if self.used > len(self.total):
            self.total = np.append(self.total, np.zeros(max(self.used, len(self.total)), np.int64))
        first = np.array([self.first[b] for b in names.tolist()], np.int64)
        np.add.at(self.total, np.repeat(first[which], many) + at, values)

    def rows(self) -> Iterator[pa.RecordBatch]:
        """Rows (block, head, at, n): the documents with a sum, and the sums."""
        for block, first in self.first.items():
            part = self.total[first:first + int(blocks.block_docs(block))]
            at = np.flatnonzero(part)
            yield _partial([block], [False], [at.astype(np.uint16).tobytes()], [part[at].astype(np.uint32).tobytes()])


def _partial(block: list, head: list, at: list, n: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(head), pa.array(at, pa.binary()), pa.array(n, pa.binary())], names=["block", "head", "at", "n"])


def _joined_rows(shared):
    """Rows sorted by pre-token: the library encodes each once, and its number of tokens is joined to all its rows in this task. What is handed on are partial sums of the documents, by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Cutter(shared.value).library.encode_batch
        sums, last, last_tokens = _Sums(), None, 0
        for batch in batches:
            head = np.asarray(batch.column("head"))
            if head.any():
                yield batch.filter(pa.array(head)).select(["block", "head", "at", "n"])
                batch = batch.filter(pa.array(~head))
            pieces = batch.column("piece").to_pylist()
            if not pieces:
                continue
            first = [i for i, p in enumerate(pieces) if i == 0 or p != pieces[i - 1]]
            known = pieces[0] == last
            fresh = first[1:] if known else first
            tokens = [len(e.ids) for e in encode([pieces[i].decode() for i in fresh], add_special_tokens=False)]
            tokens = [last_tokens, *tokens] if known else tokens
            last, last_tokens = pieces[-1], tokens[-1]
            of_row = np.repeat(np.array(tokens, np.int64), np.diff([*first, len(pieces)]))
            at, many = blocks.gathered(batch.column("at"), np.uint16)
            several, rows_with = blocks.gathered(batch.column("n"), np.uint32)
            n = np.ones(len(at), np.int64)
            n[np.repeat(rows_with > 0, many)] = several
            sums.add(batch.column("block").to_numpy(), at, many, np.repeat(of_row, many) * n)
            if sums.used > MAX_SUMS:
                yield from sums.rows()
                sums = _Sums()
        yield from sums.rows()
    return run


def _together(rows: DataFrame) -> DataFrame:
    """All rows of a pre-token in one task, sorted; rows of more than HOT_BYTES spread over all tasks."""
    return rows.repartition("piece", F.when(F.length("at") > HOT_BYTES, F.col("block"))).sortWithinPartitions("piece")


def _sums(table: pa.Table) -> pa.Table:
    """All partial sums of a block -> its documents. A block is bounded; each task has a row of it."""
    is_head = table.column("head").to_pylist()
    ids, sizes = blocks.header(table.column("at")[is_head.index(True)].as_py())
    parts = table.filter(pa.array([not h for h in is_head]))
    at, _ = blocks.gathered(parts.column("at"), np.uint16)
    n, _ = blocks.gathered(parts.column("n"), np.uint32)
    total = np.bincount(at, weights=n, minlength=len(ids)).astype(np.int64)
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_bytes": sizes, "n_tokens": total})


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` per input row, as the library's ``encode`` without added tokens.

    ``tokenizer_path``: a byte-level ``.json`` on the driver, sent to the tasks (a file of a few MB). A null or empty text has no
    bytes and no tokens; special strings in a text are one token each, as by the library's default. Repeated rows and rows
    without an id are counted each. An empty table gives an empty result.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = text_rows(docs, id_col, text_col)
    held = _together(rows.mapInArrow(_block_rows(shared), blocks.SCHEMA))
    return (held.mapInArrow(_joined_rows(shared), "block long, head boolean, at binary, n binary").groupBy("block")
            .applyInArrow(_sums, "doc_id long, n_bytes long, n_tokens long"))
