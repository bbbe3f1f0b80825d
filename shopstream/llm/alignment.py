"""Operator 13, cross-tokenizer alignment by pointer jumping.

1. Texts are cut before the first space after a non-space: there no token of either side goes on. A task encodes and aligns each distinct
   piece once while it remembers it. Tokens are laid out by the bytes they stand for, so a token is known by where it ends.
2. Every token points to the farthest-right token of the other side that it overlaps; a token of A that ends where one
   of B ends points to itself. Successors are doubled, for all tokens of all new pieces at once, until nothing changes: each
   token then points to the terminal token of its component, which labels its group. A group of n tokens takes about log2(n) steps.
3. The documents are stored with their links packed into bytes. A block of documents hands on each distinct pair of ids once, with
   how often it is in the block: these rows are summed to corpus counts, and joined with them to bring the counts back to the blocks.
   A pair that every document holds is a row a block, and the engine may split it in that join.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import chunks, stored, text_rows
from shopstream.llm.token_counts import PATTERN, Cutter

BLOCK_BYTES = 8 << 20  # text bytes of a block
REMEMBERED = 400_000   # distinct pieces that a task holds
REMEMBERED_CHARS = 64  # longer ones are not held
_RUN_BITS = 20


def byte_alphabet() -> dict[str, int]:
    """Byte of each character of byte-level vocabularies: printable bytes are themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(c): b for c, b in [*zip(plain, plain, strict=True), *((256 + i, b) for i, b in enumerate(others))]}


#: A space after a non-space begins a piece; white space that begins otherwise, and that at the end of a text, stays in its piece.
PIECES = re.compile(r" \s*\S+(?:[^\S ]\s*\S+)*(?:\s+\Z)?|\s+\Z").findall


class SideA:
    """A byte-level tokenizer, whose pre-tokens begin at every such space; special strings inside texts are plain text.

    Where its ids stand in the order of its merges, merging by id is the same as merging by its list, and ASCII pieces (of which
    all versions of Unicode say the same) take the faster library that does so."""

    def __init__(self, source: str):
        self.library = Cutter(source).library
        self.library.encode_special_tokens = True
        spec, alphabet = json.loads(source), byte_alphabet()
        vocab = spec["model"]["vocab"]
        spelled = {i: bytes(alphabet[c] for c in p) for p, i in vocab.items() if all(c in alphabet for c in p)}
        self.bytes = [spelled.get(i, b"") for i in range(self.library.get_vocab_size(with_added_tokens=True))]
        self.lengths = [len(x) for x in self.bytes]
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        singles = [i for i, x in spelled.items() if len(x) == 1]
        in_order = len(singles) == 256 and merged[:1] > [max(singles)] and all(x < y for x, y in pairwise(merged))
        plain = {k: spec["model"].get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")}
        self.by_id = None
        if in_order and not any(plain.values()):
            import tiktoken

            ranks = {spelled[i]: i for i in [*singles, *merged]}
            self.by_id = tiktoken.Encoding("ids", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, pieces: list[str]) -> list[list[int]]:
        if self.by_id is None:
            return [e.ids for e in self.library.encode_batch_fast(pieces, add_special_tokens=False)]
        others = iter(self.library.encode_batch_fast([p for p in pieces if not p.isascii()], add_special_tokens=False))
        return [self.by_id(p) if p.isascii() else next(others).ids for p in pieces]


class SideB:
    """A SentencePiece model that puts a space before the text and has no token that goes on after a space."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.library.get_piece_size()
        if any(re.search("[^▁]▁", self.library.id_to_piece(i)) for i in range(size)):
            raise ValueError("models with tokens across spaces are not supported")
        if "".join(self.library.encode("  a  b", out_type=str)) != "▁▁▁a▁▁b":
            raise ValueError("only models that keep white space and add a space are supported")
        self.bytes = [self._of(i) for i in range(size)]
        self.lengths = [len(x) for x in self.bytes]

    def _of(self, i: int) -> bytes:
        piece = self.library.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, pieces: list[str]) -> list[list[int]]:
        return self.library.encode([p[1:] for p in pieces], num_threads=1)


def terminals(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of A and of B the number of the token of A that ends its group. Both sides cover the same bytes."""
    n = len(end_a)
    over = np.searchsorted(end_b, end_a)      # the token of B that holds the last byte of a token of A
    together = end_b[over] == end_a if n else np.empty(0, bool)
    nodes = np.concatenate([np.where(together, np.arange(n), n + over), np.searchsorted(end_a, end_b)])
    while True:
        farther = nodes[nodes]
        if np.array_equal(farther, nodes):
            return nodes[:n], nodes[n:]
        nodes = farther


class Aligner:
    def __init__(self, a: SideA, b: SideB, kind: str):
        self.a, self.b, self.kind = a, b, kind
        self.len_a, self.len_b = (np.array(side.lengths, np.int64) for side in (a, b))
        # a token in a digest and what follows it: in a group, after the last token of A, after the last of B
        self.texts = [f"{i}{mark}" for mark, side in ((",", a), ("|", a), (",", b), (";", b)) for i in range(len(side.bytes))]
        sizes = np.cumsum([0, len(a.bytes), len(a.bytes), len(b.bytes)])
        self.within_a, self.last_a, self.within_b, self.last_b = sizes.tolist()
        self.known: dict[str, tuple | None] = {}

    def _aligned(self, pieces: list[str]) -> Iterator[tuple | None]:
        """(tokens of A, tokens of B, text of the groups, links) of each piece; None where the tokens of a side are not its bytes."""
        whole, encoded = [p.encode() for p in pieces], (self.a.encode(pieces), self.b.encode(pieces))
        sound = [True] * len(pieces)
        for side, tokens in zip((self.a, self.b), encoded, strict=True):
            size = side.lengths.__getitem__
            if b"".join([side.bytes[i] for ids in tokens for i in ids]) != b"".join(whole) or any(
                    sum(map(size, ids)) != len(w) for ids, w in zip(tokens, whole, strict=True)):  # look for the pieces that differ
                sound = [same and b"".join([side.bytes[i] for i in ids]) == w for same, ids, w in zip(sound, tokens, whole, strict=True)]
        both = [x if same else None for x, same in zip(zip(*encoded, strict=True), sound, strict=True)]
        some = [x for x in both if x]
        n_a, n_b = (np.fromiter((len(x[k]) for x in some), np.int64, len(some)) for k in (0, 1))
        a, b = (np.fromiter(chain.from_iterable([x[k] for x in some]), np.int64, int(n.sum())) for k, n in ((0, n_a), (1, n_b)))
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        top_a, top_b = terminals(end_a, end_b)

        ends = top_a == np.arange(len(a))
        last = np.flatnonzero(ends)           # terminal tokens, one a group
        links = (a[last] * len(self.b.bytes) + b[np.searchsorted(end_b, end_a[last])]).astype(self.kind)
        group_a, group_b = np.searchsorted(last, top_a), np.searchsorted(last, top_b)
        ends_b = np.cumsum(np.bincount(group_b, minlength=len(last)))  # tokens of B up to the end of each group
        marked = np.empty(len(a) + len(b), np.int64)
        marked[np.arange(len(a)) + np.append(0, ends_b)[group_a]] = a + np.where(ends, self.last_a, self.within_a)
        closes = np.append(group_b[1:] != group_b[:-1], True)[:len(b)]
        marked[np.arange(len(b)) + last[group_b] + 1] = b + np.where(closes, self.last_b, self.within_b)

        words, links = [self.texts[i] for i in marked.tolist()], links.tobytes()
        cuts = np.append(0, np.cumsum(n_a + n_b)).tolist()
        groups = (np.searchsorted(last, np.append(0, np.cumsum(n_a))) * np.dtype(self.kind).itemsize).tolist()  # bytes of links before each piece
        done = zip(n_a.tolist(), n_b.tolist(), ("".join(words[x:y]) for x, y in pairwise(cuts)), (links[x:y] for x, y in pairwise(groups)), strict=True)
        for x in both:
            yield next(done) if x else None

    def align(self, bodies: list[bytes]) -> Iterator[tuple[int, int, str, bytes]]:
        """(tokens of A, tokens of B, digest, linked ids as a * size of B + b) of each text."""
        texts = [b.decode("utf-8", "replace") for b in bodies]
        pieces = [PIECES(" " + t) if t else [] for t in texts]
        distinct = set(chain.from_iterable(pieces))
        if len(self.known) > REMEMBERED:
            self.known = {}
        fresh = list(distinct.difference(self.known))
        self.known.update(zip(fresh, self._aligned(fresh), strict=True))
        known = self.known
        for body, text, some in zip(bodies, texts, pieces, strict=True):
            parts = [known[p] for p in some]
            if not parts or None in parts or text.encode() != body:
                yield 0, 0, "", b""
                continue
            a, b, groups, links = zip(*parts, strict=True)
            yield sum(a), sum(b), hashlib.sha256("".join(groups)[:-1].encode()).hexdigest(), b"".join(links)
        for p in fresh:
            if len(p) > REMEMBERED_CHARS:
                del known[p]


_DOC = "block long, doc_id long, n_a long, n_b long, groups_sha256 string, links binary"


def _aligned_rows(shared, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, model = shared.value
        aligner = Aligner(SideA(source), SideB(model), kind)
        part = TaskContext.get().partitionId() if TaskContext.get() else 0
        run_no, size = 0, 0
        for ids, bodies in chunks(batches):
            n_a, n_b, digests, links = zip(*aligner.align(bodies), strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), part << _RUN_BITS | run_no)), pa.array(ids, pa.int64()), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()),
                 pa.array(digests, pa.string()), pa.array(links, pa.binary())], names=["block", "doc_id", "n_a", "n_b", "groups_sha256", "links"])
            size += sum(map(len, bodies))
            if size >= BLOCK_BYTES:
                run_no, size = run_no + 1, 0
    return run


def _pair_rows(kind: str):
    """Rows (block, pair, n): distinct links of a block. A block that two tasks read has two rows of a pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        block = None

        def rows():
            pair, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), block, np.int64)), pa.array(pair.astype(np.int64)), pa.array(n)], names=["block", "pair", "n"])
        for batch in batches:
            for at, links in zip(batch.column("block").to_pylist(), batch.column("links").to_pylist(), strict=True):
                if held and at != block:
                    yield rows()
                    held = []
                block = at
                held.append(np.frombuffer(links, kind))
        if held:
            yield rows()
    return run


def _counted_docs(kind: str):
    """The documents of a block and the counts of its links -> the documents' results."""
    def run(docs: pa.Table, counts: pa.Table) -> pa.Table:
        pair = counts.column("pair").to_numpy()
        order = np.argsort(pair)
        pair, n, best = pair[order], counts.column("n").to_numpy()[order], counts.column("best").to_numpy()[order].astype(np.int64)
        links = [np.frombuffer(x, kind) for x in docs.column("links").to_pylist()]
        many = np.array([len(x) for x in links], np.int64)
        at = np.searchsorted(pair, np.concatenate(links).astype(np.int64)) if len(links) else np.empty(0, np.int64)
        first = np.append(0, np.cumsum(many))
        sums = [np.diff(np.append(0, np.cumsum(x[at]))[first]) for x in (best, n)]
        return pa.table({"doc_id": docs.column("doc_id"), "n_a": docs.column("n_a"), "n_b": docs.column("n_b"), "n_groups": many,
                         "n_links": many, "n_best": sums[0], "count_sum": sums[1], "groups_sha256": docs.column("groups_sha256")})
    return run


def align_tokens(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, one row per input row.

    ``path_a``: a byte-level ``.json`` tokenizer, which gets the text after a space; ``path_b``: a SentencePiece ``.model`` that adds
    that space itself. Both files (a few MB) are read on the driver and sent to the tasks. Bytes at which tokens of both sides end cut
    the tokens into groups; the two tokens that end a group are linked. ``count_sum`` adds the corpus-wide counts of
    the document's linked id pairs, ``n_best`` counts the links whose count is the highest of their B id, ties included.

    A null or empty text, and one that either side does not give back byte for byte, has no tokens: zeros and an empty digest.
    Repeated rows, and rows without an id, are aligned and counted each. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    with open(path_a, encoding="utf-8") as f:
        source = f.read()
    with open(path_b, "rb") as f:
        model = f.read()
    size_a, size_b = len(SideA(source).bytes), len(SideB(model).bytes)
    kind = "<u4" if size_a * size_b < 1 << 32 else "<i8"
    shared = spark.sparkContext.broadcast((source, model))

    rows = stored(text_rows(docs, id_col, text_col).mapInArrow(_aligned_rows(shared, kind), _DOC), "aligned-documents")
    pairs = stored(rows.select("block", "links").mapInArrow(_pair_rows(kind), "block long, pair long, n long"), "block-pairs")
    counts = stored(pairs.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    b_id = (F.col("pair") % size_b).alias("b")
    most = counts.groupBy(b_id).agg(F.max("n").alias("most"))
    graded = stored(counts.select("pair", "n", b_id).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "graded-pairs")
    known = pairs.select("block", "pair").join(graded, "pair")
    return rows.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        _counted_docs(kind), "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
