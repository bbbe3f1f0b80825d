"""Operator 5, LM scoring: Brown class-based bigrams with exchange clustering.

P(word | previous) = P(class | previous word's class) * P(word | class)

1. Blocks of documents (see ``blocks``) hold their distinct words, how often training documents have each, and the number of
   each token's word; they are stored once. The words go to ranges of the vocabulary once (their number follows that of the tokens): there
   they are counted (c of each, their number N, the vocabulary size V) and numbered; from then on only numbers move.
2. Exchange clustering of the whole vocabulary. The ``CORE`` most frequent words start it on the driver: they are moved
   between ``CLASSES`` classes, one after the other, as long as the likelihood of their bigrams (counted over all training
   documents) grows. Then every training word takes part, from a table of words and classes that stays in Spark: a sweep
   counts, for each word, the classes that all its neighbours had after the last sweep (in the first one, neighbours of the core)
   and moves it to the class where these bigrams are likeliest. All words move at once, so the likelihood of all class bigrams
   is measured after each sweep; sweeps end when it no longer rises (or after ``SWEEPS``), and the table with the largest one is kept.
   Distinct bigrams are counted and stored once, at the ranges of their words; a sweep shuffles them and a byte for each word
   that a range asks of another one. A bigram with a core word is at its other word, so that no range has all neighbours of a
   frequent word; the sums of core words come from all ranges.
3. At the end blocks ask the ranges for classes and counts of their words; a block keeps one byte a token, its class, besides
   sums per document.
4. Class transitions are counted over all training documents and smoothed towards the classes' frequencies; words
   are emitted with an absolute discount, and what it sets free in each class goes to unknown words.

For every history the probabilities of the V known words and of "unknown" sum to one, the events that the base
score has too. What the driver holds is bounded: CORE^2 bigram counts and CLASSES^2 transitions.
"""

from __future__ import annotations

import gc
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm import blocks
from shopstream.llm.common import chunks, discarded, stored, text_rows

CORE = 2048
CLASSES = 64
SWEEPS = 10
SMOOTHING = 5.0  # weight of the classes' frequencies in a transition, in tokens
TASK_BYTES = 24 << 20  # text bytes of a block, and of what a task gathers before it hands it on
RANGE_BYTES = 6 << 20  # bytes of token places (three a token) for each range of the vocabulary
END = b""        # the end of a document; no word is empty


def words_of(body: bytes) -> list[bytes]:
    """Words between ASCII white space with A-Z lower-cased, then the end."""
    words = body.lower().split()
    words.append(END)
    return words


def remainder(doc_id: int | None, folds: int) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds


def learnt_from(ids: list, folds: int, held: int) -> np.ndarray:
    """Which documents are learnt from: those with an id whose remainder is not ``held``."""
    return np.array([(r := remainder(i, folds)) is not None and r != held for i in ids], bool)


def place_width(tokens: int) -> int:
    """Bytes of a place in a block of so many tokens."""
    return 3 if tokens < 1 << 24 else 4


def narrowed(places: np.ndarray, tokens: int) -> np.ndarray:
    """Places as bytes, ``place_width`` each."""
    return places.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :place_width(tokens)].ravel()


def widened(content: np.ndarray, tokens: int) -> np.ndarray:
    width = place_width(tokens)
    out = np.zeros((len(content) // width, 4), np.uint8)
    out[:, :width] = content.reshape(-1, width)
    return out.view("<u4").ravel()


def _block_rows(batches: Iterator[pa.RecordBatch], folds: int = 7, held: int = 2) -> Iterator[pa.RecordBatch]:
    """Rows of each block: a word, its number in the block and how often training documents of the block have it; the header
    also has the number of each token's word."""
    for block, index, numbers, counts, ids, _ in blocks.runs(batches, words_of, TASK_BYTES):
        size = len(index)
        each = np.arange(1, size + 1)
        own = blocks.packed(np.arange(size, dtype=np.uint32), each)
        learnt = np.bincount(numbers[np.repeat(learnt_from(ids, folds, held), counts)], minlength=size).astype(np.uint32)
        batch = blocks.rows(block, list(index), own, blocks.packed(learnt, each), ids, counts)
        tokens = pa.array([narrowed(numbers, size).tobytes()], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.concat_arrays([batch.column("n").slice(0, size), tokens])], names=blocks.NAMES)


def _planes(values: np.ndarray) -> bytes:
    """First all lowest bytes, then all second ones, ...: bytes that hardly differ stand together, so shuffled rows get smaller."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.dtype.itemsize).T).tobytes()


def _from_planes(table: pa.Table, name: str, kind) -> np.ndarray:
    """All numbers of a column of planes in a row."""
    width = np.dtype(kind).itemsize
    parts = [np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(width, -1).T).view(kind).ravel() for x in table.column(name).to_pylist() if x]
    return np.concatenate(parts) if parts else np.empty(0, kind)


def _numbers(table: pa.Table, name: str, kind) -> np.ndarray:
    return blocks.gathered(table.column(name), kind)[0]


def _binary(*arrays: np.ndarray) -> list[pa.Array]:
    """A column of one value for each array."""
    return [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in arrays]


def _short(n: np.ndarray) -> bytes:
    """Counts: a byte each, then those from 255 on as they are (their byte is 255)."""
    return np.minimum(n, 255).astype(np.uint8).tobytes() + n[n >= 255].astype(np.int64).tobytes()


def _long(content: bytes, size: int) -> np.ndarray:
    """So many counts that ``_short`` packed."""
    n = np.frombuffer(content, np.uint8, size).astype(np.int64)
    n[n == 255] = np.frombuffer(content, np.uint8, offset=size).view(np.int64) if len(content) > size else 0
    return n


def _runs_of(keys: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of equal keys."""
    if not len(keys):
        return []
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return list(zip(begin.tolist(), np.append(begin[1:], len(keys)).tolist(), strict=True))


_RANGES = "r int, block long, pieces array<binary>, at binary, x binary"


def _range_rows(table: pa.Table) -> pa.Table:
    """All words of a range, of all blocks -> a row with its distinct words and their training counts, and a row a block: the
    numbers its words have in the block, and in the range."""
    words = table.column("piece").combine_chunks()
    words = (words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words).dictionary_encode()
    at = words.indices.to_numpy().astype(np.uint32)
    counts = np.bincount(at, weights=_numbers(table, "n", np.uint32), minlength=len(words.dictionary)).astype(np.int64)
    block, own = table.column("block").to_numpy(), _numbers(table, "at", np.uint32)
    order = np.argsort(block, kind="stable")
    block, own, at = block[order], own[order], at[order]
    runs = _runs_of(block)
    r = table.column("r")[0].as_py()
    return pa.table({
        "r": pa.array([r] * (len(runs) + 1), pa.int32()), "block": pa.array([None, *(int(block[i]) for i, _ in runs)], pa.int64()),
        "pieces": pa.array([words.dictionary.to_pylist(), *[None] * len(runs)], pa.list_(pa.binary())),
        "at": pa.array([None, *(own[i:j].tobytes() for i, j in runs)], pa.binary()),
        "x": pa.array([counts.tobytes(), *(at[i:j].tobytes() for i, j in runs)], pa.binary())})


def ranged(held_rows: DataFrame) -> DataFrame:
    """The vocabulary in ranges of words, a range for every two million tokens, so that a range stays as small as a block."""
    places = held_rows.where("head").agg(F.sum(F.length("n"))).first()[0] or 0
    ranges = max(12, places // RANGE_BYTES)
    by = F.pmod(F.xxhash64("piece"), F.lit(ranges)).cast("int")
    return stored(held_rows.where("not head").withColumn("r", by).groupBy("r").applyInArrow(_range_rows, _RANGES), "word-ranges")


def _most_frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (piece, c, r, i): the CORE most frequent training words of each range, and the end."""
    for batch in batches:
        for row in batch.to_pylist():
            counts = np.frombuffer(row["x"], np.int64)
            least = np.sort(counts)[-CORE] if len(counts) > CORE else 1
            top = [i for i in np.flatnonzero(counts >= max(1, least)).tolist() if row["pieces"][i] != END]
            top = sorted(top, key=lambda i: (-counts[i], row["pieces"][i]))[:CORE] + [i for i, p in enumerate(row["pieces"]) if p == END]
            yield pa.RecordBatch.from_arrays([pa.array([row["pieces"][i] for i in top], pa.binary()), pa.array(counts[top], pa.int64()),
                                              pa.array([row["r"]] * len(top), pa.int32()), pa.array(top, pa.int32())], names=["piece", "c", "r", "i"])


def _named_rows(wanted: frozenset):
    """Rows (piece, r, i) of the words asked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                got = [i for i, p in enumerate(row["pieces"]) if p in wanted]
                yield pa.RecordBatch.from_arrays([pa.array([row["pieces"][i] for i in got], pa.binary()), pa.array([row["r"]] * len(got), pa.int32()),
                                                  pa.array(got, pa.int32())], names=["piece", "r", "i"])
    return run


def _named(ranges: DataFrame, pieces) -> list:
    """Rows (piece, r, i) of some words (CORE at most)."""
    return ranges.where("block is null").select("r", "pieces").mapInArrow(_named_rows(frozenset(pieces)), "piece binary, r int, i int").collect()


def _count_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (n, v, once, twice): tokens, words, and words of one and two tokens in training documents."""
    for batch in batches:
        for x in batch.column("x").to_pylist():
            counts = np.frombuffer(x, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([int(k)]) for k in (counts.sum(), (counts > 0).sum(), (counts == 1).sum(), (counts == 2).sum())],
                                             names=["n", "v", "once", "twice"])


def _core_rows(core: dict, size: int):
    """Rows (prev, word, n): how often core words follow a core word (ranks; packed) in training documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                many = np.frombuffer(row["cm"], np.uint32)
                if row["r"] in core:
                    rank = np.full(len(many), -1, np.int64)
                    numbers, ranks = core[row["r"]]
                    there = numbers < len(many)
                    rank[numbers[there]] = ranks[there]
                    word = np.repeat(rank, many)
                    at = np.flatnonzero(word >= 0)
                    np.add.at(total, (np.frombuffer(row["cc"], np.uint16)[at] >> 1) * np.int64(size) + word[at], _long(row["cn"], len(word))[at])
        grid = total.reshape(size, size)
        prev = np.flatnonzero(grid.any(axis=1))
        words = [np.flatnonzero(grid[p]) for p in prev]
        yield pa.RecordBatch.from_arrays(
            [pa.array(prev.astype(np.int32)), pa.array([w.astype(np.uint32).tobytes() for w in words], pa.binary()),
             pa.array([grid[p, w].tobytes() for p, w in zip(prev, words, strict=True)], pa.binary())], names=["prev", "word", "n"])
    return run


def _core_sums(size: int):
    """All rows of a previous word meet here: a row of ``size`` sums each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for prev, word, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                held.setdefault(prev, np.zeros(size, np.int64))[np.frombuffer(word, np.uint32)] += np.frombuffer(n, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())], names=["prev", "n"])
    return run


def core_counts(links: DataFrame, core: list) -> np.ndarray:
    """``[v, w]``: how often core word w follows core word v in the training documents (CORE^2 numbers at most)."""
    packed = links.where("src is null").select("r", "cm", "cc", "cn").mapInArrow(_core_rows(places_of(core), len(core)), "prev int, word binary, n binary")
    counts = np.zeros((len(core), len(core)))
    for r in packed.repartition("prev").mapInArrow(_core_sums(len(core)), "prev int, n binary").collect():
        counts[r["prev"]] = np.frombuffer(r["n"], np.int64)
    return counts


def core_bigrams(rows: DataFrame, core: list[bytes], folds: int, held: int) -> np.ndarray:
    """``core_counts`` of some words of texts."""
    held_rows = stored(rows.mapInArrow(lambda batches: _block_rows(batches, folds, held), blocks.SCHEMA), "word-blocks")
    ranges = ranged(held_rows)
    found = {bytes(r["piece"]): (r["r"], r["i"]) for r in _named(ranges, core)}
    at = [found.get(w, (-1, i)) for i, w in enumerate(core)]
    return core_counts(linked(held_rows, ranges, at, folds, held), at)


def _xlogx(x):
    return x * np.log(np.maximum(x, 1e-300))


def exchange(counts: np.ndarray, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each word, words by falling frequency; ``counts[v, w]``: how often w follows v."""
    n = len(counts)
    cls = np.arange(n) % classes
    onehot = np.eye(classes)[cls] if n else np.zeros((0, classes))
    grid = onehot.T @ counts @ onehot
    for _ in range(sweeps):
        moved = 0
        for w in range(n):
            a = cls[w]
            row = np.bincount(cls, weights=counts[w], minlength=classes)
            col = np.bincount(cls, weights=counts[:, w], minlength=classes)
            own = counts[w, w]
            row[a] -= own
            col[a] -= own
            grid[a] -= row
            grid[:, a] -= col
            grid[a, a] -= own
            before, after = grid.sum(axis=1), grid.sum(axis=0)
            gain = (_xlogx(grid + row) - _xlogx(grid)).sum(axis=1) + (_xlogx(grid + col[:, None]) - _xlogx(grid)).sum(axis=0)
            d = np.diag(grid)
            gain += _xlogx(d + row + col + own) + _xlogx(d) - _xlogx(d + row) - _xlogx(d + col)
            # w also adds to the totals of its neighbours' classes, but by as much wherever it goes
            r, c = row.sum() + own, col.sum() + own
            gain -= _xlogx(before + r + col) - _xlogx(before + col) + _xlogx(after + c + row) - _xlogx(after + row)
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            moved += b != a
            cls[w] = b
            grid[b] += row
            grid[:, b] += col
            grid[b, b] += own
        if not moved:
            break
    return cls


NONE = 255    # a word that has no class yet
UNSEEN = 254  # a word that no training document has

_ENTRIES = "r int, cu binary, cc binary, cn binary, tu binary, tc binary, tn binary"


def _word_ids(table: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Range and number in it of each word of a block."""
    of_range, many = np.empty(size, np.int64), np.empty(size, np.int64)
    at, per = blocks.gathered(table.column("at"), np.uint32)
    of_range[at] = np.repeat(table.column("r").to_numpy().astype(np.int64), per)
    many[at] = _numbers(table, "x", np.uint32)
    return of_range, many


def _ranked(core: dict, of_range: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Rank of each word among the core words, -1 for the others. ``core``: range -> (numbers, ranks)."""
    rank = np.full(len(number), -1, np.int64)
    for r in np.unique(of_range).tolist():
        if r in core:
            mine = np.flatnonzero(of_range == r)
            numbers, ranks = core[r]
            at = np.minimum(np.searchsorted(numbers, number[mine]), len(numbers) - 1)
            found = numbers[at] == number[mine]
            rank[mine[found]] = ranks[at[found]]
    return rank


def _entry_rows(core: dict, folds: int, held: int):
    """A block's header and its words' numbers -> its bigrams by the range of a word of theirs: (word, neighbour, how often).

    A bigram of two words outside the core is there once for each (a word after itself: once); one with a core word is there
    once, at the other word, and serves both; so no range holds all neighbours of a core word. Neighbours are
    2 * rank + side (core words) or 2 * (range << 32 | number) + side; side 1: the neighbour is the right one."""
    def run(head: pa.Table, gets: pa.Table) -> pa.Table:
        empty = pa.table({f: pa.array([], pa.int32() if f == "r" else pa.binary()) for f in ("r", "cu", "cc", "cn", "tu", "tc", "tn")})
        if not head.num_rows or not gets.num_rows:
            return empty
        ids, lengths = blocks.header(head.column("at")[0].as_py())
        size = int(blocks.gathered(gets.column("at"), np.uint32)[1].sum())
        numbers = widened(np.frombuffer(head.column("n")[0].as_py(), np.uint8), size)
        of_range, number = _word_ids(gets, size)
        rank = _ranked(core, of_range, number)
        order = np.lexsort((number, of_range))  # words get numbers by range, so that bigrams are sorted by it
        place = np.empty(size, np.uint32)
        place[order] = np.arange(size, dtype=np.uint32)
        of_range, number, rank = of_range[order], number[order], rank[order]
        # the first history is an end, as every document's last token is
        seq = place[np.append(numbers[-1:], numbers[np.repeat(learnt_from(ids, folds, held), lengths)])]
        pairs, n = np.unique(seq[:-1].astype(np.int64) * size + seq[1:], return_counts=True)
        del seq, numbers
        left, right, n = (pairs // size).astype(np.uint32), (pairs % size).astype(np.uint32), n.astype(np.uint32)
        del pairs
        is_core, code = rank >= 0, (of_range << 32 | number) * 2

        def by_right(which):
            at = np.flatnonzero(which)
            return at[np.argsort(right[at], kind="stable")]
        at_right, at_left = by_right(is_core[left]), np.flatnonzero(~is_core[left] & is_core[right])
        both = ~is_core[left] & ~is_core[right]
        tail_right, tail_left = by_right(both), np.flatnonzero(both & (left != right))
        sides = [
            (0, right[at_right], (2 * rank[left[at_right]]).astype(np.uint16), n[at_right]), (0, left[at_left], (2 * rank[right[at_left]] + 1).astype(np.uint16), n[at_left]),
            (3, right[tail_right], code[left[tail_right]], n[tail_right]), (3, left[tail_left], code[right[tail_left]] + 1, n[tail_left])]
        out: list = [[], *([] for _ in range(6))]
        for k, u, neighbour, times in sides:
            for i, j in _runs_of(of_range[u]):
                out[0].append(int(of_range[u[i]]))
                for m in range(6):
                    value = (number[u[i:j]].astype(np.uint32), neighbour[i:j], times[i:j])[m - k] if k <= m < k + 3 else None
                    out[m + 1].append(None if value is None else _planes(value))
        return pa.table([pa.array(out[0], pa.int32()), *(pa.array(x, pa.binary()) for x in out[1:])], names=empty.column_names)
    return run


_LINKS = "r int, src int, cm binary, cc binary, cn binary, tm binary, tp binary, tn binary"


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
    return key[first], np.add.reduceat(n[order].astype(np.int64), first) if len(key) else np.empty(0, np.int64)


def _link_rows(table: pa.Table) -> pa.Table:
    """All entries of a range -> a row with each bigram once (the neighbours outside the core as places in the list of all such
    neighbours), and a row for each range that such neighbours are of, with their numbers in it: what a sweep asks for."""
    r = table.column("r")[0].as_py()
    key, cn = _summed(_from_planes(table, "cu", np.uint32).astype(np.int64) << 16 | _from_planes(table, "cc", np.uint16), _from_planes(table, "cn", np.uint32))
    cu, cc = key >> 16, (key & 0xFFFF).astype(np.uint16)
    u, code = _from_planes(table, "tu", np.uint32).astype(np.int64), _from_planes(table, "tc", np.int64)
    want, place = np.unique(code >> 1, return_inverse=True)
    own = (code >> 1) == (np.int64(r) << 32 | u)
    key, tn = _summed(u << 32 | place << 2 | own << 1 | (code & 1), _from_planes(table, "tn", np.uint32))
    tu, tp = key >> 32, (key & 0xFFFFFFFF).astype(np.uint32)
    words = int(max(cu[-1] if len(cu) else -1, tu[-1] if len(tu) else -1)) + 1
    src = want >> 32
    runs = _runs_of(src)
    asked = [(want[i:j] & 0xFFFFFFFF).astype(np.uint32).tobytes() for i, j in runs]
    many = [np.bincount(u, minlength=words).astype(np.uint32).tobytes() for u in (cu, tu)]
    links = [many[0], cc.tobytes(), _short(cn), many[1], tp.tobytes(), _short(tn)]
    none = [None] * len(runs)
    return pa.table([pa.array([r] * (len(runs) + 1), pa.int32()), pa.array([None, *(int(src[i]) for i, _ in runs)], pa.int32()),
                     *(pa.array([x, *(asked if k == 0 else none)], pa.binary()) for k, x in enumerate(links))],
                    names=["r", "src", "cm", "cc", "cn", "tm", "tp", "tn"])


def _handed(asked: pa.Table, classes: pa.Table) -> pa.Table:
    """What other ranges ask of a range, and its classes -> rows (r, src, cls): the classes for each; its own with src -1."""
    if not classes.num_rows:
        return pa.table({"r": pa.array([], pa.int32()), "src": pa.array([], pa.int32()), "cls": pa.array([], pa.binary())})
    own, cls = classes.column("r")[0].as_py(), np.frombuffer(classes.column("cls")[0].as_py(), np.uint8)
    numbers, many = blocks.gathered(asked.column("cm"), np.uint32)
    ends = np.cumsum(many)
    got = cls[numbers]
    return pa.table({
        "r": pa.array([own, *asked.column("r").to_pylist()], pa.int32()), "src": pa.array([-1, *[own] * asked.num_rows], pa.int32()),
        "cls": pa.array([cls.tobytes(), *(got[e - m:e].tobytes() for e, m in zip(ends, many, strict=True))], pa.binary())})


_PROFILES = "r int, cls binary, cm binary, cx binary, cn binary, tm binary, tx binary, tn binary, at binary, n binary"


def _profiles(core: dict, core_cls: np.ndarray):
    """A range's bigrams and the classes handed to it -> its words' neighbours x (left ones by class, right ones plus CLASSES, 2 * CLASSES for the
    word itself; 255: without a class), and sums of two kinds at width * row + x: rows of core words, then a row for
    each class with the neighbours of its words outside the core."""
    size, width = len(core_cls), 2 * CLASSES + 1
    of_core = np.append(core_cls, NONE).astype(np.uint8)

    def run(links: pa.Table, got: pa.Table) -> pa.Table:
        got = got.sort_by("src")
        r = got.column("r")[0].as_py()
        handed = got.column("cls").to_pylist()
        cls = np.frombuffer(handed[0], np.uint8).copy()
        want = np.frombuffer(b"".join(handed[1:]), np.uint8)
        rank = np.full(len(cls), -1, np.int64)
        if r in core:
            rank[core[r][0]] = core[r][1]
            cls[core[r][0]] = of_core[core[r][1]]
        cm, tm = (np.append(x, np.zeros(len(cls) - len(x), np.uint32)) for x in (_numbers(links, "cm", np.uint32), _numbers(links, "tm", np.uint32)))
        cc, tp = _numbers(links, "cc", np.uint16).astype(np.int64), _numbers(links, "tp", np.uint32)
        short = [links.column(c)[0].as_py() if links.num_rows else b"" for c in ("cn", "tn")]
        cn, tn = _long(short[0], len(cc)), _long(short[1], len(tp))
        cu, tu = np.repeat(np.arange(len(cls)), cm), np.repeat(np.arange(len(cls)), tm)
        to, side = cc >> 1, cc & 1
        own = rank[cu] == to
        near = of_core[to].astype(np.int64)
        cx = np.where(own, 2 * CLASSES, near + CLASSES * side)
        cx[near >= CLASSES] = NONE
        near = want[tp >> 2].astype(np.int64) if len(tp) else np.empty(0, np.int64)
        tx = np.where(tp & 2, 2 * CLASSES, near + CLASSES * (tp & 1))
        tx[near >= CLASSES] = NONE

        total = np.zeros((size + CLASSES) * width, np.int64)

        def add(rows, x, n, which):
            total[:] += np.bincount((rows * width + x)[which], weights=n[which], minlength=len(total)).astype(np.int64)
        mine, valid = cls[cu].astype(np.int64), cls[cu] < CLASSES
        add(to, np.where(own, 2 * CLASSES, mine + CLASSES * (1 - side)), cn, valid)   # at the core word that is the neighbour
        add(rank[cu], cx, cn, (rank[cu] >= 0) & ~own & (cx < NONE))                   # at a core word with a core neighbour
        add(size + mine, cx, cn, (rank[cu] < 0) & valid & (cx < NONE))
        add(size + cls[tu].astype(np.int64), tx, tn, (cls[tu] < CLASSES) & (tx < NONE))
        at = np.flatnonzero(total)
        counts = [pa.array([x], pa.binary()) for x in short]
        return pa.table([pa.array([r], pa.int32()), *_binary(cls, cm, cx.astype(np.uint8)), counts[0], *_binary(tm, tx.astype(np.uint8)), counts[1],
                         *_binary(at.astype(np.int64), total[at])],
                        names=["r", "cls", "cm", "cx", "cn", "tm", "tx", "tn", "at", "n"])
    return run


def _total_rows(rows: int):
    """Sums of all ranges of a task: rows (prev, word, n) as ``_core_sums`` takes them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 2 * CLASSES + 1
        total = np.zeros(rows * width, np.int64)
        for batch in batches:
            for at, n in zip(batch.column("at").to_pylist(), batch.column("n").to_pylist(), strict=True):
                total[np.frombuffer(at, np.int64)] += np.frombuffer(n, np.int64)
        grid = total.reshape(rows, width)
        some = np.flatnonzero(grid.any(axis=1))
        at = [np.flatnonzero(grid[i]) for i in some]
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([x.astype(np.uint32).tobytes() for x in at], pa.binary()),
                                          pa.array([grid[i, x].tobytes() for i, x in zip(some, at, strict=True)], pa.binary())], names=["prev", "word", "n"])
    return run


def _totals(profiles: DataFrame, rows: int) -> np.ndarray:
    width = 2 * CLASSES + 1
    total = np.zeros((rows, width))
    packed = profiles.select("at", "n").mapInArrow(_total_rows(rows), "prev int, word binary, n binary")
    for r in packed.repartition("prev").mapInArrow(_core_sums(width), "prev int, n binary").collect():
        total[r["prev"]] = np.frombuffer(r["n"], np.int64)
    return total


def class_bigrams(total: np.ndarray, core_cls: np.ndarray) -> np.ndarray:
    """How often a class follows a class, from the left neighbours of all words that have one."""
    by_class = total[len(core_cls):].copy()
    np.add.at(by_class, core_cls, total[:len(core_cls)])
    return by_class[:, :CLASSES].T + np.diag(by_class[:, -1])


def gain_over_independence(grid: np.ndarray) -> float:
    """What class bigrams add to the log-likelihood of the training text; the rest of it depends on no class."""
    return float(_xlogx(grid).sum() - _xlogx(grid.sum(axis=0)).sum() - _xlogx(grid.sum(axis=1)).sum() + _xlogx(grid.sum()))


def move_weights(grid: np.ndarray) -> np.ndarray:
    """Row x, column k: what one neighbour x adds to the log-likelihood if the word is of class k."""
    grid = grid + 0.1
    before, after = np.log(grid.sum(axis=1)), np.log(grid.sum(axis=0))
    logs = np.log(grid)
    return np.concatenate([logs - after, logs.T - before, (np.diag(logs) - before - after)[None]])


def _likeliest(sums: np.ndarray, old: np.ndarray, weights: np.ndarray, most: int, all_words: bool) -> np.ndarray:
    """Each word (or only those without a class) in its likeliest class; without a neighbour that has one, in the class of the
    most tokens."""
    score = sums @ weights
    new = np.where(sums.any(axis=1), np.argmax(score, axis=1), most)
    rows = np.arange(len(sums))
    has = old < CLASSES
    stay = has & ((score[rows, new] <= score[rows, np.where(has, old, 0)] + 1e-9) | (not all_words))
    return np.where(stay | (old == UNSEEN), old, new).astype(np.uint8)


def _move_rows(weights: np.ndarray, most: int, all_words: bool):
    """Rows (r, cls): the classes of a range after a sweep."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, step = 2 * CLASSES + 1, 4096
        for batch in batches:
            for row in batch.to_pylist():
                old = np.frombuffer(row["cls"], np.uint8)
                sides = [(np.append(0, np.cumsum(np.frombuffer(row[m], np.uint32).astype(np.int64))), np.frombuffer(row[x], np.uint8), _long(row[n], len(row[x])))
                         for m, x, n in (("cm", "cx", "cn"), ("tm", "tx", "tn"))]
                new = np.empty(len(old), np.uint8)
                for begin in range(0, len(old), step):
                    end = min(begin + step, len(old))
                    sums = np.zeros((end - begin) * width)
                    for ends, x, n in sides:
                        i, j = ends[begin], ends[end]
                        word = np.repeat(np.arange(end - begin), np.diff(ends[begin:end + 1]))
                        there = x[i:j] < NONE
                        sums += np.bincount((word * width + x[i:j])[there], weights=n[i:j][there], minlength=len(sums))
                    new[begin:end] = _likeliest(sums.reshape(-1, width), old[begin:end], weights, most, all_words)
                yield pa.RecordBatch.from_arrays([pa.array([row["r"]], pa.int32()), *_binary(new)], names=["r", "cls"])
    return run


def _started(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            cls = np.where(np.frombuffer(row["x"], np.int64) > 0, NONE, UNSEEN).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([row["r"]], pa.int32()), *_binary(cls)], names=["r", "cls"])


def places_of(core: list) -> dict:
    """Range -> (numbers, ranks) of its core words, by number; ``core``: (range, number) by rank."""
    out: dict = {}
    for rank, (r, i) in enumerate(core):
        out.setdefault(r, []).append((i, rank))
    return {r: tuple(np.array(x, np.int64) for x in zip(*sorted(some), strict=True)) for r, some in out.items()}


def linked(held_rows: DataFrame, ranges: DataFrame, core: list, folds: int, held: int) -> DataFrame:
    """Distinct training bigrams and how often each is there, by ranges of words; ``core``: (range, number) of core words, by rank."""
    head = held_rows.where("head").select("block", "at", "n")
    gets = ranges.where("block is not null").select("block", "r", "at", "x")
    entries = head.groupBy("block").cogroup(gets.groupBy("block")).applyInArrow(_entry_rows(places_of(core), folds, held), _ENTRIES)
    links = stored(entries.groupBy("r").applyInArrow(_link_rows, _LINKS), "word-links")
    _freed(links.sparkSession)
    return links


def _freed(spark) -> None:
    """What earlier jobs shuffled goes only with its objects, here and in the JVM."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def swept(links: DataFrame, ranges: DataFrame, core: list, cls: np.ndarray, history: list | None = None) -> tuple[DataFrame, np.ndarray]:
    """Classes of all words, ``(r, cls)``, and of the core words, after the sweeps; ``core``: their (range, number).

    A sweep hands each range the classes of its words' neighbours, a byte each, and writes the neighbours' classes and the new
    classes; those of the sweep before are deleted."""
    places = places_of(core)
    asked, links_of = links.where("src is not null").select("src", "r", "cm"), links.where("src is null").drop("src")
    classes = stored(ranges.where("block is null").mapInArrow(_started, "r int, cls binary"), "word-classes")

    def profiles(classes, cls):
        handed = asked.groupBy("src").cogroup(classes.groupBy("r")).applyInArrow(_handed, "r int, src int, cls binary")
        out = stored(links_of.groupBy("r").cogroup(handed.groupBy("r")).applyInArrow(_profiles(places, cls), _PROFILES), "word-profiles")
        total = _totals(out, len(cls) + CLASSES)
        return out, total, class_bigrams(total, cls)

    def moved(out, total, grid, cls, all_words):
        weights, most = move_weights(grid), int(np.argmax(grid.sum(axis=0)))
        new = stored(out.mapInArrow(_move_rows(weights, most, all_words), "r int, cls binary"), "word-classes")
        return new, _likeliest(total[:len(cls)], cls.astype(np.int64), weights, most, all_words).astype(np.int64)

    best, kept = -np.inf, None
    for sweep in range(SWEEPS + 1):
        out, total, grid = profiles(classes, cls)
        if sweep:  # the first one only gives a class to the words outside the core
            now = gain_over_independence(grid)
            if history is not None:
                history.append(now)
            if now <= best:
                discarded(out, classes)
                break
            if kept is not None:
                discarded(kept[0])
            best, kept = now, (classes, cls)
        if sweep < SWEEPS:
            old = classes
            classes, cls = moved(out, total, grid, cls, sweep > 0)
            if not sweep:
                discarded(old)
        discarded(out)
        _freed(links.sparkSession)
    return kept


def _classes_named(places: dict, cls: np.ndarray):
    """Rows (piece, cls) of training words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                of = _overlaid(places, cls, row["r"], row["cls"])
                there = of < CLASSES
                yield pa.RecordBatch.from_arrays([pa.array([p for p, t in zip(row["pieces"], there, strict=True) if t], pa.binary()), pa.array(of[there].astype(np.int32))],
                                                 names=["piece", "cls"])
    return run


def _overlaid(places: dict, core_cls: np.ndarray, r: int, content: bytes) -> np.ndarray:
    """Classes of a range's words, those of its core words set."""
    of = np.frombuffer(content, np.uint8).copy()
    if r in places:
        numbers, ranks = places[r]
        of[numbers] = np.where(of[numbers] == UNSEEN, UNSEEN, core_cls[ranks])
    return of


def clustered(held_rows: DataFrame, core: DataFrame, folds: int, held: int, history: list | None = None) -> DataFrame:
    """``(piece, cls)`` of every training word, from the classes of some (CORE at most). ``history`` gets the likelihood after each sweep."""
    start = {bytes(r["piece"]): r["cls"] for r in core.collect()}
    ranges = ranged(held_rows)
    words = ranges.where("block is null")
    found = _named(ranges, start)
    at = [(r["r"], r["i"]) for r in found]
    links = linked(held_rows, ranges, at, folds, held)
    classes, cls = swept(links, ranges, at, np.array([start[bytes(r["piece"])] for r in found], np.int64), history)
    discarded(links)
    return words.select("r", "pieces").join(classes, "r").mapInArrow(_classes_named(places_of(at), cls), "piece binary, cls int")


def _class_sums(places: dict, core_cls: np.ndarray):
    """Rows (cls, n, kinds): tokens and words of each class in a range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                of, counts = _overlaid(places, core_cls, row["r"], row["cls"]), np.frombuffer(row["x"], np.int64)
                there = of < CLASSES
                n = np.zeros(CLASSES, np.int64)
                np.add.at(n, of[there], counts[there])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES, dtype=np.int32)), pa.array(n), pa.array(np.bincount(of[there], minlength=CLASSES))],
                                                 names=["cls", "n", "kinds"])
    return run


def _given(places: dict, core_cls: np.ndarray):
    """The words that blocks have of a range, and its classes and counts -> rows (block, at, cls, count)."""
    def run(gets: pa.Table, words: pa.Table) -> pa.Table:
        of = _overlaid(places, core_cls, words.column("of")[0].as_py(), words.column("classes")[0].as_py())
        counts = np.frombuffer(words.column("counts")[0].as_py(), np.int64)
        number, many = blocks.gathered(gets.column("x"), np.uint32)
        ends = np.cumsum(many)
        cls, count = of[number], counts[number]
        return pa.table({"block": gets.column("block"), "at": gets.column("at"),
                         "cls": pa.array([cls[e - m:e].tobytes() for e, m in zip(ends, many, strict=True)], pa.binary()),
                         "count": pa.array([count[e - m:e].tobytes() for e, m in zip(ends, many, strict=True)], pa.binary())})
    return run


def _encoded(folds: int, held: int, n: int, v: int, total: np.ndarray, kinds: np.ndarray, discount: float):
    """A block's header and its words' classes and counts -> one row: a class for each token, and sums for each document."""
    unknown = len(total)

    def run(head: pa.Table, words: pa.Table) -> pa.Table:
        ids, lengths = blocks.header(head.column("at")[0].as_py())
        at = _numbers(words, "at", np.uint32)
        of, counts = np.empty(len(at), np.uint8), np.empty(len(at), np.int64)
        of[at], counts[at] = _numbers(words, "cls", np.uint8), _numbers(words, "count", np.int64)
        numbers = widened(np.frombuffer(head.column("n")[0].as_py(), np.uint8), len(at))
        seq, known = np.where(of < unknown, of, unknown).astype(np.uint8)[numbers], counts[numbers]
        emit = np.zeros(len(seq))
        seen = known > 0
        emit[seen] = np.log10((known[seen] - discount) / total[seq[seen]])
        base = np.log10((known + 1) / (n + v + 1))
        first = np.append(0, np.cumsum(lengths)[:-1])
        sums = [np.add.reduceat(x, first) if len(x) else np.zeros(0) for x in (seen.astype(np.int64), base, emit)]
        learnt = learnt_from(ids, folds, held)
        return pa.table({
            "seq": pa.array([seq.tobytes()], pa.binary()), "ids": pa.array([ids], pa.list_(pa.int64())), "n_tokens": pa.array([lengths.tolist()], pa.list_(pa.int64())),
            "learnt": pa.array([learnt.tolist()], pa.list_(pa.bool_())), "n_known": pa.array([sums[0].tolist()], pa.list_(pa.int64())),
            "base": pa.array([sums[1].tolist()], pa.list_(pa.float64())), "emit": pa.array([sums[2].tolist()], pa.list_(pa.float64()))})
    return run


_ENCODED = "seq binary, ids array<long>, n_tokens array<long>, learnt array<boolean>, n_known array<long>, base array<double>, emit array<double>"


def _histories(seq: np.ndarray, lengths: np.ndarray, end: int) -> np.ndarray:
    """The class before each token; before a document's first token, that of the end."""
    prev = np.empty_like(seq)
    prev[1:] = seq[:-1]
    prev[np.append(0, np.cumsum(lengths)[:-1])] = end
    return prev


def _transition_rows(end: int, states: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(states * states, np.int64)
        for batch in batches:
            for seq, lengths, learnt in zip(*(batch.column(c).to_pylist() for c in ("seq", "n_tokens", "learnt")), strict=True):
                seq, lengths = np.frombuffer(seq, np.uint8), np.array(lengths)
                use = np.repeat(np.array(learnt), lengths)
                total += np.bincount(_histories(seq, lengths, end)[use].astype(np.int64) * states + seq[use], minlength=states * states)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])
    return run


def _score_rows(logs: np.ndarray, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                seq, lengths = np.frombuffer(row["seq"], np.uint8), np.array(row["n_tokens"])
                step = logs[_histories(seq, lengths, end), seq]
                score = np.add.reduceat(step, np.append(0, np.cumsum(lengths)[:-1])) + np.array(row["emit"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(row["n_tokens"], pa.int64()), pa.array(row["n_known"], pa.int64()), pa.array(row["base"]), pa.array(score)],
                    names=["doc_id", "n_tokens", "n_known", "base_score", "score"])
    return run


def transition_logs(counts: np.ndarray, total: np.ndarray, kinds: np.ndarray, discount: float, smoothing: float = SMOOTHING) -> np.ndarray:
    """log10 P(class | class before); the last column is P(unknown | class before), the last row the history "unknown"."""
    k = len(total)
    share = total / total.sum()
    counts = np.concatenate([counts[:k, :k], np.zeros((1, k))])
    p = (counts + smoothing * share) / (counts.sum(axis=1, keepdims=True) + smoothing)
    free = np.divide(discount * kinds, total, out=np.zeros(k), where=total > 0)
    p = np.concatenate([p, (p @ free)[:, None]], axis=1)
    return np.log10(np.maximum(p, 1e-300))


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per input row.

    Learns from the rows whose crc32 of the id modulo ``folds`` is not ``held``. A null or empty text is the end
    alone. Repeated rows count each time. Rows without an id are scored, but neither learnt from nor held out. Without
    training rows every token is unknown and both scores are 0 (the log of certainty: there is one event). An empty table gives an
    empty result.
    """
    held_rows = stored(text_rows(docs, id_col, text_col).mapInArrow(lambda batches: _block_rows(batches, folds, held), blocks.SCHEMA), "word-blocks")
    ranges = ranged(held_rows)
    heads = stored(held_rows.where("head"), "word-heads")
    discarded(held_rows)  # from here on words are numbers
    _freed(docs.sparkSession)
    words = ranges.where("block is null")
    sums = words.select("x").mapInArrow(_count_sums, "n long, v long, once long, twice long").agg(F.sum("n"), F.sum("v"), F.sum("once"), F.sum("twice")).first()
    n, v, once, twice = (int(x or 0) for x in sums)
    discount = min(0.95, max(0.05, once / max(1, once + 2 * twice)))

    frequent = words.select("r", "pieces", "x").mapInArrow(_most_frequent, "piece binary, c long, r int, i int")
    top = frequent.where(F.col("piece") != F.lit(END)).orderBy(F.desc("c"), "piece").limit(CORE - 1).collect() + frequent.where(F.col("piece") == F.lit(END)).collect()
    core, at = [bytes(r["piece"]) for r in top], [(r["r"], r["i"]) for r in top]
    if END not in core:
        core.append(END)
        at.append((-1, 0))  # an empty table has no words
    links = linked(heads, ranges, at, folds, held)
    cls = exchange(core_counts(links, at), CLASSES)
    if n:
        classes, cls = swept(links, ranges, at, cls)
    else:
        classes = words.select("r", "x").mapInArrow(_started, "r int, cls binary")
    discarded(links)
    places, end = places_of(at), int(cls[-1])

    total, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    per_class = words.select("r", "x").join(classes, "r").mapInArrow(_class_sums(places, cls), "cls int, n long, kinds long")
    for r in per_class.groupBy("cls").agg(F.sum("n").alias("n"), F.sum("kinds").alias("kinds")).collect():
        total[r["cls"]], kinds[r["cls"]] = r["n"], r["kinds"]
    gets = ranges.where("block is not null").select("block", "r", "at", "x")
    facts = words.join(classes, "r").select(F.col("r").alias("of"), F.col("x").alias("counts"), F.col("cls").alias("classes"))
    given = gets.groupBy("r").cogroup(facts.groupBy("of")).applyInArrow(_given(places, cls), "block long, at binary, cls binary, count binary")
    encoded = stored(heads.select("block", "at", "n").groupBy("block").cogroup(given.groupBy("block")).applyInArrow(_encoded(folds, held, n, v, total, kinds, discount), _ENCODED), "class-blocks")
    states = CLASSES + 1
    moves = np.zeros(states * states)
    for r in encoded.select("seq", "n_tokens", "learnt").mapInArrow(_transition_rows(end, states), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        moves[r["at"]] = r["n"]
    logs = transition_logs(moves.reshape(states, states), total, kinds, discount) if n else np.zeros((states, states))
    scored = encoded.mapInArrow(_score_rows(logs, end), "doc_id long, n_tokens long, n_known long, base_score double, score double")
    fold_of = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    return scored.select("doc_id", F.coalesce(fold_of == held, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
                         F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
