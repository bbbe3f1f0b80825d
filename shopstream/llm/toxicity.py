"""Operator 3, toxicity: Levenshtein automata over a lexicon trie, with context windows.

* Lexicon: words whose document frequencies in a bounded labelled training sample speak for toxic
  documents (log-odds, kept where the likelihood ratio is large).
* Matching: a Levenshtein automaton (at most one error) intersected with the lexicon's trie reads each distinct
  word once; it is left as soon as no term can be near, so exact and misspelled terms are found in one walk. A
  form that training saw on its own counts by its own log-odds, not by the term's.
* Context: each hit is looked at in a window of characters around it: quotation marks and reporting words speak
  for quotation, words of address for abuse. Logistic regression weighs the sums of exact, misspelled,
  quoted and addressed hits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import Memo, cut, fold, stored, text_rows
from shopstream.llm.labelled import labelled_sample, logistic_fit, sigmoid

THRESHOLD = 0.5
MAX_LABELLED = 20_000
MAX_TERMS = 1000       # strongest terms kept
MIN_TOXIC = 3          # toxic training documents that hold a term
MIN_LIKELIHOOD = 25.0  # G-test statistic of a term
ERRORS = 1
FUZZY_LENGTH = 5       # shorter terms are matched exactly only
WINDOW = 60            # characters on each side of a hit

# fixed values: words that report speech, and words that address a person (English, German, French, Spanish)
REPORTING = "said says saying quote quoted quotes called calls wrote writes word term sagte zitat wort dit citation mot dijo cita palabra"
ADDRESS = "you your yours youre du dein deine dich ihr euch tu toi ton ta vous votre te tus usted ustedes eres"
QUOTES = "\"“”„«»‹›"
_WORD = re.compile(r"[^\W_]+")
_REPORTING, _ADDRESS = frozenset(REPORTING.split()), frozenset(ADDRESS.split())


def words_of(text: str) -> list[str]:
    """Runs of letters and digits, lower-cased."""
    return _WORD.findall(text.lower())


class Trie:
    """Lexicon trie with a Levenshtein automaton that runs over it.

    A state of the automaton is the set of trie nodes that the characters read so far can stand for, each with the fewest
    errors; it is made when a word first leads to it and kept with its transitions, so all words share one deterministic
    automaton of the whole lexicon and most leave it after a few characters.
    """

    def __init__(self, terms, errors: int = ERRORS):
        self.errors = errors
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        for term in terms:
            node = 0
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                node = self.children[node][c]
            self.term[node] = term
        self.numbers: dict[frozenset, int] = {}
        self.states: list[dict[int, int]] = []
        self.moves: list[dict[str, int]] = []  # by state: next state by character; -1: no term is near
        self.found: list[tuple[int, str] | None] = []
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        """Number of the state with these nodes (fewest errors each) and those reached by leaving out term characters."""
        queue = list(nodes.items())
        for node, e in queue:
            if e < self.errors and nodes[node] == e:
                for child in self.children[node].values():
                    if nodes.get(child, self.errors + 1) > e + 1:
                        nodes[child] = e + 1
                        queue.append((child, e + 1))
        if not nodes:
            return -1
        key = frozenset(nodes.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(nodes)
            self.moves.append({})
            self.found.append(min(((e, self.term[n]) for n, e in nodes.items() if self.term[n] is not None), default=None))
        return self.numbers[key]

    def _move(self, state: int, c: str) -> int:
        new: dict[int, int] = {}
        for node, e in self.states[state].items():
            for d, child in self.children[node].items():
                cost = e if d == c else e + 1
                if cost <= self.errors and new.get(child, self.errors + 1) > cost:
                    new[child] = cost
            if e < self.errors and new.get(node, self.errors + 1) > e + 1:
                new[node] = e + 1  # a character too many
        self.moves[state][c] = out = self._state(new)
        return out

    def near(self, word: str) -> tuple[str, int] | None:
        """The lexicon term closest to the word (smallest of equals) and its distance, if within the errors."""
        state, moves = self.start, self.moves
        for c in word:
            after = moves[state].get(c)
            state = self._move(state, c) if after is None else after
            if state < 0:
                return None
        found = self.found[state]
        return (found[1], found[0]) if found else None


@dataclass
class Model:
    counts: dict = field(default_factory=dict)   # term -> (toxic, clean) training documents
    forms: dict = field(default_factory=dict)    # misspelled forms that training saw -> the same
    toxic: int = 0
    clean: int = 0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(PRIOR)))

    def log_odds(self, toxic: int, clean: int, own: int | None = None) -> float:
        """Of a word's document counts; ``own``: the label of a training document to leave out."""
        n1, n0 = self.toxic, self.clean
        if own is not None:
            toxic, clean, n1, n0 = toxic - own, clean - (1 - own), n1 - own, n0 - (1 - own)
        return log((toxic + .5) / (n1 + 1)) - log((clean + .5) / (n0 + 1))


#: Weights before training sees anything: bias, exact, misspelled, quoted exact, quoted misspelled, hits, hits a
#: word, addressed hits, length.
PRIOR = np.array([-3.0, 0.8, 0.5, 0.3, 0.2, 0.3, 0.3, 0.2, 0.0])


class Scorer:
    """Features of a text under a model."""

    def __init__(self, model: Model):
        self.model = model
        self.trie = Trie(t for t in model.counts if len(t) >= FUZZY_LENGTH)
        self.known = Memo(self._match)

    def _match(self, word: str):
        """None, or (counts, whether it is misspelled)."""
        if (n := self.model.counts.get(word)) is not None:
            return n, False
        if (found := self.trie.near(word)) is None:
            return None
        return self.model.forms.get(word, self.model.counts[found[0]]), True

    def features(self, text: str, own: int | None = None) -> list[float]:
        low = text.lower()
        words = _WORD.findall(low)
        hits = {}
        for w in set(words):
            if (found := self.known[w]) is not None:
                hits[w] = found
        if not hits:
            return [1.0, 0, 0, 0, 0, 0, 0, 0, log1p(len(words)) / 10]
        sums, quoted_of, addressed, times = [0.0] * 4, {}, 0, 0
        for m in _WORD.finditer(low):
            if m[0] in hits:
                times += 1
                around = low[max(0, m.start() - WINDOW):m.end() + WINDOW]
                near = set(_WORD.findall(around))
                quoted = self._quoted(low, m.start(), m.end()) or bool(near & _REPORTING)
                quoted_of[m[0]] = quoted_of.get(m[0], True) and quoted  # abuse if one place is not a quotation
                addressed += bool(near & _ADDRESS)
        for w, ((n1, n0), fuzzy) in hits.items():
            seen = w in self.model.counts or w in self.model.forms
            weight = self.model.log_odds(n1, n0, own if seen else None)
            sums[2 * quoted_of[w] + fuzzy] += max(weight, -2.0) if seen else max(weight, 0.0)
        return [1.0, *sums, log1p(times), 10 * times / (len(words) + 20), log1p(addressed), log1p(len(words)) / 10]

    @staticmethod
    def _quoted(low: str, start: int, end: int) -> bool:
        """A quotation mark opens before the hit in its window, and one closes after it, on the same line."""
        before = low[max(0, start - WINDOW):start].rpartition("\n")[2]
        after = low[end:end + WINDOW].partition("\n")[0]
        return any(c in QUOTES for c in before) and any(c in QUOTES for c in after)

    def score(self, text: str) -> float:
        if not self.model.toxic:
            return 0.0
        return float(sigmoid(np.dot(self.features(text), self.model.weights)))


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out, ys = [], []
        for y, body in zip(batch.column("y").to_pylist(), batch.column("body").to_pylist(), strict=True):
            found = set(words_of(body.decode("utf-8", "replace")))
            out += found
            ys += [y] * len(found)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(ys, pa.int32())], names=["word", "y"])


def _form_rows(terms: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, lexicon = Trie(t for t in terms if len(t) >= FUZZY_LENGTH), set(terms)
        for batch in batches:
            words = batch.column("word").to_pylist()
            pick = [i for i, w in enumerate(words) if w not in lexicon and trie.near(w)]
            yield batch.take(pa.array(pick, pa.int64()))
    return run


def likelihood_ratio(n1, n0, toxic: int, clean: int):
    """G statistic of a word's documents against the share of toxic ones (Spark columns)."""
    n, share = n1 + n0, toxic / (toxic + clean)

    def part(k, expected):
        return F.when(k > 0, k * F.log(k / expected)).otherwise(F.lit(0.0))
    return 2 * (part(n1, n * share) + part(n0, n * (1 - share)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", target: str = "toxic",
          folds: int = 5, max_labelled: int = MAX_LABELLED) -> Model:
    """Lexicon and weights from at most ``max_labelled`` labelled rows outside the held-out fold."""
    sample = stored(labelled_sample(docs, labels, target, folds, max_labelled, id_col, text_col), "toxic-sample")
    share = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    model = Model(toxic=share.get(1, 0), clean=share.get(0, 0))
    if not model.toxic or not model.clean:
        return Model()
    words = cut(sample.select("y", "body").mapInArrow(_word_rows, "word string, y int")
                .groupBy("word").agg(F.sum("y").cast("int").alias("n1"), F.sum(1 - F.col("y")).cast("int").alias("n0")))
    strength = likelihood_ratio(F.col("n1"), F.col("n0"), model.toxic, model.clean)
    terms = (words.where((F.col("n1") >= MIN_TOXIC) & (F.length("word") >= 3) & (F.col("n1") * model.clean > F.col("n0") * model.toxic * 4))
             .withColumn("g", strength).where(F.col("g") >= MIN_LIKELIHOOD)
             .orderBy(F.desc("g"), "word").limit(MAX_TERMS).collect())
    model.counts = {r["word"]: (r["n1"], r["n0"]) for r in terms}
    forms = words.mapInArrow(_form_rows(list(model.counts)), words.schema).where("n1 + n0 >= 2").collect()
    model.forms = {r["word"]: (r["n1"], r["n0"]) for r in forms}  # a part of the bounded sample's words
    rows = sample.select("y", "body").mapInArrow(_feature_rows(model), "y int, x array<double>").toPandas()
    x, y = np.array(rows["x"].tolist()), rows["y"].to_numpy().astype(float)
    model.weights = logistic_fit(x, y, PRIOR, ridge=1.0)
    return model


def _feature_rows(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            x = [scorer.features(b.decode("utf-8", "replace"), y)
                 for y, b in zip(batch.column("y").to_pylist(), batch.column("body").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(x, pa.list_(pa.float64()))], names=["y", "x"])
    return run


def _score_rows(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            scores = [scorer.score(b.decode("utf-8", "replace")) for b in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores, pa.float64())], names=["id", "score"])
    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5,
                    max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per input row.

    The score depends on the text alone, so repeated rows have equal scores; null and empty texts get
    the score of a text without hits. Without training labels of both kinds all scores are 0. Rows without
    an id are never held out. An empty table gives an empty result.
    """
    model = train(docs, labels, id_col, text_col, folds=folds, max_labelled=max_labelled)
    out = text_rows(docs, id_col, text_col).mapInArrow(_score_rows(model), "id long, score double")
    return out.select(F.col("id").alias("doc_id"), F.coalesce(fold(F.col("id"), folds) == 0, F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
