"""Operator 6, licence scans: a generalised suffix automaton of licence tokens.

The automaton holds every run of words of all templates. A text is streamed through it word by word, which
gives its matching statistics: the length and state of the longest run of template words that ends at each
word. Runs that cannot be extended (maximal matches) of at least ``MIN_RUN`` words are placed in their
templates and chained in order, over small gaps on either side, into covered spans; a template is
reported at every place where a chain covers enough of it and overlaps no better one of the same template. Base phrases are read off the same statistics: a phrase stands
where the match is at least as long and its state lies under the phrase's in the tree of suffix links.
"""

from __future__ import annotations

from bisect import bisect
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from shopstream.llm.common import ALNUM, text_rows

MIN_RUN = 3     # words of the shortest run that is chained
MAX_GAP = 8     # words that two chained runs may lie apart, in the text and in the template
COVERAGE = 0.75  # share of a template's words that a chain must cover

# fixed values: the base phrases and their labels
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# fixed values: public licence notices, by label
TEMPLATES = {
    "apache-2.0": [
        "licensed under the apache license version 2.0",
        "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license"
        " you may obtain a copy of the license at",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following"
        " conditions are met",
        "released under the bsd license",
    ],
    "cc-by-4.0": ["licensed under cc by 4.0", "licensed under a creative commons attribution 4.0 international license"],
    "cc-by-nc-4.0": ["licensed under cc by nc 4.0", "licensed under a creative commons attribution noncommercial 4.0 international license"],
    "cc-by-sa-4.0": ["licensed under cc by sa 4.0", "licensed under a creative commons attribution sharealike 4.0 international license"],
    "gpl-2.0": ["licensed under the gnu general public license version 2"],
    "gpl-3.0": [
        "this work is licensed under the gnu general public license version 3",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software"
        " foundation either version 3 of the license or at your option any later version",
    ],
    "lgpl": ["licensed under the gnu lesser general public license"],
    "mit": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"
        " the software to deal in the software without restriction",
    ],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2.0"],
    "public-domain": ["this work is dedicated to the public domain", "released into the public domain"],
}


def words_of(body: bytes) -> list[bytes]:
    """A-Z lower-cased; split at ASCII characters other than letters and digits."""
    return body.translate(ALNUM).split()


class Automaton:
    """Generalised suffix automaton of word sequences, with the places each state stands for."""

    def __init__(self, sequences: list[list[bytes]]):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]  # (sequence, last word's place) of the state itself
        for number, words in enumerate(sequences):
            last = 0
            for place, w in enumerate(words):
                last = self._extend(last, w)
                self.ends[last].append((number, place))
        self.words = frozenset(self.next[0])
        self.places: list[list[tuple[int, int]]] = [list(e) for e in self.ends]
        for v in sorted(range(1, len(self.link)), key=lambda v: -self.length[v]):
            self.places[self.link[v]] += self.places[v]
        self.places[0] = []

    def _state(self, length: int, link: int, nexts: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(nexts)
        self.ends.append([])
        return len(self.length) - 1

    def _split(self, p: int, w: bytes, q: int) -> int:
        """State for the runs of q that are one word longer than those of p."""
        if self.length[p] + 1 == self.length[q]:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: bytes) -> int:
        if w in self.next[last]:
            return self._split(last, w, self.next[last][w])
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, w, self.next[p][w])
        return new

    def find(self, words: list[bytes]) -> int | None:
        v = 0
        for w in words:
            if (v := self.next[v].get(w)) is None:
                return None
        return v


class Scanner:
    def __init__(self, phrases: dict[str, str], templates: dict[str, list[str]]):
        self.phrases = [(words_of(p.encode()), label) for p, label in phrases.items()]
        self.templates = [(words_of(t.encode()), label) for label, texts in templates.items() for t in texts]
        auto = self.auto = Automaton([w for w, _ in self.phrases + self.templates])
        # phrases at each state: (length, label) of those that are a run of the state or of its suffix links
        own = defaultdict(list)
        for words, label in self.phrases:
            own[auto.find(words)].append((len(words), label))
        self.at: list[tuple] = [()] * len(auto.link)
        for v in sorted(range(1, len(auto.link)), key=lambda v: auto.length[v]):
            self.at[v] = (*own.get(v, ()), *self.at[auto.link[v]])

    def scan(self, words: list[bytes]) -> tuple[list, list]:
        """Places (start, label) of the base phrases, and maximal matches (start, end, state)."""
        auto, at = self.auto, self.at
        nexts, link, length, known = auto.next, auto.link, auto.length, auto.words
        bases, runs = [], []
        v = n = 0
        before = -2
        for i, w in enumerate(words):
            if w not in known:
                continue
            if i != before + 1:
                if n >= MIN_RUN:
                    runs.append((before - n + 1, before + 1, v))
                v = n = 0
            elif w not in nexts[v] and n >= MIN_RUN:
                runs.append((i - n, i, v))
            before = i
            while w not in nexts[v]:
                v = link[v]
                n = length[v]
            v = nexts[v][w]
            n += 1
            if at[v]:
                bases += [(i - size + 1, label) for size, label in at[v] if size <= n]
        if n >= MIN_RUN:
            runs.append((before - n + 1, before + 1, v))
        return bases, runs

    @staticmethod
    def _chained(matches: list) -> list[tuple[int, int, int, int]]:
        """The best chain that ends with each match: (covered words, start, end, end in the template)."""
        out, chains = [], []
        for s, e, ts, te in matches:
            top = (te - ts, s, e, te)
            chains = [c for c in chains if c[2] + MAX_GAP >= s]  # no later match can reach the others
            for covered, cs, ce, cte in chains:
                skip = max(0, ce - s, cte - ts)  # words that the chain has already
                if skip < e - s and s + skip - ce <= MAX_GAP and ts + skip - cte <= MAX_GAP and s >= cs:
                    top = max(top, (covered + te - ts - skip, cs, e, te), key=lambda c: c[:2])  # of equal ones the shortest
            chains.append(top)
            out.append(top)
        return out

    def chains(self, runs: list) -> list[tuple[str, int, int, float]]:
        """(label, start, end, coverage) of each template's chains that cover enough and overlap no better one of the template."""
        placed = defaultdict(list)
        for start, end, v in runs:
            for number, last in self.auto.places[v]:
                placed[number].append((start, end, last - (end - start) + 1, last + 1))
        found = []
        base = len(self.phrases)
        for number, matches in placed.items():
            if number < base:
                continue
            words, label = self.templates[number - base]
            parts = [sorted(set(matches))]
            while parts:  # what lies between the chains taken is chained anew, without the words of those
                later = []
                for part in parts:
                    taken: list[tuple[int, int]] = []
                    enough = [c for c in self._chained(part) if c[0] / len(words) >= COVERAGE]
                    for covered, s, e, _ in sorted(enough, key=lambda c: (-c[0], c[2] - c[1], c[1])):
                        at = bisect(taken, (s, e))
                        if (at == 0 or taken[at - 1][1] <= s) and (at == len(taken) or taken[at][0] >= e):
                            taken.insert(at, (s, e))
                            found.append((label, s, e, covered / len(words)))
                    between = defaultdict(list)
                    for m in part if taken else ():
                        at = bisect(taken, m[0], key=lambda t: t[0])
                        if (at == 0 or taken[at - 1][1] <= m[0]) and (at == len(taken) or taken[at][0] >= m[1]):
                            between[at].append(m)
                    later += between.values()
                parts = later
        return found

    def result(self, body: bytes) -> dict:
        words = words_of(body)
        bases, runs = self.scan(words)
        spans = self.chains(runs) if runs else []
        base_labels = sorted({label for _, label in bases})
        return {
            "n_words": len(words), "n_base": len(bases),
            "first_word": min((s for s, _ in bases), default=None), "last_word": max((s for s, _ in bases), default=None),
            "base_labels": ",".join(base_labels), "labels": ",".join(sorted({*base_labels, *(s[0] for s in spans)})),
            "score": 1.0 if bases else max((c for *_, c in spans), default=0.0),
            "spans": [{"label": a, "first": s, "last": e - 1, "coverage": c} for a, s, e, c in sorted(spans)],
        }


RESULT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
          "spans array<struct<label:string, first:long, last:long, coverage:double>>")
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("coverage", pa.float64())])))])


def _scan_rows(phrases: dict, templates: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, templates)
        for batch in batches:
            rows = [{"doc_id": i, **scanner.result(b)} for i, b in zip(batch.column("id").to_pylist(), batch.column("body").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pylist(rows, _ARROW)
    return run


def scan_licenses(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, list[str]] | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans``.

    ``n_base`` counts every place where the words of a base phrase stand consecutively, ``first_word`` and ``last_word`` are
    the smallest and largest start (null without one). ``labels`` adds those of covered templates, whose ``spans`` (words, from
    0) are listed, one for each place a notice stands. ``score``: 1 with a base phrase, else the best coverage of a reported template, else 0. A null or empty text has
    no words; repeated rows and rows without an id are scanned each. An empty table gives an empty result.
    """
    run = _scan_rows(PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates)
    return text_rows(docs, id_col, text_col).mapInArrow(run, RESULT)
