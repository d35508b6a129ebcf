"""License scans: a generalised suffix automaton of the tokens of licence templates.

Files are streamed through the automaton; at each token it gives the longest suffix that some template has (the matching
statistic), and its suffix links give the longest one of every template, at every place there. Matches of MIN_MATCH tokens or more are
chained for each template: the chain ascends in the file and the template and covers the greatest weight of the template's tokens, where a token
that templates of n labels have weighs 1 / n. A template gives its label when LEAST of its weight is covered and what tells it from
templates of other labels is there: all tokens of a template of up to SHORT tokens; of a longer one those that a template of another label,
which would cover LEAST of it, lacks. Tokens that no template has can't be in a match, so only the runs between them are streamed. Phrases of
the base rule give labels of their own.

Words: A-Z lowered, then `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`. Edge cases: a null text counts as empty and has no words and score 0;
repeated rows are scanned each; of equally good chains the shortest in the file is told, then the first; a text of any length is scanned whole
(a chain costs its matched tokens times their logarithm); an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import functools
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quern.llm import textops
from quern.llm.storage import table

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
MIN_MATCH = 3
LEAST = 0.6
SHORT = 16

#: Wordings of public licences and of notices that name them. label, then texts of which each is a template.
TEMPLATES: list[tuple[str, str]] = [
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software."""),
    ("warranty-disclaimer", """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "SPDX-License-Identifier: Apache-2.0"),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is
distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR
A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation"""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in
the documentation and/or other materials provided with the distribution."""),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause"),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
that the above copyright notice and this permission notice appear in all copies."""),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with
this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means."""),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
]


def tokens(text: str) -> list[str]:
    """The words of a text, plainly; what the vectorised path must agree with."""
    data = text.translate({c: c + 32 for c in range(65, 91)})
    out, word = [], ""
    for c in data + " ":
        if "0" <= c <= "9" or "a" <= c <= "z" or ord(c) > 127:
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


class SuffixAutomaton:
    """Generalised over several sequences. A state knows all places (sequence, last position) where its strings end."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for which, sequence in enumerate(sequences):
            last = 0
            for at, token in enumerate(sequence):
                last = self._extend(last, token)
                self.ends[last].add((which, at))
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            if self.link[state]:
                self.ends[self.link[state]] |= self.ends[state]

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        self.ends.append(set())
        return len(self.link) - 1

    def _split(self, p: int, token: int) -> int:
        """The state that token leads to from p, for strings of length(p) + 1 only."""
        q = self.next[p][token]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:
            return self._split(last, token)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        self.link[new] = self._split(p, token) if p >= 0 else 0
        return new

    def stream(self, sequence):
        """(matched length, state) at each token: the longest suffix of what has come that is in some sequence."""
        state = matched = 0
        for token in sequence:
            while state and token not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if token in self.next[state]:
                state, matched = self.next[state][token], matched + 1
            yield matched, state


class Chain(NamedTuple):
    """Share of a template's weight, start and end in the file, positions of the template."""

    share: float
    start: int
    end: int
    covered: set[int]


class Scanner:
    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES):
        self.labels = [label for label, _ in templates]
        words = [tokens(text) for _, text in templates]
        vocabulary = sorted({w for t in words for w in t} | {w for p in PHRASES for w in p.split()})
        self.word_bytes = [w.encode() for w in vocabulary]
        number = {w: k for k, w in enumerate(vocabulary)}
        self.sizes = [len(t) for t in words]
        sequences = [[number[w] for w in t] for t in words]
        self.automaton = SuffixAutomaton(sequences)
        joined = " ".join(vocabulary).encode()
        data = np.frombuffer(joined, dtype=np.uint8)
        found = textops.Words(data, np.array([0, len(data)]), textops.ALNUM_WORDS)
        hashes = found.hashes()
        self._order = np.argsort(hashes)
        self._sorted = hashes[self._order]
        self.phrases = [([number[w] for w in p.split()], label) for p, label in PHRASES.items()]
        of: dict[str, set] = {}
        for label, t in zip(self.labels, words, strict=True):
            for w in t:
                of.setdefault(w, set()).add(label)
        self.weights = [[1 / len(of[w]) for w in t] for t in words]
        self.required: list[list[set[int]]] = []
        for which, size in enumerate(self.sizes):
            self.required.append([set(range(size))] if size <= SHORT else self._telling(which, sequences))

    def _telling(self, which: int, sequences: list[list[int]]) -> list[set[int]]:
        """Positions of a template that others, of which each would cover LEAST of it, lack."""
        out = []
        for other, sequence in enumerate(sequences):
            if self.labels[other] != self.labels[which]:
                found = self.spans(sequence).get(which)
                if found:
                    chain = self.chain(which, found)
                    if chain.share >= LEAST:
                        out.append(set(range(self.sizes[which])) - chain.covered)
        return out

    def numbers(self, words: textops.Words) -> np.ndarray:
        """The vocabulary's number of each word by its hash, or -1. Words in matches are confirmed on their bytes."""
        h = words.hashes()
        at = np.minimum(np.searchsorted(self._sorted, h), len(self._sorted) - 1)
        return np.where(self._sorted[at] == h, self._order[at], -1)

    def _places(self, matched: int, state: int) -> dict[tuple[int, int], int]:
        """For all places (template, last position) with MIN_MATCH tokens in common or more: how many, from the longest suffix on."""
        out: dict[tuple[int, int], int] = {}
        while state > 0 and matched >= MIN_MATCH:
            for place in self.automaton.ends[state]:
                out.setdefault(place, matched)
            state = self.automaton.link[state]
            matched = self.automaton.length[state]
        return out

    def spans(self, sequence: list[int]) -> dict[int, list[tuple[int, int, int]]]:
        """By template: all maximal matches of MIN_MATCH or more tokens as (start in the file, start in the template, length)."""
        out: dict[int, list[tuple[int, int, int]]] = {}
        before: dict[tuple[int, int], int] = {}
        for i, (matched, state) in enumerate([*self.automaton.stream(sequence), (0, 0)]):
            now = self._places(matched, state) if matched >= MIN_MATCH else {}
            for (which, end), n in before.items():
                if now.get((which, end + 1)) != n + 1:
                    out.setdefault(which, []).append((i - n, end - n + 1, n))
            before = now
        return out

    def chain(self, which: int, matches: list[tuple[int, int, int]]) -> Chain:
        """The heaviest ascending chain of tokens that stand in matches."""
        points = sorted({(a + k, -(t + k)) for a, t, n in matches for k in range(n)})
        weight, size = self.weights[which], self.sizes[which]
        tree: list[tuple] = [(0.0, 0, -1)] * (size + 1)  # by ends of prefixes: (weight, start in the file, point) of the best chain
        before = []
        best = (0.0, 0, -1)
        for k, (i, t) in enumerate(points):
            t, top, at = -t, (0.0, i, -1), -t
            while at > 0:  # chains that end before t
                if tree[at][0] > top[0] or (tree[at][0] == top[0] and tree[at][2] >= 0 and tree[at][1] > top[1]):
                    top = tree[at]
                at &= at - 1
            before.append(top[2])
            mine = (top[0] + weight[t], top[1], k)
            if mine[0] > best[0] + 1e-9 or (mine[0] > best[0] - 1e-9 and best[2] >= 0 and i - mine[1] < points[best[2]][0] - best[1]):
                best = mine
            at = t + 1
            while at <= size:
                if mine[0] > tree[at][0] or (mine[0] == tree[at][0] and mine[1] > tree[at][1]):
                    tree[at] = mine
                at += at & -at
        covered, k = set(), best[2]
        while k >= 0:
            covered.add(-points[k][1])
            k = before[k]
        return Chain(min(1.0, best[0] / sum(weight)), best[1], points[best[2]][0] + 1 if points else 0, covered)

    def found(self, which: int, chain: Chain) -> bool:
        """Whether the chain gives the template's label."""
        return chain.share >= LEAST and all(len(chain.covered & t) >= (len(t) if len(t) <= SHORT else LEAST * len(t)) for t in self.required[which])


@functools.cache
def default_scanner() -> Scanner:
    return Scanner()


def _runs(numbers: np.ndarray, doc: np.ndarray) -> list[tuple[int, int]]:
    """Runs of MIN_MATCH or more known words within a text."""
    known = numbers >= 0
    edge = np.ones(len(known) + 1, dtype=bool)
    edge[1:-1] = (known[1:] != known[:-1]) | (doc[1:] != doc[:-1])
    cuts = np.flatnonzero(edge)
    long = (np.diff(cuts) >= MIN_MATCH) & known[cuts[:-1]]
    return list(zip(cuts[:-1][long].tolist(), cuts[1:][long].tolist(), strict=True))


def _scan(batches):
    scanner = default_scanner()
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.string()]
    for batch in batches:
        for part in textops.pieces(batch):
            data, offsets = textops.bytes_of(textops.texts_of(part.column("text")))
            words = textops.Words(textops.LOWER[data], offsets, textops.ALNUM_WORDS)
            numbers, n = scanner.numbers(words), len(offsets) - 1
            places: list[list[int]] = [[] for _ in range(n)]
            base: list[set] = [set() for _ in range(n)]
            for phrase, label in scanner.phrases:
                k = len(phrase)
                if len(numbers) < k:
                    continue
                hit = words.doc[: len(numbers) - k + 1] == words.doc[k - 1 :]
                for j, w in enumerate(phrase):
                    hit &= numbers[j : len(numbers) - k + 1 + j] == w
                for at in np.flatnonzero(hit):
                    if all(words.bytes_at(at + j) == scanner.word_bytes[w] for j, w in enumerate(phrase)):
                        d = int(words.doc[at])
                        places[d].append(int(at - words.first[d]))
                        base[d].add(label)
            matches: list[dict] = [{} for _ in range(n)]
            for a, b in _runs(numbers, words.doc):
                d = int(words.doc[a])
                run = numbers[a:b].tolist()
                here = scanner.spans(run)
                if here and any(words.bytes_at(a + k) != scanner.word_bytes[w] for k, w in enumerate(run)):  # equal hashes of other words
                    here = scanner.spans([w if words.bytes_at(a + k) == scanner.word_bytes[w] else -1 for k, w in enumerate(run)])
                for which, found in here.items():
                    shift = a - int(words.first[d])
                    matches[d].setdefault(which, []).extend((s + shift, t, m) for s, t, m in found)
            rows = []
            for d in range(n):
                chains = {w: scanner.chain(w, m) for w, m in matches[d].items()}
                told = {w: c for w, c in chains.items() if scanner.found(w, c)}
                labels = base[d] | {scanner.labels[w] for w in told}
                spans = sorted((c.start, c.end, scanner.labels[w]) for w, c in told.items())
                score = max([*(c.share for c in chains.values()), 1.0 if base[d] else 0.0], default=0.0)
                rows.append((int(words.first[d + 1] - words.first[d]), len(places[d]), min(places[d], default=None), max(places[d], default=None), ",".join(sorted(base[d])), ",".join(sorted(labels)), score, ",".join(f"{label}:{a}:{b}" for a, b, label in spans)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True))], names)


def scan(docs: DataFrame) -> DataFrame:
    """Licence labels, base phrases and covered template spans (in words) of docs (doc_id, text). No shuffle."""
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string"
    return docs.select("doc_id", "text").mapInArrow(_scan, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: licences in every whole text."""
    return scan(table(spark, sf_dir, "documents"))
