"""Licence scan: a generalised suffix automaton over the words of licence texts.

The automaton accepts every run of words that stands in some template. Reading a document word by word
gives at each word the longest run that ends there and stands in a template (its matching statistics).
Runs that cannot be extended are matches; matches of one template that lie in the same order
there and in the document, with small gaps, are chained, and a chain that covers enough of its template
is a span of that licence. The automaton is built once from the templates, a few thousand words,
and each document is read once, from its first word to its last.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from limnospark.llm.shared import documents

# Phrases that name a licence, and the label of each.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# The notices that the licences ask to be placed in files, by label.
TEMPLATES = {
    "apache": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution.""",
    "cc-by": """This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of
this license, visit http://creativecommons.org/licenses/by/4.0/""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You
should have received a copy of the GNU General Public License along with this program.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
notice shall be included in all copies or substantial portions of the Software.""",
    "mpl": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}

# ASCII letters in lower case, digits, and blanks for all other ASCII characters; bytes of others stay.
_FOLD = bytes(
    b if b > 127 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256)
)
RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<label:string,first:long,last:long,covered:double>>"
)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


class Automaton:
    """Generalised suffix automaton of several word sequences; words are small integers.

    A state stands for runs of words with the same ends in the templates. `runs[s]` is the longest one's
    length, `shorter[s]` the state of its longest suffix with other ends, `ends[s]` one place (template,
    position) where its runs end, `whole[s]` the templates that are themselves a run of the state.
    """

    def __init__(self, sequences: Iterable[list[int]]):
        self.steps: list[dict[int, int]] = [{}]
        self.shorter, self.runs = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]
        self.whole: list[list[int]] = [[]]
        sequences = list(sequences)
        for sequence in sequences:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        for number, sequence in enumerate(sequences):
            state = 0
            for position, word in enumerate(sequence):
                state = self.steps[state][word]
                up = state
                while up > 0:  # every suffix that ends here; short templates keep these lists short
                    self.ends[up].append((number, position))
                    up = self.shorter[up]
            while state > 0 and self.runs[self.shorter[state]] >= len(sequence):
                state = self.shorter[state]
            if sequence:
                self.whole[state].append(number)

    def _state(self, run: int, steps: dict[int, int], shorter: int) -> int:
        self.steps.append(steps)
        self.runs.append(run)
        self.shorter.append(shorter)
        self.ends.append([])
        self.whole.append([])
        return len(self.runs) - 1

    def _split(self, parent: int, word: int) -> int:
        """The state for the run of `parent` and `word`, set apart from longer runs if need be."""
        found = self.steps[parent][word]
        if self.runs[found] == self.runs[parent] + 1:
            return found
        copy = self._state(self.runs[parent] + 1, dict(self.steps[found]), self.shorter[found])
        self.shorter[found] = copy
        while parent >= 0 and self.steps[parent].get(word) == found:
            self.steps[parent][word] = copy
            parent = self.shorter[parent]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.steps[last]:
            return self._split(last, word)
        new = self._state(self.runs[last] + 1, {}, 0)
        parent = last
        while parent >= 0 and word not in self.steps[parent]:
            self.steps[parent][word] = new
            parent = self.shorter[parent]
        if parent >= 0:
            self.shorter[new] = self._split(parent, word)
        return new

    def statistics(self, words: Iterable[int]) -> Iterator[tuple[int, int]]:
        """For each word the state and the length of the longest run that ends there."""
        state = run = 0
        for word in words:
            while state and word not in self.steps[state]:
                state = self.shorter[state]
                run = self.runs[state]
            state = self.steps[state].get(word, 0)
            run = run + 1 if state else 0
            yield state, run


class Scanner:
    """Templates, phrases and the rules for spans.

    least_match: words of a match that counts. gap: words that may lie between two matches of a chain, in the
    document and in the template. covered: share of its template that a span's matches make up.
    """

    def __init__(self, templates: Mapping[str, str] = TEMPLATES, phrases: Mapping[str, str] = PHRASES,
                 least_match: int = 4, gap: int = 6, covered: float = 0.3):
        self.least_match, self.gap, self.covered = least_match, gap, covered
        texts = [*phrases, *templates.values()]
        self.labels = [*phrases.values(), *templates]
        self.n_phrases = len(phrases)
        sequences = [words_of(text) for text in texts]
        self.sizes = [len(s) for s in sequences]
        self.numbers = {word: i for i, word in enumerate(dict.fromkeys(w for s in sequences for w in s))}
        numbered = [[self.numbers[w] for w in s] for s in sequences]
        self.automaton = Automaton(numbered)
        self.pairs = np.zeros((len(self.numbers) + 1,) * 2, bool)  # which words follow each other in a template
        for s in numbered:
            self.pairs[s[:-1], s[1:]] = True
        self.single = any(size == 1 for size in self.sizes[: self.n_phrases])

    def scan(self, text: str) -> tuple:
        words = words_of(text)
        get, unknown = self.numbers.get, len(self.numbers)
        numbers = np.fromiter((get(w, unknown) for w in words), np.int32, len(words))
        base: list[tuple[int, int]] = []
        matches: list[tuple[int, int, int, int]] = []
        for first, last in self._stretches(numbers):
            self._read(first, numbers[first:last].tolist(), base, matches)
        spans = self._chains(matches)
        places = sorted({start for start, _ in base})
        base_labels = sorted({self.labels[t] for _, t in base})
        labels = sorted({*base_labels, *(s["label"] for s in spans)})
        score = 1.0 if base else max((s["covered"] for s in spans), default=0.0)
        return (len(words), len(base), places[0] if places else None, places[-1] if places else None,
                ",".join(base_labels), ",".join(labels), score, spans)

    def _stretches(self, numbers: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches of words that follow each other in some template; between them no run is longer
        than a word, so the automaton starts anew at each."""
        if self.single:
            yield 0, len(numbers)
            return
        linked = self.pairs[numbers[:-1], numbers[1:]]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], linked, [False]]).astype(np.int8)))
        for first, last in edges.reshape(-1, 2).tolist():
            yield first, last + 1

    def _read(self, first: int, words: list[int], base: list, matches: list) -> None:
        automaton, before = self.automaton, (0, 0)
        for i, (state, run) in enumerate(automaton.statistics(words)):
            if run <= before[1] and before[1] >= self.least_match:  # the run before could not be extended
                self._match(first + i, *before, matches)
            before = state, run
            up = state
            while up > 0:
                for t in automaton.whole[up]:
                    if t < self.n_phrases and self.sizes[t] <= run:
                        base.append((first + i + 1 - self.sizes[t], t))
                up = automaton.shorter[up]
        if before[1] >= self.least_match:
            self._match(first + len(words), *before, matches)

    def _match(self, after: int, state: int, run: int, matches: list) -> None:
        for t, position in self.automaton.ends[state]:
            if t >= self.n_phrases:
                matches.append((t, after - run, position + 1 - run, run))

    def _chains(self, matches: list[tuple[int, int, int, int]]) -> list[dict]:
        """Covered spans: matches of a template chained in order, each chain's coverage as large as can be."""
        spans, by_template = [], {}
        for t, at, position, run in sorted(set(matches)):
            by_template.setdefault(t, []).append((at, position, run))
        for t, found in by_template.items():
            chains: list[list] = []  # first, next word, next position, words covered
            for at, position, run in found:
                best = None
                for chain in reversed(chains):
                    if at - chain[1] > self.gap + self.sizes[t]:
                        break  # chains begin in the order of their matches
                    shift = max(chain[1] - at, chain[2] - position, 0)
                    near = at + shift - chain[1] <= self.gap and position + shift - chain[2] <= self.gap
                    if shift < run and near and (best is None or chain[3] > best[0][3]):
                        best = chain, shift
                if best:
                    chain, shift = best
                    chains.append([chain[0], at + run, position + run, chain[3] + run - shift])
                else:
                    chains.append([at, at + run, position + run, run])
            wide = {}
            for first, after, _, covered in chains:
                if covered >= self.covered * self.sizes[t] and covered > wide.get(first, (0, 0))[1]:
                    wide[first] = after, covered
            spans += [{"label": self.labels[t], "first": first, "last": after - 1, "covered": covered / self.sizes[t]}
                      for first, (after, covered) in wide.items()]
        return sorted(spans, key=lambda s: (s["first"], s["label"], s["last"]))


def scan_licenses(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """One row for each document: its words, the places and labels of the phrases, all labels, the spans.

    Words count from 0. `score` is 1 where a phrase stands, else the largest covered share of a template.
    Null and empty texts have no words, no labels (empty strings) and score 0; null doc_ids and repeated
    rows are kept as they are; an empty table has no rows.
    """
    scanner = scanner or Scanner()
    names = [field.split()[0] for field in RESULT.split(", ")[:8]] + ["spans"]
    kind = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("covered", pa.float64())]))
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scanner.scan(text.as_py()) for text in batch["text"]]
            columns = list(zip(*rows)) if rows else [[] for _ in names[1:]]
            yield pa.record_batch([batch["doc_id"], *(pa.array(c, k) for c, k in zip(columns, types[1:]))], names=names)

    return documents(docs).mapInArrow(run, RESULT)
