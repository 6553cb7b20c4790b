"""Licence scan by a generalised suffix automaton of licence words.

The automaton holds every run of words of all templates: well-known licence notices, and the short phrases that name a
licence (the base). A text streams through it word by word, which gives the matching statistics: the length of the longest
run of template words that ends at each word. From them come

- the *places* of the base phrases: a phrase ends at a word if it is among the endings of the state reached, and
- *long matches*, runs of at least ``LEAST`` words that cannot be made longer. They are chained for each template, in the
  order of text and template, over at most ``GAP`` other words of the text; a chain that covers at least ``COVERED`` of
  the template's words is a span of that licence.

The score is the largest covered share of a template, phrases included. Words that are in no template leave the automaton
at its root: numpy finds the words that are in one, and only these are visited. Texts are read in pieces of about ``CHUNK``
bytes that end between words, and state, word number and open chains are carried from piece to piece, so memory does not
grow with a text. Nothing is shuffled; the automaton, a few thousand states of fixed templates, goes to the tasks with the code.

Defined cases. Null, empty and blank texts have no words: zeros, nulls, empty labels and score 0. Places may overlap and all
count. Equal rows give equal results, ``doc_id`` may have any type, other columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docledger.llm import buffers
from docledger.llm.store import map_arrow
from docledger.llm.word_repeats import SuffixAutomaton

# Phrases whose places are reported, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices as their licences ask to state them, with SPDX names in lower case.
NOTICES = (
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to "
        "in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    (
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE."
    ),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so."
    ),
    (
        "bsd-3-clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer."
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies."
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("mit", "Released under the MIT License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
)

LEAST, GAP, COVERED = 3, 8, 0.6
CHUNK = 1 << 20

#: Bytes of words are digits, letters and everything beyond ASCII.
_SEPARATORS = np.ones(256, bool)
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _SEPARATORS[_a:_b] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_SPAN = ("label", "start", "end", "covered")
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text))


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return buffers.word_hashes(_LOWER[data], starts, ends)


class Templates:
    """The automaton of all templates, with what is needed at each state."""

    def __init__(self, phrases: dict[str, str], notices: tuple[tuple[str, str], ...]):
        texts = [*((words_of(p), label) for p, label in phrases.items()), *((words_of(t), label) for label, t in notices)]
        self.labels = [label for _, label in texts]
        self.sizes = [len(words) for words, _ in texts]
        self.n_phrases = len(phrases)
        vocabulary = sorted({w for words, _ in texts for w in words})
        data = [np.frombuffer(w.encode(), np.uint8) for w in vocabulary]
        hashes = np.array([_hashes(d, np.array([0]), np.array([len(d)]))[0] for d in data], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order
        number = {w: i for i, w in enumerate(vocabulary)}
        coded = [[number[w] for w in words] for words, _ in texts]
        self.automaton = SuffixAutomaton()
        for sequence in coded:
            self.automaton.add(sequence)
        states, links, lengths = len(self.automaton.link), self.automaton.link, self.automaton.length
        #: Occurrences (template, end) of the strings of a state; phrases that end with a state's strings.
        self.ends: list[list[tuple[int, int]]] = [[] for _ in range(states)]
        for template, sequence in enumerate(coded):
            state = 0
            for at, word in enumerate(sequence):
                state = self.automaton.next[state][word]
                if template >= self.n_phrases:
                    self.ends[state].append((template, at + 1))
        by_length = sorted(range(1, states), key=lengths.__getitem__)
        for state in reversed(by_length):
            if links[state] > 0:
                self.ends[links[state]] += self.ends[state]
        self.ends = [sorted(set(x)) for x in self.ends]
        self.phrases: list[list[tuple[int, int]]] = [[] for _ in range(states)]
        for phrase, sequence in enumerate(coded[: self.n_phrases]):
            state = 0
            for word in sequence:
                state = self.automaton.next[state][word]
            self.phrases[state].append((phrase, len(sequence)))
        for state in by_length:
            self.phrases[state] = self.phrases[links[state]] + self.phrases[state]

    def known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are in the vocabulary, and their ids."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        found = np.flatnonzero(self.hashes[at] == hashes)
        return found, self.ids[at[found]]


@dataclass
class Chain:
    """Long matches of one template in text order: a range of the text's words and what is covered of the template."""

    start: int
    end: int
    reached: int
    covered: int


@dataclass
class Scan:
    """What is known of a text so far."""

    least: int
    gap: int
    needed: float
    words: int = 0
    state: int = 0
    length: int = 0
    before: int = -1  # the last word that is in a template
    places: list[tuple[int, int]] = field(default_factory=lambda: [0, None, None])
    base: set[str] = field(default_factory=set)
    labels: set[str] = field(default_factory=set)
    chains: dict[int, Chain] = field(default_factory=dict)
    spans: list[tuple[str, int, int, float]] = field(default_factory=list)
    score: float = 0.0

    def match(self, t: Templates, end: int) -> None:
        """A longest match ends before word ``end``: it continues or starts chains of its templates.

        A match that cannot continue a chain starts a new one if it begins the template or is longer than what the chain
        covers; else it is a repetition inside the notice, and the chain stays open.
        """
        length, stops = self.length, defaultdict(list)
        for template, stop in t.ends[self.state]:
            stops[template].append(stop)
        for template, places in stops.items():
            chain = self.chains.get(template)
            if chain and end - length - chain.end <= self.gap:
                later = next((x for x in places if x > chain.reached), None)
                if later is not None:
                    chain.covered += min(later - chain.reached, length)  # matches may overlap
                    chain.reached, chain.end = later, end
                    continue
                if length not in places and length <= chain.covered:
                    continue
            self.close(t, template)
            self.chains[template] = Chain(end - length, end, places[0], length)

    def close(self, t: Templates, template: int) -> None:
        chain = self.chains.pop(template, None)
        if chain is None:
            return
        share = chain.covered / t.sizes[template]
        self.score = max(self.score, share)
        if share >= self.needed:
            self.labels.add(t.labels[template])
            self.spans.append((t.labels[template], chain.start, chain.end, share))

    def read(self, t: Templates, places: list[int], ids: list[int]) -> None:
        """Words of templates by number, and their ids."""
        edges, link, size = t.automaton.next, t.automaton.link, t.automaton.length
        for place, word in zip(places, ids, strict=True):
            if place != self.before + 1 and self.state:
                self.leave(t)
            state, length = self.state, self.length
            if word not in edges[state]:
                if length >= self.least:
                    self.match(t, place)
                while state and word not in edges[state]:
                    state = link[state]
                    length = size[state]
            self.state, self.length, self.before = edges[state][word], length + 1, place
            for phrase, n in t.phrases[self.state]:
                if n <= self.length:
                    first = place - n + 1
                    count, low, high = self.places
                    self.places = [count + 1, first if low is None else min(low, first), first if high is None else max(high, first)]
                    self.base.add(t.labels[phrase])
                    self.spans.append((t.labels[phrase], first, place + 1, 1.0))
                    self.score = 1.0

    def leave(self, t: Templates) -> None:
        if self.length >= self.least:
            self.match(t, self.before + 1)
        self.state = self.length = 0

    def finish(self, t: Templates) -> None:
        self.leave(t)
        for template in list(self.chains):
            self.close(t, template)


def _pieces(data: np.ndarray, offsets: np.ndarray, most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Groups of whole rows, and parts of long rows that end between words: first row, last row, offsets, bytes."""
    row = 0
    while row < len(offsets) - 1:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        at, end = int(offsets[row]), int(offsets[last])
        if end - at <= most:
            yield row, last, offsets[row : last + 1] - at, data[at:end]
            row = last
            continue
        while at < end:
            stop = at + most
            while stop < end and not _SEPARATORS[data[stop : min(stop + most, end)]].any():
                stop += most
            stop = stop + int(np.argmax(_SEPARATORS[data[stop : min(stop + most, end)]])) if stop < end else end
            yield row, row + 1, np.array([0, stop - at]), data[at:stop]
            at = stop
        row += 1


def scan_texts(t: Templates, column: pa.Array, least: int, gap: int, covered: float, chunk: int = CHUNK) -> list[Scan]:
    """One finished scan for each text."""
    data, offsets = buffers.text_bytes(column)
    scans = [Scan(least, gap, covered) for _ in range(len(offsets) - 1)]
    for first, last, at, part in _pieces(data, offsets, chunk):
        starts, ends, edges = buffers.word_spans(part, at, _SEPARATORS)
        found, ids = t.known(_hashes(part, starts, ends)) if len(starts) else (np.zeros(0, np.int64),) * 2
        bounds = np.searchsorted(found, edges)
        for i in range(first, last):
            scan, a, b = scans[i], *bounds[i - first : i - first + 2]
            if a < b:
                places = found[a:b] - edges[i - first] + scan.words
                scan.read(t, places.tolist(), ids[a:b].tolist())
            scan.words += int(edges[i - first + 1] - edges[i - first])
    for scan in scans:
        scan.finish(t)
    return scans


def scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    notices: tuple[tuple[str, str], ...] = NOTICES,
    least: int = LEAST,
    gap: int = GAP,
    covered: float = COVERED,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` and ``spans``, the
    places of phrases and licences as ranges of words with the covered share of their template."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(phrases, notices)
        for batch in batches:
            scans = scan_texts(templates, batch.column("text"), least, gap, covered)
            names = [",".join(sorted(x.base)) for x in scans], [",".join(sorted(x.base | x.labels)) for x in scans]
            spans = [[dict(zip(_SPAN, s, strict=True)) for s in sorted(x.spans, key=lambda s: (s[1], s[2], s[0]))] for x in scans]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([x.words for x in scans], pa.int64()),
                    *(pa.array([x.places[i] for x in scans], pa.int64()) for i in range(3)),
                    *(pa.array(x, pa.string()) for x in names),
                    pa.array([x.score for x in scans], pa.float64()),
                    pa.array(spans, pa.list_(pa.struct(list(zip(_SPAN, (pa.string(), pa.int64(), pa.int64(), pa.float64()), strict=True))))),
                ],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    kinds = f"doc_id {id_type}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return map_arrow(docs.select("doc_id", "text"), run, f"{kinds}, spans array<struct<label:string,start:long,end:long,covered:double>>")
