"""Operator 2: license scan with a generalised suffix automaton over license templates.

The words of all templates make one automaton that accepts every run of words of any template. Documents are
streamed through it: at each word it gives, for every template, the longest run that ends there and is found in it
(the matching statistics; suffix links lead to the templates whose runs are shorter). Runs of ``min_run`` words or more
that cannot be extended in their template are chained per template, in the order of both sides, into spans; a span
counts when its runs cover at least ``min_cover`` of the template's words. A template that stands whole inside
another one is found besides it.
Phrases with labels of their own are found wherever their words stand consecutively.

Texts are read a megabyte at a time; what is carried is the automaton's state and the place, so a text of any
length needs the memory of a piece and of its matches. Documents are scanned where they are read: no shuffle.

Defined results: a null or empty text has no words, no labels and score 0; repeated rows are scanned each;
other columns are ignored.
"""

from __future__ import annotations

import functools
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import batches, id_and_text, texts_of

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Opening or granting passages of public license texts, by label.
TEMPLATES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
    "this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-release": "Released under the MIT License.",
    "apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
    'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
    "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
    "permissions and limitations under the License.",
    "apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
    "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "gpl-short": "under the terms of the GNU General Public License",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions "
    "and the following disclaimer.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}

MIN_RUN = 3
MIN_COVER = 0.6
PIECE_BYTES = 1 << 20
#: A-Z lower-cased, other ASCII but digits and letters turned into spaces
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

Span = tuple[str, int, int, float]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


class Automaton:
    """Suffix automaton of several word sequences; a state knows one end of its runs per template."""

    def __init__(self, templates: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[dict[int, list[int]]] = [{}]
        for t, words in enumerate(templates):
            last = 0
            for place, word in enumerate(words):
                last = self._extend(last, word)
                while len(ends) < len(self.next):
                    ends.append({})
                ends[last].setdefault(t, []).append(place)
        for s in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            for t, places in ends[s].items():
                into = ends[self.link[s]].setdefault(t, [])
                into += [p for p in places if p not in into]
        self.ends = ends

    def _new(self, length: int, link: int, arcs: dict[bytes, int]) -> int:
        self.next.append(arcs)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, word: bytes, target: int) -> int:
        """The state for the runs of ``target`` that extend ``p`` by ``word``."""
        if self.length[p] + 1 == self.length[target]:
            return target
        copy = self._new(self.length[p] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while p >= 0 and self.next[p].get(word) == target:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word])
        state = self._new(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = state
            p = self.link[p]
        if p >= 0:
            self.link[state] = self._split(p, word, self.next[p][word])
        return state

    def step(self, state: int, length: int, word: bytes) -> tuple[int, int]:
        """Longest run ending with ``word``, from the longest one before it."""
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        found = self.next[state].get(word)
        return (found, length + 1) if found is not None else (0, 0)


class Scanner:
    def __init__(self, templates: dict[str, str], phrases: dict[str, str], min_run: int, min_cover: float):
        self.labels = list(templates)
        sequences = [words_of(t.encode()) for t in templates.values()]
        self.sizes = [len(s) for s in sequences]
        self.automaton = Automaton(sequences)
        self.phrases = [(tuple(words_of(p.encode())), label) for p, label in phrases.items()]
        self.known = {w for s in sequences for w in s} | {w for p, _ in self.phrases for w in p}
        self.min_run, self.min_cover = min_run, min_cover
        self._held: dict[int, list[tuple[int, int, list[int]]]] = {}

    def _longest(self, state: int, length: int) -> dict[int, tuple[int, list[int]]]:
        """Per template: its longest run of ``min_run`` words or more that ends here, and where that ends in it."""
        if length < self.min_run:
            return {}
        link, lengths, ends = self.automaton.link, self.automaton.length, self.automaton.ends
        if state not in self._held:  # templates with shorter runs than the state's
            shorter, seen, s = [], set(ends[state]), link[state]
            while s > 0 and lengths[s] >= self.min_run:
                shorter += [(t, lengths[s], places) for t, places in ends[s].items() if t not in seen]
                seen.update(ends[s])
                s = link[s]
            self._held[state] = shorter
        found = {t: (length, places) for t, places in ends[state].items()}
        found.update((t, (n, places)) for t, n, places in self._held[state])
        return found

    def _phrases(self, run: list[bytes], at: int, found: list[tuple[int, str]]) -> None:
        for words, label in self.phrases:
            n = len(words)
            if words[0] in run:
                found += [(at + k, label) for k in range(len(run) - n + 1) if run[k] == words[0] and tuple(run[k : k + n]) == words]

    def _matches(self, run: list[bytes], at: int, found: dict[int, list[tuple[int, int, int]]]) -> None:
        """Per template: (place in the document, place in the template, length) of runs that cannot be extended in it."""
        step, state, length = self.automaton.step, 0, 0
        before: dict[int, tuple[int, list[int]]] = {}
        for k in range(len(run) + 1):
            state, length = step(state, length, run[k]) if k < len(run) else (0, 0)
            longest = self._longest(state, length)
            for t, (n, places) in before.items():
                if t not in longest or longest[t][0] <= n:  # the template's run before ends here
                    found[t] += [(at + k - n, p - n + 1, n) for p in places]
            before = longest

    def _chain(self, t: int, matches: list[tuple[int, int, int]]) -> list[Span]:
        """Spans of matches that go forward in the document and in the template, close enough to belong together."""
        size, spans = self.sizes[t], []
        chains: list[tuple[int, int, int, int]] = []  # end in the document, end in the template, start, words covered
        done: list[tuple[int, int, int, int]] = []
        for at, place, n in sorted(matches):
            far = at - 2 * size
            while chains and chains[0][0] < far:  # cannot be continued
                done.append(chains.pop(0))
            best = (at + n, place + n, at, n)
            for c in chains:
                if c[0] <= at and c[1] <= place and c[3] + n > best[3]:
                    best = (at + n, place + n, c[2], c[3] + n)
                elif c[1] - (c[0] - at) <= place and c[0] > at and c[0] < at + n and c[3] + at + n - c[0] > best[3]:  # overlap
                    best = (at + n, place + n, c[2], c[3] + at + n - c[0])
            k = bisect_left(chains, best)
            if not any(c[1] <= best[1] and c[3] >= best[3] and c[2] >= best[2] and c[0] == best[0] for c in chains[max(0, k - 1) : k + 1]):
                insort(chains, best)
        best_at: dict[int, tuple[int, int]] = {}
        for end, _, start, cover in done + chains:
            if cover >= self.min_cover * size and cover > best_at.get(start, (0, 0))[1]:
                best_at[start] = (end, cover)
        last = -1
        for start, (end, cover) in sorted(best_at.items()):
            if start >= last:
                spans.append((self.labels[t], start, end, min(1.0, cover / size)))
                last = end
        return spans

    def scan(self, text: bytes, piece_bytes: int = PIECE_BYTES) -> tuple[int, list[tuple[int, str]], list[Span]]:
        """Number of words, phrases as (place, label), spans as (label, first word, word after, cover)."""
        phrases: list[tuple[int, str]] = []
        matches: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        n, begin, size, known = 0, 0, len(text), self.known
        run: list[bytes] = []
        run_at = last = 0
        while begin < size:
            end = min(size, begin + piece_bytes)
            while end < size and TABLE[text[end]] != 0x20:
                end += 1
            words = words_of(text[begin:end])
            for k in [k for k, w in enumerate(words) if w in known]:
                at = n + k
                if at != last and run:
                    self._run(run, run_at, phrases, matches)
                    run = []
                if not run:
                    run_at = at
                run.append(words[k])
                last = at + 1
            n += len(words)
            begin = end
        if run:
            self._run(run, run_at, phrases, matches)
        spans = [s for t, m in sorted(matches.items()) for s in self._chain(t, m)]
        return n, phrases, spans

    def _run(self, run: list[bytes], at: int, phrases: list, matches: dict) -> None:
        """A run of words that templates or phrases know."""
        if len(run) > 1:
            self._phrases(run, at, phrases)
            if len(run) >= self.min_run:
                self._matches(run, at, matches)


@functools.lru_cache(maxsize=4)
def _scanner(templates: tuple, phrases: tuple, min_run: int, min_cover: float) -> Scanner:
    return Scanner(dict(templates), dict(phrases), min_run, min_cover)


SCANNED = (
    "doc_id long, n_words long, phrases array<struct<place: long, label: string>>, "
    "spans array<struct<label: string, first: long, after: long, cover: double>>"
)


def scan_licenses(
    df: DataFrame, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES, min_run: int = MIN_RUN,
    min_cover: float = MIN_COVER, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, phrases (place, label) and spans (label, first word, word after, covered part) of every text."""
    setting = tuple(templates.items()), tuple(phrases.items()), min_run, min_cover
    phrase = pa.struct([("place", pa.int64()), ("label", pa.string())])
    span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("after", pa.int64()), ("cover", pa.float64())])

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(*setting)
        found = [scanner.scan(t) for t in texts_of(batch)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([n for n, _, _ in found], pa.int64()),
                pa.array([[dict(zip(("place", "label"), p)) for p in ps] for _, ps, _ in found], pa.list_(phrase)),
                pa.array([[dict(zip(("label", "first", "after", "cover"), s)) for s in ss] for _, _, ss in found], pa.list_(span)),
            ],
            names=["doc_id", "n_words", "phrases", "spans"],
        )

    return id_and_text(df, id_col, text_col).mapInArrow(batches(each), SCANNED)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .common import documents

    found = scan_licenses(documents(spark, sf_dir))
    base, spans = F.col("phrases.label"), F.col("spans.label")
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min("phrases.place").alias("first_word"),
        F.array_max("phrases.place").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, spans)), ",").alias("labels"),
        F.when(F.size("phrases") > 0, 1.0).otherwise(F.coalesce(F.array_max("spans.cover"), F.lit(0.0))).alias("score"),
        "spans",
    )
