"""License scans with a generalised suffix automaton.

All license templates go into one automaton over their words. A text is read
through it once; after each word the automaton knows the longest stretch of
words up to here that stands in some template (the matching statistic). Long
stretches are chained per template, in text order and template order, and a
chain that covers enough of its template is a span with the template's label.
Short phrases, which must match whole, are templates of the same automaton.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelspark.llm.arrow import map_batches, utf8

#: Phrases that name a license, with their labels; these stand in any result.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

#: Well-known license texts and notices, with their labels.
TEMPLATES = [
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software."""),
    ("mit", "Released under the MIT License"),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution."""),
    ("apache-2", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("gpl", "licensed under the GNU General Public License, version 2"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("agpl", "licensed under the GNU Affero General Public License"),
    ("mpl-2", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy,
modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,
for any purpose, commercial or non-commercial, and by any means."""),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
]

_SEPARATORS = bytes(range(0x30)) + bytes(range(0x3A, 0x61)) + bytes(range(0x7B, 0x80))
_TO_WORDS = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
_TO_SPACE = bytes(
    0x20 if c in _SEPARATORS and not 0x41 <= c <= 0x5A else _TO_WORDS[c] for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words of ASCII letters, digits and all characters beyond ASCII."""
    return text.translate(_TO_SPACE).split()


class Automaton:
    """Suffix automaton of several word sequences; states know the templates they occur in."""

    def __init__(self, sequences: Iterable[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.places: list[dict[int, int]] = [{}]  # template to the last position of its first occurrence
        for number, words in enumerate(sequences):
            last = 0
            for at, word in enumerate(words):
                last = self._add(last, word)
                state = last
                while state > 0 and number not in self.places[state]:
                    self.places[state][number] = at
                    state = self.link[state]

    def _state(self, length: int, next_: dict[int, int], link: int, places: dict[int, int]) -> int:
        self.next.append(next_)
        self.link.append(link)
        self.length.append(length)
        self.places.append(places)
        return len(self.next) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A state of its own for the shorter strings of ``target``, reached from ``state``."""
        copy = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target], dict(self.places[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _add(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:  # read before, in another template
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        new = self._state(self.length[last] + 1, {}, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            self.link[new] = target if self.length[target] == self.length[state] + 1 else self._split(state, word, target)
        return new

    def read(self, words: Iterable[int]) -> list[tuple[int, int]]:
        """(state, matched length) after each word."""
        out, state, matched = [], 0, 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            state = self.next[state].get(word, 0)
            matched = matched + 1 if state else 0
            out.append((state, matched))
        return out


class Scanner:
    """Finds phrases and covered template spans in word lists.

    ``least``: words of a match that counts for a span. ``gap``: words of a text
    or template that may be missing between two matches of a chain. ``cover``:
    share of a template that a span must cover.
    """

    #: Repeated stretches of template words whose result is kept.
    KEPT = 100_000

    def __init__(self, phrases=PHRASES, templates=TEMPLATES, least: int = 5, gap: int = 12, cover: float = 0.6):
        self.least, self.gap, self.cover = least, gap, cover
        self.entries = [(label, words_of(text.encode()), True) for label, text in phrases]
        self.entries += [(label, words_of(text.encode()), False) for label, text in templates]
        self.ids: dict[bytes, int] = {}
        for _, words, _ in self.entries:
            for word in words:
                self.ids.setdefault(word, len(self.ids))
        self.automaton = Automaton([[self.ids[w] for w in words] for _, words, _ in self.entries])
        self.shortest = min([len(words) for _, words, exact in self.entries if exact] + [least])
        self.kept: dict[tuple, tuple] = {}

    def matches(self, run: tuple[int, ...]) -> tuple[list, list]:
        """Whole phrases (entry, start) and maximal matches (entry, start, length, template start) of a run of template words."""
        if run in self.kept:
            return self.kept[run]
        stats, phrases, found = self.automaton.read(run), [], []
        for end, (state, matched) in enumerate(stats):
            above = state
            while above > 0:  # every phrase that ends here is a suffix of what matched
                for entry, at in self.automaton.places[above].items():
                    _, words, exact = self.entries[entry]
                    if exact and at == len(words) - 1 and self.automaton.length[self.automaton.link[above]] < len(words) <= min(
                        matched, self.automaton.length[above]
                    ):
                        phrases.append((entry, end - len(words) + 1))
                above = self.automaton.link[above]
            longest_here = end + 1 == len(stats) or stats[end + 1][1] <= matched
            if matched >= self.least and longest_here:
                found += [
                    (entry, end - matched + 1, matched, at - matched + 1)
                    for entry, at in self.automaton.places[state].items()
                    if not self.entries[entry][2]
                ]
        if len(self.kept) >= self.KEPT:
            self.kept.clear()
        self.kept[run] = phrases, found
        return phrases, found

    def chains(self, found: list) -> list[tuple[int, int, int, float]]:
        """(entry, start, end, covered share) of matches chained per template."""
        out, open_ = [], {}
        for entry, start, length, at in sorted(found, key=lambda m: (m[1], m[0])):
            chain = open_.get(entry)
            if chain and start - chain[1] <= self.gap and 0 <= at - chain[3] <= self.gap:
                chain[1], chain[2], chain[3] = start + length, chain[2] + length, at + length
            else:
                if chain:
                    out.append((entry, chain))
                open_[entry] = [start, start + length, length, at + length]
        out += open_.items()
        return [(entry, c[0], c[1], min(1.0, c[2] / len(self.entries[entry][1]))) for entry, c in out]

    def scan(self, text: bytes) -> dict:
        words, get = words_of(text), self.ids.get
        ids = np.array([get(w, -1) for w in words], dtype=np.int32)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], (ids >= 0).astype(np.int8), [0]])))
        phrases, found = [], []
        for start, end in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if end - start < self.shortest:
                continue
            p, f = self.matches(tuple(ids[start:end].tolist()))
            phrases += [(entry, start + at) for entry, at in p]
            found += [(entry, start + at, length, place) for entry, at, length, place in f]
        spans = self.chains(found)
        best = max([s[3] for s in spans], default=0.0)
        return {
            "n_words": len(words),
            "places": [{"label": self.entries[e][0], "start": s} for e, s in sorted(phrases, key=lambda x: (x[1], x[0]))],
            "spans": [
                {"label": self.entries[e][0], "start": s, "end": t, "cover": c} for e, s, t, c in spans if c >= self.cover
            ],
            "score": 1.0 if phrases else best,
        }


PLACE = "array<struct<label:string,start:bigint>>"
SPAN = "array<struct<label:string,start:bigint,end:bigint,cover:double>>"


def scan(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, n_words, places, spans, score of every row of ``docs`` (doc_id, text, ...); ``settings`` as for Scanner.

    ``places``: whole phrases, all of them, overlapping ones too; ``start`` counts
    words from 0. ``spans``: covered template spans. ``score``: 1 with a phrase,
    else the largest covered share of a template. Null text is empty: no words,
    score 0. Repeated rows are scanned alike; other columns are ignored.
    """
    ready: list[Scanner] = []

    def each(batch):
        if not ready:
            ready.append(Scanner(**settings))
        done = [ready[0].scan(text) for text in utf8(batch.column("text"))]
        return {"doc_id": batch.column("doc_id")} | {k: [d[k] for d in done] for k in ("n_words", "places", "spans", "score")}

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(narrow, f"doc_id bigint, n_words bigint, places {PLACE}, spans {SPAN}, score double", each)
