"""Licence scans: a generalised suffix automaton over the words of licence templates.

Words are runs of 0-9, a-z (A-Z lower-cased first) and characters from U+0080 on.
Streaming a text through the automaton gives, at each word, the longest run of words
ending there that some template contains (matching statistics). Only stretches whose
3-word windows all occur in templates can hold a match of three words or more, so the
automaton runs over those stretches of the whole text; they are found with numpy.

Matches of ``MIN_MATCH`` words or more are chained per template, in the order of text
and template, over gaps of at most ``MAX_GAP`` words, so that the words covered less ``GAP_COST`` for
each word of the text between matches are most. A chain is a candidate where it covers
``COVERAGE`` of the template's words and all its distinguishing words (in square brackets
below) within a match each. Candidates compete for the text: the one that covers most words
wins, then the one with fewer words between its matches, and those of other licences that lie
by half or more in its span are dropped. So a template that a longer licence contains, or whose
words another one shares but for its version, gives no label.

Base phrases are counted at all their places, and their labels never go away. ``read_templates``
makes templates of whole licence files, to be scanned for beside or instead of those here.

Defined results: a null or empty text has no words, no places, empty labels and score 0;
repeated rows are scanned as often as they occur; an empty table gives an empty result;
other columns are ignored. ``score`` is 1 if a base phrase stands in the text, else the
best coverage of a span that was found, else 0.
"""

from __future__ import annotations

import bisect
import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import stage, words

STRETCH = 128  # words of a text whose spans are looked at together
MIN_MATCH, MAX_GAP, COVERAGE, GAP_COST = 4, 12, 0.6, 0.25
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

#: Phrases that always count, and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

_PUBLISHED = "as published by the Free Software Foundation"
_REDISTRIBUTE = "you can redistribute it and/or modify it under the terms of the"
_BSD_OPENING = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
_BSD_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"
_BSD_BINARY = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"
_BSD_ADVERTS = "All advertising materials mentioning features or use of this software must display the following [acknowledgement]"
_BSD_NAMES = "[Neither the name of] the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"

#: Public licences and notices, as their authors word them; distinguishing words in square brackets.
NOTICES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "released under the [MIT License]"),
    ("mit", "licensed under the terms of the [MIT license]"),
    ("x11", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions. The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED. [Except as contained in this notice], the name of the copyright holder shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization"),
    ("apache-2", "Licensed under the Apache License, [Version 2].0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2", "licensed under the Apache License, [Version 2].0"),
    ("apache-1.1", "licensed under the Apache License, [Version 1.1]"),
    ("apache-1", "licensed under the Apache License, [Version 1.0]"),
    ("gpl-3", f"This program is free software: {_REDISTRIBUTE} GNU General Public License {_PUBLISHED}, either [version 3] of the License, or (at your option) any later version"),
    ("gpl-2", f"This program is free software; {_REDISTRIBUTE} GNU General Public License {_PUBLISHED}; either [version 2] of the License, or (at your option) any later version"),
    ("gpl-3", "licensed under the GNU General Public License, [version 3]"),
    ("gpl-2", "licensed under the GNU General Public License, [version 2]"),
    ("lgpl-3", f"This library is free software; {_REDISTRIBUTE} GNU [Lesser] General Public License {_PUBLISHED}; either [version 3] of the License, or (at your option) any later version"),
    ("lgpl-2.1", f"This library is free software; {_REDISTRIBUTE} GNU [Lesser] General Public License {_PUBLISHED}; either [version 2.1] of the License, or (at your option) any later version"),
    ("lgpl-3", "licensed under the GNU [Lesser] General Public License, [version 3]"),
    ("lgpl-2.1", "licensed under the GNU [Lesser] General Public License, [version 2.1]"),
    ("agpl-3", f"This program is free software: {_REDISTRIBUTE} GNU [Affero] General Public License {_PUBLISHED}, either [version 3] of the License, or (at your option) any later version"),
    ("agpl-3", "licensed under the GNU [Affero] General Public License, [version 3]"),
    ("bsd", _BSD_OPENING),
    ("bsd-2", f"{_BSD_OPENING}: {_BSD_SOURCE}. {_BSD_BINARY}."),
    ("bsd-3", f"{_BSD_OPENING}: {_BSD_SOURCE}. {_BSD_BINARY}. {_BSD_NAMES}."),
    ("bsd-4", f"{_BSD_OPENING}: {_BSD_SOURCE}. {_BSD_BINARY}. {_BSD_ADVERTS}. {_BSD_NAMES}."),
    ("isc", f"{_ISC_GRANT}, [provided that the above] copyright notice and this permission notice appear in all copies"),
    ("0bsd", f"{_ISC_GRANT}. [THE SOFTWARE IS] PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE"),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    ("bsl-1", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software"),
    ("bsl-1", "Distributed under the [Boost Software License], Version 1.0"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, [v. 2.0]"),
    ("mpl-1.1", "The contents of this file are subject to the Mozilla Public License [Version 1.1] (the License); you may not use this file except in compliance with the License"),
    ("epl-2", "This program and the accompanying materials are made available under the terms of the Eclipse Public License [2.0]"),
    ("epl-1", "This program and the accompanying materials are made available under the terms of the Eclipse Public License [v1.0]"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)


def _creative_commons() -> Iterator[tuple[str, str]]:
    """The notices of the six licences in their versions, by rule."""
    kinds = (("by", "Attribution"), ("by-sa", "Attribution-ShareAlike"), ("by-nc", "Attribution-NonCommercial"), ("by-nd", "Attribution-NoDerivatives"), ("by-nc-sa", "Attribution-NonCommercial-ShareAlike"), ("by-nc-nd", "Attribution-NonCommercial-NoDerivatives"))
    for version, place in (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic")):
        for kind, name in kinds:
            label = f"cc-{kind}-{version.removesuffix('.0')}"
            yield label, f"This work is licensed under a Creative Commons [{name} {version}] {place} License"
            yield label, f"Licensed under [CC {kind} {version}]"


def _gnu() -> Iterator[tuple[str, str]]:
    """What the notices of the GNU licences share, without their first words."""
    for label, name, version in (("gpl-2", "", "2"), ("gpl-3", "", "3"), ("lgpl-2.1", "[Lesser]", "2.1"), ("lgpl-3", "[Lesser]", "3"), ("agpl-3", "[Affero]", "3")):
        yield label, f"under the terms of the GNU {name} General Public License {_PUBLISHED}, either [version {version}] of the License"


TEMPLATES = (*NOTICES, *_creative_commons(), *_gnu())


def read_templates(spark: SparkSession, path: str) -> tuple[tuple[str, str], ...]:
    """Templates of the text files below ``path``, a folder of licences: the file's name without its ending, and its text."""
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.\w+)?$", 1).alias("label"), "value")
    return tuple(sorted((r.label, r.value.replace("[", " ").replace("]", " ")) for r in files.collect()))  # as many as there are licences


def _marked(template: str) -> tuple[list[str], list[tuple[int, int]]]:
    """The words of a template, and where its distinguishing words stand."""
    found: list[str] = []
    keys = []
    for i, part in enumerate(re.split(r"[\[\]]", template)):
        more = split(part)
        if i % 2:
            keys.append((len(found), len(found) + len(more)))
        found += more
    return found, keys


def split(text: str) -> list[str]:
    return _WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))


@dataclass
class _State:
    length: int
    link: int
    step: dict[int, int] = field(default_factory=dict)
    ends: dict[int, list[int]] = field(default_factory=dict)  # template -> positions after its last word


class Automaton:
    """Suffix automaton of several word sequences; ``ends`` tells where a state's strings stand."""

    def __init__(self, sequences: list[list[int]]):
        self.states = [_State(0, -1)]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence):
                last = self._extend(last, word)
                self.states[last].ends.setdefault(number, []).append(at + 1)
        for state in sorted(self.states[1:], key=lambda s: -s.length):
            for number, ends in state.ends.items():
                self.states[state.link].ends.setdefault(number, []).extend(ends)
        for state in self.states:
            state.ends = {k: sorted(set(v)) for k, v in state.ends.items()}

    def _split(self, parent: int, child: int, word: int) -> int:
        """The state of parent's string plus word, taken out of ``child``, which also holds longer ones."""
        states = self.states
        if states[child].length == states[parent].length + 1:
            return child
        states.append(_State(states[parent].length + 1, states[child].link, dict(states[child].step)))
        new = len(states) - 1
        states[child].link = new
        while parent >= 0 and states[parent].step.get(word) == child:
            states[parent].step[word] = new
            parent = states[parent].link
        return new

    def _extend(self, last: int, word: int) -> int:
        states = self.states
        if word in states[last].step:
            return self._split(last, states[last].step[word], word)
        states.append(_State(states[last].length + 1, 0))
        new, at = len(states) - 1, last
        while at >= 0 and word not in states[at].step:
            states[at].step[word] = new
            at = states[at].link
        if at >= 0:
            states[new].link = self._split(at, states[at].step[word], word)
        return new

    def statistics(self, sequence: list[int]) -> Iterator[tuple[int, int]]:
        """At each word: the state and length of the longest match that ends there."""
        states = self.states
        at = length = 0
        for word in sequence:
            while at and word not in states[at].step:
                at = states[at].link
                length = states[at].length
            if word in states[at].step:
                at = states[at].step[word]
                length += 1
            else:
                at = length = 0
            yield at, length


class Scanner:
    def __init__(self, base: tuple = BASE, templates: tuple = TEMPLATES, min_match: int = MIN_MATCH, max_gap: int = MAX_GAP, coverage: float = COVERAGE):
        self.min_match, self.max_gap, self.coverage = min_match, max_gap, coverage
        marked = [_marked(text) for _, text in templates]
        texts = [(label, split(text)) for text, label in base] + [(label, found) for (label, _), (found, _) in zip(templates, marked, strict=True)]
        self.keys = [[] for _ in base] + [keys for _, keys in marked]
        if any(len(t) < 3 for _, t in texts):
            raise ValueError("a template has three words at least")
        self.ids: dict[bytes, int] = {}
        self.labels = [label for label, _ in texts]
        self.sequences = [[self.ids.setdefault(w.encode(), len(self.ids)) for w in t] for _, t in texts]
        self.base = [(self.labels[i], self.sequences[i]) for i in range(len(base))]
        self.automaton = Automaton(self.sequences)
        self.places: dict[int, list[tuple[int, int, int]]] = {}
        grams = [words.scan(pa.array([" ".join(t)]), words.ALNUM).windows(3)[0] for _, t in texts]
        self.grams = np.unique(np.concatenate(grams))

    def stretches(self, found: words.Words) -> Iterator[tuple[int, int]]:
        """[a, b) word ranges, inside one text each, all of whose 3-word windows occur in templates."""
        h, at = found.windows(3)
        at = at[np.isin(h, self.grams)]
        if not len(at):
            return
        text = np.searchsorted(found.first, at, side="right")
        new = np.flatnonzero((np.diff(at) != 1) | (np.diff(text) != 0))
        for a, b in zip(at[np.concatenate(([0], new + 1))].tolist(), at[np.append(new, len(at) - 1)].tolist(), strict=True):
            yield a, b + 3

    def scan(self, found: words.Words) -> dict[int, dict]:
        """What stands in each text that has any match: base places (label, start) and matches (template, start, place in the template, length)."""
        out: dict[int, dict] = {}  # a match is as long as its template allows, whatever other templates allow
        for a, b in self.stretches(found):
            doc = int(np.searchsorted(found.first, a, side="right")) - 1
            first = int(found.first[doc])
            sequence = [self.ids.get(found.text(i, i + 1), -1) for i in range(a, b)]
            here = out.setdefault(doc, {"base": [], "matches": []})
            before: dict[tuple[int, int], int] = {}
            for i, (state, length) in enumerate([*self.automaton.statistics(sequence), (0, 0)]):
                now = {(number, end): min(most, length) for number, end, most in self.occurrences(state)} if length >= self.min_match else {}
                for (number, end), size in before.items():
                    if (number, end + 1) not in now:  # the match can't be made longer to the right
                        here["matches"].append((number, a - first + i - size, end - size, size))
                for label, phrase in self.base:
                    if length >= len(phrase) and sequence[i + 1 - len(phrase) : i + 1] == phrase:
                        here["base"].append((label, a - first + i + 1 - len(phrase)))
                before = now
        return out

    def occurrences(self, state: int) -> list[tuple[int, int, int]]:
        """Where the longest match of a state, or the longest part of it at its end that a template has, stands: template, position behind it, length at most."""
        if state not in self.places:
            found: dict[tuple[int, int], int] = {}
            at, most = state, self.automaton.states[state].length
            while at > 0 and most >= self.min_match:
                for number, ends in self.automaton.states[at].ends.items():
                    if number >= len(self.base):
                        for end in ends:
                            found.setdefault((number, end), most)
                at = self.automaton.states[at].link
                most = self.automaton.states[at].length
            self.places[state] = [(number, end, most) for (number, end), most in found.items()]
        return self.places[state]

    def chains(self, matches: list[tuple[int, int, int, int]]) -> Iterator[tuple[int, int, int, int, bool]]:
        """Chains of each template, the best first and none that overlaps a better one: template, words covered, first and last+1 word of the text, and whether all distinguishing words are covered."""
        by: dict[int, list[tuple[int, int, int]]] = {}
        for number, *place in matches:
            by.setdefault(number, []).append(tuple(place))
        for number, places in by.items():
            places.sort()
            n = len(self.sequences[number])
            covered: list[int] = []
            value: list[float] = []
            before: list[int] = []
            for start, at, length in places:
                i = len(value)
                best, most, link = float(length), length, -1
                for j in range(i - 1, -1, -1):
                    start_j, at_j, length_j = places[j]
                    if start - start_j > n + self.max_gap * 4:
                        break
                    overlap = max(0, start_j + length_j - start, at_j + length_j - at)
                    if start_j < start and at_j < at and overlap < length and max(start - start_j - length_j, at - at_j - length_j) <= self.max_gap:
                        whole = value[j] + length - overlap - GAP_COST * max(0, start - start_j - length_j)
                        if whole > best:
                            best, most, link = whole, covered[j] + length - overlap, j
                covered.append(most)
                value.append(best)
                before.append(link)
            taken: list[tuple[int, int]] = []  # in text order
            for i in sorted(range(len(places)), key=lambda i: (-value[i], i)):  # noqa: B023
                parts, j = [], i
                while j >= 0:
                    parts.append(places[j])
                    j = before[j]
                first, last = parts[-1][0], parts[0][0] + parts[0][2]
                at = bisect.bisect_left(taken, (last,))  # those before begin before the end of this one; only the last of them can reach it
                if at and taken[at - 1][1] > first:
                    continue
                taken.insert(at, (first, last))
                keyed = all(any(at <= a and b <= at + length for _, at, length in parts) for a, b in self.keys[number])
                yield number, covered[i], first, last, keyed

    def spans(self, matches: list[tuple[int, int, int, int]]) -> list[tuple[str, int, int, float]]:
        """(label, first, last+1 word, coverage) of the candidates that win the competition for the text, in text order."""
        found = [c for c in self.chains(matches) if c[4] and c[1] >= self.coverage * len(self.sequences[c[0]])]
        won: list[tuple[str, int, int, float]] = []
        near: dict[int, list[tuple[int, int]]] = {}  # what has won, by the stretches of the text that it touches
        for number, covered, first, last, _ in sorted(found, key=lambda c: (-c[1], c[3] - c[2] - c[1], self.labels[c[0]], c[0], c[2])):
            touched = range(first // STRETCH, (last - 1) // STRETCH + 1)
            if all(2 * (min(last, b) - max(first, a)) < last - first for x in touched for a, b in near.get(x, ())):
                for x in touched:
                    near.setdefault(x, []).append((first, last))
                won.append((self.labels[number], first, last, min(1.0, covered / len(self.sequences[number]))))
        return sorted(won, key=lambda x: (x[1], x[2], x[0]))

    def rows(self, found: words.Words) -> list[tuple]:
        """(n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of each text."""
        counts = np.diff(found.first).tolist()
        scanned = self.scan(found)
        out = []
        for doc, n in enumerate(counts):
            here = scanned.get(doc)
            if here is None:
                out.append((n, 0, None, None, "", "", 0.0, ""))
                continue
            base = here["base"]
            base_labels = {label for label, _ in base}
            spans = self.spans(here["matches"])
            labels = base_labels | {x[0] for x in spans}
            score = 1.0 if base else max((x[3] for x in spans), default=0.0)
            starts = [s for _, s in base]
            out.append((n, len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)), score, ";".join(f"{x}:{a}-{b}" for x, a, b, _ in spans)))
        return out


@functools.lru_cache(maxsize=4)
def scanner(*parameters) -> Scanner:  # noqa: ANN002
    """One automaton per worker process and set of parameters."""
    return Scanner(*parameters)


_FIELDS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string"


def scan_licences(docs: DataFrame, base: tuple = BASE, templates: tuple = TEMPLATES, min_match: int = MIN_MATCH, max_gap: int = MAX_GAP, coverage: float = COVERAGE) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans (label:first-end)."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    stage.small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((tuple(base), tuple(templates), min_match, max_gap, coverage))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(*sent.value)
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
        for batch in batches:
            for part in words.slices(batch):
                columns = zip(*scan.rows(words.scan(part.column("text"), words.ALNUM)), strict=True)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=["doc_id", *(f.split()[0] for f in _FIELDS.split(", "))])

    return docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, {_FIELDS}")
