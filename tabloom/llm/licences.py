"""Licence scans: matching statistics of texts against a suffix automaton of templates.

All templates share one automaton over word numbers. A text streams through it word by
word: the automaton's state always stands for the longest run of words, ending there,
that occurs in any template. A run that cannot be extended and has ``MIN_RUN`` words or
more is a match; matches that go forward in the same template are chained, and a template
is found where its chain covers ``MIN_COVER`` of its words. Words no template has end a
run; whole stretches of them are skipped without touching the automaton.

Short references are too short for that: ``NAMES`` of the Creative Commons family, LGPL and
AGPL are found where all their words stand. Of overlapping names the one that ends last
counts (then the longest), so BY-NC-SA is neither BY-NC nor BY; and a name inside a covered
template of the licence it varies (``VARIED``) replaces that template's span. Base labels stay.

Besides, places where a licence's name stands are counted (``PHRASES``): the base labels.

Null text is empty; a text without words has no labels and score 0. Null or repeated
doc_ids stay rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabloom.llm.common import LOWER, byte_class, find_words, prefix_sums, slices, span_hash

WORD = byte_class((48, 57), (97, 122), (128, 255))
MIN_RUN = 5
MIN_COVER = 0.5
MAX_GAP = 12
NAMED_SCORE = 0.5

# Phrases that name a licence.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Wording of public licences and their notices.
TEMPLATES = {
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
    ],
    "apache": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
        "Licensed under the Apache License, Version 2.0",
    ],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details.",
        "This work is licensed under the GNU General Public License, version 3",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means."
    ],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
}

# Parts of Creative Commons names, as they are written.
CC_PARTS = {
    "nc": ["NonCommercial", "Non-Commercial"],
    "nd": ["NoDerivatives", "NoDerivs", "No-Derivatives", "No-Derivs"],
    "sa": ["ShareAlike", "Share-Alike"],
}
CC_VERSIONS = ["", " 1.0", " 2.0", " 2.5", " 3.0", " 4.0"]
CC_LICENCES = ["by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd"]


def cc_names(licence: str) -> list[str]:
    """Short, long and link forms of a name, each without and with a version. CC BY alone
    may be other words; it needs a version or the word licence beside it."""
    long = ["-".join(p) for p in product(["Creative Commons Attribution"], *(CC_PARTS[k] for k in licence.split("-")[1:]))]
    names = [name + v for name in [*long, f"creativecommons.org/licenses/{licence}", f"CC {licence}"] for v in CC_VERSIONS]
    if licence != "by":
        return names
    names.remove("CC by")
    return names + ["CC BY license", "CC BY licence", "licensed under CC BY", "licensed under a CC BY", "license CC BY", "licence CC BY"]


# Names and short forms, found whole.
NAMES = {f"cc-{licence}": cc_names(licence) for licence in CC_LICENCES} | {
    "cc0": ["CC0", "CC0 1.0", "Creative Commons Zero", "creativecommons.org/publicdomain/zero"],
    "lgpl": [
        "GNU Lesser General Public License", "GNU Library General Public License", "Lesser General Public License",
        "Library General Public License", "GNU LGPL", "LGPL", "LGPL2", "LGPL3", "LGPLv2", "LGPLv2.1", "LGPLv3",
    ],
    "agpl": [
        "GNU Affero General Public License", "Affero General Public License", "GNU AGPL", "AGPL", "AGPL3", "AGPLv1", "AGPLv3",
    ],
}
VARIED = {"lgpl": "gpl", "agpl": "gpl"} | {f"cc-{licence}": "cc-by" for licence in CC_LICENCES[1:]}


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word, A-Z as a-z."""
    lowered = LOWER[data]
    start, end, row = find_words(lowered, offsets, WORD)
    return span_hash(prefix_sums(lowered), start, end), row


def _one(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return word_hashes(data, np.array([0, len(data)]))[0]


class SuffixAutomaton:
    """All runs of words of several sequences; a state also knows, for each sequence its
    runs occur in, where the first occurrence ends."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, int]] = [{}]
        for number, sequence in enumerate(sequences):
            last = 0
            for position, word in enumerate(sequence):
                last = self._extend(last, word)
                self.ends[last].setdefault(number, position + 1)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            above = self.ends[self.link[state]]
            for number, end in self.ends[state].items():
                above[number] = min(end, above.get(number, end))

    def _new(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.ends.append({})
        return len(self.link) - 1

    def _split(self, state: int, word: int) -> int:
        """The state for the run (state, word), parted from longer runs it shared a state with."""
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        part = self._new(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = part
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = part
            state = self.link[state]
        return part

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new = self._new(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word)
        return new

    def matches(self, words: list[int], least: int) -> Iterator[tuple[int, int, dict[int, int]]]:
        """(end in words, length, ends by sequence) of runs that the next word does not extend."""
        state, length = 0, 0
        for at, word in enumerate(words):
            if word not in self.next[state]:
                if length >= least:
                    yield at, length, self.ends[state]
                while state and word not in self.next[state]:
                    state = self.link[state]
                    length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
        if length >= least:
            yield len(words), length, self.ends[state]


class LicenceScanner:
    def __init__(self, templates: dict[str, list[str]] = TEMPLATES, phrases: dict[str, str] = PHRASES, names: dict[str, list[str]] = NAMES):
        hashes = [(label, _one(text)) for label, texts in templates.items() for text in texts]
        self.vocabulary = np.unique(np.concatenate([h for _, h in hashes]))
        self.labels = [label for label, _ in hashes]
        self.sizes = [len(h) for _, h in hashes]
        self.automaton = SuffixAutomaton([np.searchsorted(self.vocabulary, h).tolist() for _, h in hashes])
        self.phrases = [(_one(text), label) for text, label in phrases.items()]
        self.names = {tuple(_one(text).tolist()): label for label, texts in names.items() for text in texts}
        self.name_sizes = sorted({len(name) for name in self.names}, reverse=True)
        self.name_begins = np.array(sorted({name[0] for name in self.names}), np.uint64)

    def places(self, words: np.ndarray, row: np.ndarray) -> list[tuple[np.ndarray, str]]:
        """Where each phrase's words stand consecutively in one row."""
        out = []
        for phrase, label in self.phrases:
            at = np.flatnonzero(words[: max(0, len(words) - len(phrase) + 1)] == phrase[0])
            for k in range(1, len(phrase)):
                at = at[(words[at + k] == phrase[k]) & (row[at + k] == row[at])]
            out.append((at, label))
        return out

    def named(self, words: np.ndarray, row: np.ndarray) -> dict[int, list[tuple[str, int, int]]]:
        """By row: label, first and end word of the names that count, from the last one back."""
        found = []
        for p in np.flatnonzero(np.isin(words, self.name_begins)).tolist():
            rest = words[p : p + self.name_sizes[0]][row[p : p + self.name_sizes[0]] == row[p]].tolist()
            for size in self.name_sizes:
                if size <= len(rest) and (label := self.names.get(tuple(rest[:size]))):
                    found.append((p + size, p, label))
                    break
        out: dict[int, list[tuple[str, int, int]]] = {}
        free = len(words)
        for end, p, label in sorted(found, key=lambda f: (-f[0], f[1])):
            if end <= free:
                free = p
                out.setdefault(int(row[p]), []).append((label, p, end))
        return out

    def runs(self, words: np.ndarray, row: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
        """Stretches of template words in one row, long enough for a match: begin, end, numbers."""
        number = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        known = self.vocabulary[number] == words
        if not known.any():
            return []
        cut = np.ones(len(words) + 1, bool)
        cut[1:-1] = (known[1:] != known[:-1]) | (row[1:] != row[:-1])
        edge = np.flatnonzero(cut)
        begin, end = edge[:-1], edge[1:]
        keep = known[begin] & (end - begin >= MIN_RUN)
        return [(b, e, number[b:e]) for b, e in zip(begin[keep].tolist(), end[keep].tolist())]

    def spans(self, found: list[tuple[int, int, dict[int, int]]]) -> list[tuple[str, int, int, float]]:
        """Chain one text's matches (begin, length, ends by template), in order of place:
        (label, first word, end word, share of the template covered)."""
        chains: dict[int, list[list[int]]] = {}
        for begin, length, ends in found:
            for template, end in ends.items():
                first = end - length
                mine = chains.setdefault(template, [])
                if mine:
                    start, stop, reached, covered = mine[-1]
                    if reached <= first + length and first >= reached - length and begin - stop <= MAX_GAP:
                        fresh = end - max(first, reached)
                        mine[-1] = [start, begin + length, max(end, reached), covered + max(0, fresh)]
                        continue
                mine.append([begin, begin + length, end, length])
        out = []
        for template, mine in chains.items():
            for start, stop, _, covered in mine:
                share = covered / self.sizes[template]
                if share >= MIN_COVER:
                    out.append((self.labels[template], start, stop, min(1.0, share)))
        return sorted(out, key=lambda s: (s[1], s[2], s[0]))

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> dict[str, list]:
        rows = len(offsets) - 1
        words, row = word_hashes(data, offsets)
        begin = np.searchsorted(row, np.arange(rows + 1), "left")
        base: list[list[tuple[int, str]]] = [[] for _ in range(rows)]
        for at, label in self.places(words, row):
            for p in at.tolist():
                base[row[p]].append((p - int(begin[row[p]]), label))
        found: dict[int, list] = {}
        for b, e, numbers in self.runs(words, row):
            r = int(row[b])
            for end, length, ends in self.automaton.matches(numbers.tolist(), MIN_RUN):
                found.setdefault(r, []).append((b - int(begin[r]) + end - length, length, ends))
        names = self.named(words, row)
        out: dict[str, list] = {k: [] for k in ("n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")}
        for r in range(rows):
            spans = self.spans(found[r]) if r in found else []
            whole = [(label, b - int(begin[r]), e - int(begin[r])) for label, b, e in names.get(r, ())]
            spans = [s for s in spans if not any(VARIED.get(label) == s[0] and b < s[2] and s[1] < e for label, b, e in whole)]
            named = {label for _, label in base[r]}
            # A name inside a span of its own licence says nothing more.
            beside = [n for n in whole if not any(s[0] == n[0] and s[1] <= n[1] and n[2] <= s[2] for s in spans)]
            spans = sorted(spans + [(*n, NAMED_SCORE) for n in beside], key=lambda s: (s[1], s[2], s[0]))
            at = [p for p, _ in base[r]]
            out["n_base"].append(len(at))
            out["first_word"].append(min(at, default=None))
            out["last_word"].append(max(at, default=None))
            out["base_labels"].append(",".join(sorted(named)))
            out["labels"].append(",".join(sorted(named | {s[0] for s in spans})))
            out["score"].append(max([NAMED_SCORE if at else 0.0, *(s[3] for s in spans)]))
            out["spans"].append(",".join(f"{label}:{b}:{e}" for label, b, e, _ in spans))
        return {"n_words": np.diff(begin).tolist()} | out


SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("spans", pa.string()),
])


def scan_licences(documents: DataFrame, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per document; ``spans`` lists label:first word:end word of covered templates and of names.
    ``score`` is the largest share of a template covered, at least ``NAMED_SCORE`` where a
    licence is named."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = LicenceScanner(templates or TEMPLATES)
        for batch in batches:
            for at, end, data, offsets in slices(batch.column(1)):
                columns = {"doc_id": batch.column(0).slice(at, end - at)} | scanner.scan(data, offsets)
                yield pa.record_batch([pa.array(columns[f.name], f.type) for f in SCHEMA], schema=SCHEMA)

    ddl = ", ".join(f"{f.name} {dict(int64='long', double='double').get(str(f.type), 'string')}" for f in SCHEMA)
    return documents.select("doc_id", "text").mapInArrow(scan, ddl)
