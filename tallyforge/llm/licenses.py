"""License scans: winnowed fingerprints pick candidates, banded alignment reports coverage and spans.

Texts and templates become lower-cased words of letters and digits. Of every ``WINDOW``
consecutive hashes of ``GRAM`` words the smallest is a fingerprint, so any stretch of
GRAM + WINDOW - 1 shared words shares one. An inverted index maps template fingerprints to
templates and places. A document's fingerprints that are found vote for a template and a place of
its first word; with enough votes close together, one for a short template and one for every
VOTE_WORDS words of a long one, the template is aligned with the words there, within a band of the diagonal.
The alignment's matched words over the template's words are its coverage. Of overlapping finds the one
with most matched words stays, of equal ones that with the higher coverage: a text with two clauses is no
license with three.

The templates are the whole texts of common licenses (``license_texts``) and the notices that refer
to them; they are a parameter, and travel with the tasks. A NULL text has no words.
Templates too short for their coverage to leave a shared stretch are aligned wherever one of
so many of their words occurs that they cannot all be missing; longer ones can be missed if nearly every fourth word differs.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyforge.llm.hashing import scramble
from tallyforge.llm.words import WordHashes, lower_ascii

GRAM, WINDOW = 3, 2
#: Words by which an alignment may leave the diagonal: this, and one more for so many template words, at most so many.
BAND, BAND_WORDS, WIDEST = 6, 100, 24
#: The coverage from which a find is reported, and template words for which one vote is asked.
MIN_COVERAGE, VOTE_WORDS = 0.8, 20
#: Words up to which a template is aligned wherever one of its words for that occurs.
SHORT = 8

#: Notices by which files refer to a license.
NOTICES = {
    "AGPL-3.0 (notice)": "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or "
    "(at your option) any later version.",
    "Apache-2.0 (reference)": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 (notice)": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
    "in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
    "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
    "specific language governing permissions and limitations under the License.",
    "BSD (reference)": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
    "CC-BY-4.0 (reference)": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0 (reference)": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0 (reference)": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC0-1.0 (reference)": "To the extent possible under law, the author has waived all copyright and related or neighboring "
    "rights to this work",
    "EPL-2.0 (notice)": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
    "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0",
    "GPL-2.0 (notice)": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
    "option) any later version.",
    "GPL-3.0 (notice)": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version.",
    "GPL-3.0 (reference)": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-2.1 (notice)": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
    "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
    "your option) any later version.",
    "MIT (reference)": "Released under the MIT License",
    "MPL-2.0 (notice)": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
    "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "MPL-2.0 (reference)": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


def _whole_texts() -> dict[str, str]:
    """The license texts beside this module, by their usual short names."""
    folder = Path(__file__).parent / "license_texts"
    return {path.stem: path.read_text(encoding="utf-8") for path in sorted(folder.glob("*.txt"))}


TEMPLATES = {**_whole_texts(), **NOTICES}

_WORDS = re.compile(r"[0-9A-Za-z]+")


def license_words(text: str) -> list[str]:
    return _WORDS.findall(lower_ascii(text))


def word_places(text: str) -> list[tuple[int, int]]:
    return [match.span() for match in _WORDS.finditer(text)]


def winnow(words: list[str], codes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the fingerprints: of each window its smallest, the first of equal ones."""
    count = len(words) - GRAM + 1
    if count <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    values = codes.of(words)
    grams = np.zeros(count, np.uint64)
    for step in range(GRAM):
        grams = scramble(grams ^ values[step : step + count])
    windows = np.lib.stride_tricks.sliding_window_view(grams, min(WINDOW, count))
    places = np.unique(np.arange(len(windows)) + windows.argmin(axis=1))
    return grams[places], places


@dataclass(frozen=True)
class Found:
    license: str
    matched: int
    coverage: float
    first: int
    last: int


class LicenseIndex:
    """Templates with the inverted index of their fingerprints."""

    def __init__(self, templates: Mapping[str, str]) -> None:
        codes = WordHashes()
        self.words = {name: license_words(text) for name, text in templates.items()}
        self.names = [name for name, words in self.words.items() if words]
        #: Word -> templates and places, of short templates.
        self.short: dict[str, list[tuple[int, int]]] = defaultdict(list)
        postings: list[tuple[int, int, int]] = []
        for number, name in enumerate(self.names):
            words = self.words[name]
            if len(words) <= SHORT:
                # So many may be missing that any one more than that holds a word that is there; long words are rarer.
                missing = int((1 - MIN_COVERAGE) * len(words) + 1e-9)
                for place in sorted(range(len(words)), key=lambda k: (-len(words[k]), k))[: missing + 1]:
                    self.short[words[place]].append((number, place))
            else:
                postings += [(int(code), number, int(place)) for code, place in zip(*winnow(words, codes))]
        postings.sort()
        codes_, numbers, places = zip(*postings) if postings else ((), (), ())
        every = np.array(codes_, np.uint64)
        self.fingerprints, self.begin = np.unique(every, return_index=True)
        self.begin = np.append(self.begin, len(every))
        self.numbers, self.places = np.array(numbers, np.int64), np.array(places, np.int64)
        sizes = np.array([len(self.words[name]) for name in self.names], np.int64)
        self.needed = np.maximum(1, sizes // VOTE_WORDS - 1)

    def votes(self, words: list[str], codes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Templates, places in ``words`` of their first word, and how many fingerprints say so."""
        hashes, places = winnow(words, codes)
        at = np.searchsorted(self.fingerprints, hashes)
        known = at < len(self.fingerprints)
        known[known] = self.fingerprints[at[known]] == hashes[known]
        if not known.any():
            return places[:0], places[:0], places[:0]
        at, places = at[known], places[known]
        counts = self.begin[at + 1] - self.begin[at]
        owner = np.repeat(np.arange(len(at)), counts)
        entry = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + self.begin[at][owner]
        # Both in one number; places lie far within 40 bits.
        pairs = (self.numbers[entry] << 41) + (places[owner] - self.places[entry] + (1 << 40))
        unique, times = np.unique(pairs, return_counts=True)
        return unique >> 41, (unique & ((1 << 41) - 1)) - (1 << 40), times

    def candidates(self, words: list[str], codes: WordHashes, band: int = BAND) -> set[tuple[str, int]]:
        """Templates with the place in ``words`` where their first word would be.

        Of places within a band of one another the one with most votes stands for all.
        """
        found = set()
        numbers, diagonals, times = self.votes(words, codes)
        # A template whose votes do not suffice all together needs no closer look.
        enough = np.bincount(numbers, times, len(self.names)) >= self.needed
        numbers, diagonals, times = (each[enough[numbers]] for each in (numbers, diagonals, times))
        for number in np.unique(numbers).tolist():
            own = numbers == number
            lines, votes = diagonals[own], times[own]
            reach = self.band_of(self.names[number], band)
            sums = np.append(0, np.cumsum(votes))
            near = sums[np.searchsorted(lines, lines + reach, "right")] - sums[np.searchsorted(lines, lines - reach)]
            taken: list[int] = []
            for k in np.lexsort((lines, -votes, -near)).tolist():
                if near[k] < self.needed[number]:
                    break
                if all(abs(lines[k] - other) > reach for other in taken):
                    taken.append(int(lines[k]))
            found |= {(self.names[number], line) for line in taken}
        if not self.short.keys().isdisjoint(words):
            for at, word in enumerate(words):
                for number, place in self.short.get(word, ()):
                    found.add((self.names[number], at - place))
        return found

    def band_of(self, name: str, band: int) -> int:
        return min(max(WIDEST, band), band + len(self.words[name]) // BAND_WORDS)

    def scan(
        self, words: list[str], codes: WordHashes, band: int = BAND, min_coverage: float = MIN_COVERAGE
    ) -> list[Found]:
        """The licenses found, in order, none overlapping another."""
        aligned = set()
        for name, diagonal in self.candidates(words, codes, band):
            matched, first, last = align(self.words[name], words, diagonal, self.band_of(name, band))
            coverage = matched / len(self.words[name])
            if coverage >= min_coverage:
                aligned.add(Found(name, matched, coverage, first, last))
        kept: list[Found] = []
        for found in sorted(aligned, key=lambda f: (-f.matched, -f.coverage, f.last - f.first, f.first, f.license)):
            if all(found.last < other.first or found.first > other.last for other in kept):
                kept.append(found)
        return sorted(kept, key=lambda f: f.first)


def align(template: list[str], words: list[str], diagonal: int, band: int) -> tuple[int, int, int]:
    """Most template words matched in order near ``diagonal``; first and last matched place.

    Cell (i, d) is template word i against text word i + diagonal + d - band. Of equal counts the
    shorter stretch of text is taken, then the one that starts closer to the diagonal.
    """
    nothing = (0, 0, 0, 0)  # matched, -stretch so far, -distance of the start, start
    width = 2 * band + 1
    row, ends = [nothing] * width, [-1] * width
    for i, word in enumerate(template):
        new_row, new_ends = [nothing] * width, [-1] * width
        for d in range(width):
            at = i + diagonal + d - band
            best, end = row[d], ends[d]  # template word against another word
            if 0 <= at < len(words) and words[at] == word:
                matched, _, off, start = row[d] if row[d][0] else (0, 0, -abs(d - band), at)
                grown = (matched + 1, start - at, off, start)
                if grown > best:
                    best, end = grown, at
            if d + 1 < width and row[d + 1] > best:  # template word missing in the text
                best, end = row[d + 1], ends[d + 1]
            if d and new_row[d - 1] > best:  # extra word in the text
                best, end = new_row[d - 1], new_ends[d - 1]
            new_row[d], new_ends[d] = best, end
        row, ends = new_row, new_ends
    top = max(range(width), key=lambda d: row[d])
    return row[top][0], row[top][3], ends[top]


def scan_licenses(
    docs: DataFrame, templates: Mapping[str, str] | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per license found: document, license, coverage, matched words, and places.

    ``first_word`` and ``last_word`` count words from 0, both included; ``start`` and ``end`` are
    character places, the end excluded.
    """
    index = LicenseIndex(TEMPLATES if templates is None else templates)
    names = ["license", "coverage", "matched_words", "first_word", "last_word", "start", "end"]
    kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordHashes()
        for batch in batches:
            owner, out = [], tuple([] for _ in names)
            for number, value in enumerate(batch.column("text").to_pylist()):
                all_found = index.scan(license_words(value or ""), codes)
                places = word_places(value) if all_found else []
                for found in all_found:
                    owner.append(number)
                    begin, end = places[found.first][0], places[found.last][1]
                    row = (found.license, found.coverage, found.matched, found.first, found.last, begin, end)
                    for column, item in zip(out, row):
                        column.append(item)
            ids = batch.column("id").take(pa.array(np.array(owner, np.int64)))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(out, kinds))], ["id", *names])

    kind = docs.schema[key].dataType.simpleString()
    schema = (
        f"id {kind}, license string, coverage double, matched_words long, first_word long, last_word long, "
        "start long, end long"
    )
    return docs.selectExpr(f"`{key}` AS id", f"`{text}` AS text").mapInArrow(scan, schema)


def license_report(docs: DataFrame) -> DataFrame:
    return scan_licenses(docs).withColumnRenamed("id", "doc_id")
