"""License scans by Dice coefficient over word bigrams.

A text is looked at as a whole, by paragraph and by line. Each part is normalised (lower case, everything but letters and
digits taken as white space) and compared to licence templates: twice the common distinct word bigrams over the sum of
both numbers of distinct bigrams. A coefficient of ``t`` needs sizes within a factor ``(2 - t) / t``, so templates of
other sizes are not compared at all, and an index from bigram to template leaves only those that share one.

Defined results: a null or empty text and a text without a matching part have no licence (null, 0); parts of one word
have no bigram; equal coefficients go to the template first by name, then to the earliest part, whole text first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from graphprep.llm.common import columns_of, extended

THRESHOLD = 0.8

#: Notices and short licences by SPDX-like name.
TEMPLATES = {
    "Apache-2.0/line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "CC-BY-4.0/line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0/line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0/line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0/line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0/notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "General Public License for more details."
    ),
    "ISC/text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
        "USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "MIT/line": "Released under the MIT License.",
    "MIT/text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "Unlicense/notice": "This is free and unencumbered software released into the public domain.",
}

#: ASCII letters and digits and all other letters; the rest parts words. One line of text at a time is enough for it.
WORD = re.compile(r"[^\W_]+")
PARAGRAPHS = re.compile(r"\n[ \t]*\n")


class Match(NamedTuple):
    template: str
    dice: float
    common: int
    part_bigrams: int
    start: int
    end: int


def bigrams(text: str) -> set[tuple[str, str]]:
    words = WORD.findall(text.lower())
    return set(zip(words, words[1:]))


class Templates:
    """Templates with their bigrams, an index from bigram to template, and the sizes a part may have."""

    def __init__(self, texts: Mapping[str, str], threshold: float = THRESHOLD) -> None:
        self.threshold = threshold
        self.names = sorted(texts)
        self.grams = [bigrams(texts[n]) for n in self.names]
        self.index: dict[tuple[str, str], list[int]] = {}
        for i, grams in enumerate(self.grams):
            for gram in grams:
                self.index.setdefault(gram, []).append(i)
        factor = (2 - threshold) / threshold
        self.bounds = [(len(g) / factor, len(g) * factor) for g in self.grams]
        self.least = min((low for low, _ in self.bounds), default=0)
        self.most = max((high for _, high in self.bounds), default=0)
        self.words = {w for gram in self.index for w in gram}

    def best(self, part: str) -> tuple[float, int, int, int] | None:
        """``(dice, template, common, bigrams)`` of a part, or None below the threshold."""
        words = WORD.findall(part.lower())
        # A part with as many words as the largest template allows may still repeat bigrams, so only few words rule out.
        if len(words) - 1 < self.least:
            return None
        known = self.words
        pairs = [pair for pair in zip(words, words[1:]) if pair[0] in known and pair in self.index]
        if not pairs:
            return None
        size = len(set(zip(words, words[1:])))
        if not self.least <= size <= self.most:
            return None
        common: dict[int, int] = {}
        for pair in set(pairs):
            for i in self.index[pair]:
                if self.bounds[i][0] <= size <= self.bounds[i][1]:
                    common[i] = common.get(i, 0) + 1
        found = [(2 * n / (size + len(self.grams[i])), -i, n) for i, n in common.items()]
        found = [f for f in found if f[0] >= self.threshold]
        if not found:
            return None
        dice, i, n = max(found)
        return dice, -i, n, size


def parts(text: str) -> Iterator[tuple[int, int]]:
    """The whole text, its paragraphs and its lines, as offsets; equal ones may come twice."""
    yield 0, len(text)
    at = 0
    for gap in PARAGRAPHS.finditer(text):
        yield at, gap.start()
        at = gap.end()
    if at:
        yield at, len(text)
    at = 0
    for line in text.split("\n"):
        yield at, at + len(line)
        at += len(line) + 1


def find_license(text: str | None, templates: Templates) -> Match | None:
    """The best match of a text."""
    best: Match | None = None
    order = None
    if text:
        for number, (start, end) in enumerate(parts(text)):
            found = templates.best(text[start:end])
            if found:
                key = (found[0], -found[1], -number)
                if order is None or key > order:
                    order = key
                    best = Match(templates.names[found[1]], found[0], found[2], found[3], start, end)
    return best


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, license, dice, common, part_bigrams, start, end`` for every row of ``doc_id, text``."""
    rows = docs.select("doc_id", "text")
    schema = extended(rows.drop("text"), "license string, dice double, common bigint, part_bigrams bigint, start bigint, end bigint")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, threshold)
        none = (None, 0.0, 0, 0, None, None)
        for batch in batches:
            (texts,) = columns_of(batch, "text")
            found = [find_license(t, known) or none for t in texts]
            kinds = (pa.string(), pa.float64(), *[pa.int64()] * 4)
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return rows.mapInArrow(scan, schema)
