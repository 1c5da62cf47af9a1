"""License scans by patience alignment.

A template is aligned with a region of a text: words that occur exactly once on both sides are anchors, their longest
increasing subsequence is kept, and the gaps between anchors are aligned the same way after equal words at their ends
are matched. The matched share of the template's words is its coverage.

Regions are found without looking at a prefix or a sample. A template of n words that is covered to a share c or more
misses at most ``n - ceil(c * n)`` of its words, so one more than that many of its rarest words (rare among the
templates, long words first) must include a word that is there: each place in a text with such a word makes a region,
long enough on each side for the whole template at the least density. A template's ``REQUIRED`` words, which tell it
from its relatives, must all be matched, and a notice of fewer than ``SHORT`` words must be covered whole without
other words inside; one with a ``FORBIDDEN`` word inside is another license's. The cost of a text is one
lookup per word and an alignment per such place; nothing is shuffled.

Null and empty texts have no words and no license. A notice that stands in a text several times is reported as often;
of templates that match overlapping words the one with more coverage, then more words, then the smaller name is
reported. Rows alike get rows alike; other columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.common import folded_words, free_name, text_of

#: Least covered share of a template, and least matched share of the words between its first and last matched word.
COVERAGE = 0.8
DENSITY = 0.7
#: Templates of fewer words are found only word for word.
SHORT = 16

#: Notices as their licenses word them.
TEMPLATES: Mapping[str, str] = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        'in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "bsd-header": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer."
    ),
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-sa-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nd-4.0": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-nd-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "bsd": "Released under the BSD License.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "lgpl-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies."
    ),
    "mit": "Released under the MIT License.",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
}

#: Words that a match must hold beside its coverage, and words that mustn't stand among the matched ones.
REQUIRED: Mapping[str, str] = {"mpl-2.0-header": "mozilla", "gpl-header": "general public"}
FORBIDDEN: Mapping[str, str] = {"gpl-header": "lesser library affero"}


def increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence of distinct ``values``, by patience piles."""
    tops: list[int] = []
    places: list[int] = []
    before: list[int] = []
    for at, value in enumerate(values):
        pile = bisect_left(tops, value)
        before.append(places[pile - 1] if pile else -1)
        tops[pile : pile + 1] = [value]
        places[pile : pile + 1] = [at]
    chain, at = [], places[-1] if places else -1
    while at >= 0:
        chain.append(at)
        at = before[at]
    return chain[::-1]


def align(text: list[bytes], template: list[bytes]) -> list[tuple[int, int]]:
    """Matched places (in text, in template), in order."""
    matched: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            matched.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            matched.append((b, d))
        if a == b or c == d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        place = {text[i]: i for i in range(a, b) if here[text[i]] == 1}
        common = [(place[template[j]], j) for j in range(c, d) if there[template[j]] == 1 and template[j] in place]
        if not common:
            continue
        anchors = [common[k] for k in increasing([i for i, _ in common])]
        matched += anchors
        edges = [(a - 1, c - 1), *anchors, (b, d)]
        gaps += [(i + 1, x, j + 1, y) for (i, j), (x, y) in zip(edges, edges[1:])]
    return sorted(matched)


class Match(NamedTuple):
    license: str
    coverage: float
    start: int
    end: int
    words: int


class Scanner:
    """The templates, and for each of their key words the regions it makes."""

    def __init__(self, templates: Mapping[str, str], coverage: float = COVERAGE, density: float = DENSITY):
        self.coverage, self.density = coverage, density
        self.words = {name: folded_words(text.encode()) for name, text in templates.items()}
        self.required = {name: frozenset(folded_words(REQUIRED.get(name, "").encode())) for name in templates}
        self.forbidden = {name: frozenset(folded_words(FORBIDDEN.get(name, "").encode())) for name in templates}
        holders = Counter(w for words in self.words.values() for w in set(words))
        #: key word: templates and the word's places in them
        self.keys: dict[bytes, list[tuple[str, int]]] = {}
        for name, words in self.words.items():
            if not words:
                raise ValueError(f"the template {name} has no words")
            places = sorted(range(len(words)), key=lambda i, words=words: (holders[words[i]], words.count(words[i]), -len(words[i]), words[i], i))
            may_miss = len(words) - math.ceil(self._least(words) * len(words) - 1e-9)
            for i in places[: may_miss + 1]:
                self.keys.setdefault(words[i], []).append((name, i))

    def _least(self, template: list[bytes]) -> float:
        return 1.0 if len(template) < SHORT else self.coverage

    def scan(self, words: list[bytes]) -> list[Match]:
        found: set[Match] = set()
        keys = self.keys
        for at, word in enumerate(words):
            if word not in keys:
                continue
            for name, place in keys[word]:
                template = self.words[name]
                size = len(template)
                dense = 1.0 if size < SHORT else self.density
                reach = math.ceil(size / dense) + 1
                first = max(0, at - reach) if dense < 1 else max(0, at - place)
                region = words[first : at + reach] if dense < 1 else words[first : first + size]
                pairs = align(region, template)
                if not pairs:
                    continue
                start, end = pairs[0][0], pairs[-1][0] + 1
                matched = {template[j] for _, j in pairs}
                if not self.required[name] <= matched or not self.forbidden[name].isdisjoint(region[start:end]):
                    continue
                if len(pairs) >= self._least(template) * size - 1e-9 and len(pairs) >= dense * (end - start):
                    found.add(Match(name, len(pairs) / size, first + start, first + end, len(pairs)))
        best: list[Match] = []
        for match in sorted(found, key=lambda m: (-m.coverage, -m.words, m.license, m.start)):
            if all(match.end <= b.start or match.start >= b.end for b in best):
                best.append(match)
        return sorted(best, key=lambda m: (m.start, m.license))


_MATCH = T.ArrayType(T.StructType([
    T.StructField("license", T.StringType()), T.StructField("coverage", T.DoubleType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("words", T.LongType()),
]))
_MATCH_ARROW = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64()), ("words", pa.int64())]))


def scan_licenses(
    docs: DataFrame, *, text: str = "text", templates: Mapping[str, str] = TEMPLATES, coverage: float = COVERAGE, density: float = DENSITY,
    into: str = "licenses",
) -> DataFrame:
    """``docs`` with the licenses found in each text: name, coverage, the words it stands in (end excluded) and how many matched."""
    if into in docs.columns:
        raise ValueError(f"there is a column {into} already")
    scanner = Scanner(templates, coverage, density)
    schema = T.StructType([*docs.schema.fields, T.StructField(into, _MATCH)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            found = [[m._asdict() for m in scanner.scan(folded_words(v.as_buffer().to_pybytes()))] for v in batch.column(last)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(last)], pa.array(found, _MATCH_ARROW)], schema.fieldNames())

    return docs.select(*[F.col(f"`{c}`") for c in docs.columns], text_of(text).alias(free_name(docs, "text"))).mapInArrow(run, schema)
