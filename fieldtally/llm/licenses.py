"""License notices by patience alignment (operator 10).

A text and a template are word sequences. Anchors are words that stand exactly
once in both; the longest run of anchors in the same order (longest increasing
subsequence) is kept, and the gaps between are aligned the same way, after equal
words at their ends. Coverage is the share of the template's words aligned.

A template can stand anywhere in a long text, also many times. Each of the
template's single words votes for the start it would have; the stretches around
starts with enough votes are aligned. Texts that lack too many of the template's
words for the wanted coverage are passed over, which loses nothing.

Defined results: words are letters and digits in lower case; a null or empty
text has no license; of overlapping notices the one with more aligned words
stays, then the better covered, the shorter, the earlier, the smaller name; null ids are
carried; repeated rows stay; extra columns are ignored.
"""

import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fieldtally.llm.common import map_batches

COVERAGE = 0.8
VOTES = 0.2
WORD = re.compile(r"[^\W_]+")

#: Wording of public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                    "International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
               "If a copy of the MPL was not distributed with this file, You can obtain one at "
               "https://mozilla.org/MPL/2.0/.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use '
                         "this file except in compliance with the License. You may obtain a copy of the "
                         "License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
                         "applicable law or agreed to in writing, software distributed under the License "
                         'is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
                         "KIND, either express or implied. See the License for the specific language "
                         "governing permissions and limitations under the License.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the "
                      "terms of the GNU General Public License as published by the Free Software "
                      "Foundation, either version 3 of the License, or (at your option) any later "
                      "version. This program is distributed in the hope that it will be useful, but "
                      "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
                      "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
                      "details.",
    "MIT-full": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
                'software and associated documentation files (the "Software"), to deal in the Software '
                "without restriction, including without limitation the rights to use, copy, modify, "
                "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
                "permit persons to whom the Software is furnished to do so, subject to the following "
                "conditions: The above copyright notice and this permission notice shall be included in "
                'all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", '
                "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
                "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
           "without fee is hereby granted, provided that the above copyright notice and this permission "
           "notice appear in all copies.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are "
                    "permitted provided that the following conditions are met: 1. Redistributions of "
                    "source code must retain the above copyright notice, this list of conditions and the "
                    "following disclaimer. 2. Redistributions in binary form must reproduce the above "
                    "copyright notice, this list of conditions and the following disclaimer in the "
                    "documentation and/or other materials provided with the distribution.",
}


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of pairs (ordered by the first) whose second rises."""
    tops: list[int] = []
    piles: list[int] = []
    back = [-1] * len(pairs)
    for at, (_, second) in enumerate(pairs):
        pile = bisect_left(tops, second)
        back[at] = piles[pile - 1] if pile else -1
        tops[pile:pile + 1] = [second]
        piles[pile:pile + 1] = [at]
    found, at = [], piles[-1] if piles else -1
    while at >= 0:
        found.append(pairs[at])
        at = back[at]
    return found[::-1]


def align(text: list, template: list) -> list[tuple[int, int]]:
    """Aligned positions (text, template) by patience, both rising."""
    found: list[tuple[int, int]] = []
    open_ = [(0, len(text), 0, len(template))]
    while open_:
        a, b, c, d = open_.pop()
        while a < b and c < d and text[a] == template[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a == b or c == d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        place = {template[j]: j for j in range(c, d) if there[template[j]] == 1}
        anchors = increasing([(i, place[text[i]]) for i in range(a, b)
                              if here[text[i]] == 1 and text[i] in place])
        if not anchors:
            continue
        found += anchors
        edges = [(a - 1, c - 1), *anchors, (b, d)]
        open_ += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(found)


class Scanner:
    """Templates prepared for scanning; one per set of templates."""

    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE):
        self.coverage = coverage
        self.templates = []
        for name, text in sorted(templates.items()):
            words = WORD.findall(text.lower())
            if words:
                times = Counter(words)
                # A word may be missing for each template word left uncovered.
                needed = len(times) - int(len(words) * (1 - coverage) + 1e-9)
                single = {w: i for i, w in enumerate(words) if times[w] == 1}
                self.templates.append((name, words, set(times), needed, single))
        self.vocabulary = set().union(*(t[2] for t in self.templates))

    def scan(self, text: str) -> list[tuple[str, float, int, int, int]]:
        """(name, coverage, start, stop, aligned words) of each notice, by
        place; start and stop are characters."""
        lower = text.lower()
        here = self.vocabulary.intersection(WORD.findall(lower))
        wanted = [t for t in self.templates if len(t[2] & here) >= t[3]]
        if not wanted:
            return []
        # Lower case may change lengths; then words are read from the text.
        source = lower if len(lower) == len(text) else text
        spans = [m.span() for m in WORD.finditer(source)]
        words = [source[a:b].lower() for a, b in spans]
        where: dict[str, list[int]] = {}
        for at, word in enumerate(words):
            if word in here:
                where.setdefault(word, []).append(at)
        found = []
        for name, template, _, _, single in wanted:
            for low, high in self._stretches(where, single, len(template), len(words)):
                pairs = align(words[low:high], template)
                share = len(pairs) / len(template)
                if share >= self.coverage:
                    first, last = low + pairs[0][0], low + pairs[-1][0]
                    found.append((name, share, spans[first][0], spans[last][1], len(pairs)))
        kept: list[tuple[str, float, int, int, int]] = []
        for notice in sorted(found, key=lambda f: (-f[4], -f[1], f[3] - f[2], f[2], f[0])):
            if all(notice[3] <= k[2] or notice[2] >= k[3] for k in kept):
                kept.append(notice)
        return sorted(kept, key=lambda k: k[2])

    @staticmethod
    def _stretches(where: dict, single: dict, size: int, total: int) -> list[tuple[int, int]]:
        """Stretches of words in which the template may stand. Starts voted for
        by its single words are binned; neighbouring bins vote together, as
        added words shift the votes."""
        starts = np.array([at - offset for word, offset in single.items()
                           for at in where.get(word, ())], np.int64)
        if not len(starts):
            # Without single words every part of the text is a candidate.
            step = max(1, size // 2)
            return [(low, min(total, low + 2 * size)) for low in range(0, total, step)]
        pad = max(2, size // 4)
        bins, votes = np.unique(starts // pad, return_counts=True)
        shift = {b: v for b, v in zip(bins.tolist(), votes.tolist())}
        needed = max(1, int(VOTES * len(single)))
        wide = [(max(0, b * pad - pad), min(total, (b + 2) * pad + size))
                for b in shift if shift[b] + shift.get(b + 1, 0) >= needed]
        # Unchanged notices side by side: the exact stretch of each.
        exact, votes = np.unique(starts, return_counts=True)
        return wide + [(max(0, at), min(total, at + size))
                       for at in exact[votes >= needed].tolist() if at + size > 0]


def scan_documents(docs: DataFrame, templates: dict[str, str] = TEMPLATES,
                   coverage: float = COVERAGE) -> DataFrame:
    """doc_id, the widest notice (license, coverage, start, stop), n_found and
    all notices as structs."""
    scanner = Scanner(templates, coverage)

    def work(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {n: [] for n in ("license", "coverage", "start", "stop", "n_found", "notices")}
        for text in batch.column(1).to_pylist():
            found = scanner.scan(text or "")
            best = max(found, key=lambda f: (f[4], f[1], -f[2]), default=(None, 0.0, None, None, 0))
            for name, cell in zip(out, (*best[:4], len(found), [
                    {"license": f[0], "coverage": f[1], "start": f[2], "stop": f[3]} for f in found])):
                out[name].append(cell)
        return {"doc_id": batch.column(0)} | out

    return map_batches(docs.select("doc_id", "text"), work,
                       "doc_id long, license string, coverage double, start long, stop long, n_found long, "
                       "notices array<struct<license:string,coverage:double,start:long,stop:long>>")
