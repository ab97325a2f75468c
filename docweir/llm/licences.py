"""Licence scans: winnowed fingerprints of templates pick candidates, banded alignment measures what matches."""

from __future__ import annotations

import bisect
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from docweir.llm.common import read, tidy

#: Words of a fingerprinted gram, and grams of a winnowing window: a run of GRAM + WINDOW - 1 shared words is always found.
GRAM, WINDOW = 3, 3
#: How far an alignment may drift from its diagonal, in words, besides a tenth of the template.
BAND = 8
#: Least part of a template's words that a reported match covers.
COVERAGE = 0.7
_WORD = re.compile(rb"[a-z0-9]+")
_MEMO = 500_000

# Public licence notices and texts.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
    "mit-line": "Released under the MIT License.",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS
BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "bsd-conditions": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list
of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution.""",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
details.""",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc0-1.0": """To the extent possible under law, the author has waived all copyright and related or neighboring rights to
this work.""",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means.""",
}


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def grams(words: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hashes of the grams of a row of word hashes; of all of it where it is shorter."""
    span = min(gram, len(words))
    out = np.zeros(max(0, len(words) - span + 1), np.uint64)
    for i in range(span):
        out = (out ^ (out >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + words[i : i + len(out)]
    return out ^ (out >> np.uint64(32))


def winnow(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the fingerprints: in every window the least hash, the last of equal ones."""
    if len(hashes) <= window:
        return np.array([len(hashes) - 1 - int(np.argmin(hashes[::-1]))]) if len(hashes) else np.empty(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(hashes, window)
    return np.unique(np.arange(len(view)) + window - 1 - np.argmin(view[:, ::-1], axis=1))


def align(template: np.ndarray, text: np.ndarray, shift: int, band: int) -> tuple[int, int, int] | None:
    """Longest common subsequence of template and text near the diagonal text = template + shift.

    Only cells within band of the diagonal are filled. Returns matched words and the span of text
    words from the first to the last of them.
    """
    width = 2 * band + 1
    size = len(template)
    best = np.zeros((size + 1, width + 1), np.int32)
    for i in range(size):
        lo = i + shift - band
        js = np.arange(lo, lo + width)
        inside = (js >= 0) & (js < len(text))
        same = np.zeros(width, bool)
        same[inside] = text[js[inside]] == template[i]
        # In band coordinates, the cell before on the diagonal has the same column, the one above the next.
        row = np.maximum(best[i, :width] + same, best[i, 1:])
        best[i + 1, :width] = np.maximum.accumulate(row)
    total = int(best[size, width - 1])
    if not total:
        return None
    i, k, first, last = size, int(np.argmax(best[size, :width] == total)), None, None
    while i > 0 and best[i, k] > 0:
        j = i - 1 + shift - band + k
        if k and best[i, k] == best[i, k - 1]:
            k -= 1
        elif 0 <= j < len(text) and text[j] == template[i - 1] and best[i, k] == best[i - 1, k] + 1:
            last = j if last is None else last
            first = j
            i -= 1
        else:
            i, k = i - 1, k + 1
    return total, first, last


def tightest(template: np.ndarray, text: np.ndarray, shift: int, band: int, lo: int, hi: int, need: float) -> tuple[int, int, int] | None:
    """Like align, within text[lo:hi] only: the match that ends first, from the latest word that it can begin with; None below need words."""
    lo, hi = max(lo, shift - band), min(hi, shift + len(template) + band)
    part = text[lo:hi]
    # No alignment matches more words than template and text have in common in any order.
    kinds, counts = np.unique(template, return_counts=True)
    at = np.minimum(np.searchsorted(kinds, part), len(kinds) - 1)
    if np.minimum(np.bincount(at[kinds[at] == part], minlength=len(kinds)), counts).sum() < need:
        return None
    got = align(template, part, shift - lo, band)
    if not got or got[0] < need:
        return None
    total, _, last = got
    back = align(template[::-1], part[last::-1], last + 1 - len(template) - (shift - lo), band)
    return total, lo + last - back[2], lo + last


class Index:
    """Inverted index of the templates' fingerprints: sorted hashes, with template and place of each."""

    def __init__(self, templates: dict[str, str], gram: int = GRAM, window: int = WINDOW) -> None:
        self.gram, self.window, self.memo = gram, window, _Words()
        self.names = sorted(templates)
        self.words = [self.hashed(templates[n].encode().lower()) for n in self.names]
        rows = [(int(g[p]), t, int(p)) for t, words in enumerate(self.words) for g in [grams(words, gram)] for p in (winnow(g, window) if len(words) >= gram + window - 1 else range(len(g)))]
        rows.sort()
        self.hashes = np.array([r[0] for r in rows], np.uint64)
        self.owner, self.place = (np.array([r[i] for r in rows], np.int64) for i in (1, 2))
        #: Grams of templates too short for winnowing to be sure of them; all grams of a text are looked up in these.
        self.short = np.unique(np.concatenate([np.empty(0, np.uint64), *(grams(w, gram) for w in self.words if 0 < len(w) < gram + window - 1)]))

    def hashed(self, lowered: bytes) -> np.ndarray:
        found = _WORD.findall(lowered)
        return np.fromiter(map(self.memo.__getitem__, found), np.uint64, len(found))

    def aligned(self, t: int, words: np.ndarray, hits: list[tuple[int, int]], coverage: float) -> list[tuple[int, int, int]]:
        """Disjoint matches (matched words, first, last word) of a template, from hits (place in the text, shift).

        The fullest and then shortest match is taken first. A hit outside of what is taken is aligned
        anew in the gap where it lies, until it is in a match or has none.
        """
        template = self.words[t]
        band, need = min(BAND + len(template) // 10, len(template)), coverage * len(template)
        taken: list[tuple[int, int, int]] = []  # first, last, matched; sorted
        known: dict[tuple[int, int, int], tuple[int, int, int] | None] = {}
        heap: list[tuple] = []

        def offer(place: int, shift: int) -> None:
            # A gram that a taken match cuts counts for the gap that its other end is in.
            for p in (place, place + self.gram - 1):
                i = bisect.bisect_right(taken, p, key=lambda m: m[0])
                if i and p <= taken[i - 1][1]:
                    continue
                gap = taken[i - 1][1] + 1 if i else 0, taken[i][0] if i < len(taken) else len(words)
                if (shift, *gap) not in known:
                    known[shift, *gap] = tightest(template, words, shift, band, *gap, need)
                if got := known[shift, *gap]:
                    heapq.heappush(heap, (-got[0], got[2] - got[1], got[1], got[2], place, shift))
                return

        for place, shift in hits:
            offer(place, shift)
        while heap:
            n, _, first, last, place, shift = heapq.heappop(heap)
            i = bisect.bisect_right(taken, last, key=lambda m: m[0])
            if not i or taken[i - 1][1] < first:
                taken.insert(i, (first, last, -n))
            offer(place, shift)
        return [(n, first, last) for first, last, n in taken]

    def matches(self, text: str, coverage: float = COVERAGE) -> list[tuple[str, int, float, int, int]]:
        """(template, matched words, coverage, first and last-plus-one character) of every match in a whole text."""
        lowered = text.encode("utf-8", "surrogatepass").lower()  # A-Z only
        words = self.hashed(lowered)
        hashes = grams(words, self.gram)
        at = winnow(hashes, self.window)
        if len(self.short) and len(hashes):
            near = np.minimum(np.searchsorted(self.short, hashes), len(self.short) - 1)
            at = np.union1d(at, np.flatnonzero(self.short[near] == hashes))
        left, right = np.searchsorted(self.hashes, hashes[at], "left"), np.searchsorted(self.hashes, hashes[at], "right")
        hits: dict[int, list[tuple[int, int]]] = {}
        for p, lo, hi in zip(at[left < right], left[left < right], right[left < right]):
            for row in range(lo, hi):
                hits.setdefault(int(self.owner[row]), []).append((int(p), int(p - self.place[row])))
        found = [(t, *got) for t, places in hits.items() for got in self.aligned(t, words, places, coverage)]
        if not found:
            return []
        places = [m.span() for m in _WORD.finditer(lowered)]
        char = lambda byte: len(lowered[:byte].decode("utf-8", "surrogatepass"))
        spans = [(self.names[t], n, n / len(self.words[t]), char(places[first][0]), char(places[last][1])) for t, n, first, last in found]
        return sorted(spans, key=lambda m: (m[3], m[4], m[0]))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """One row per match: id, licence, matched_words, coverage, span_start, span_end (characters, end exclusive).

    Words are runs of ASCII letters and digits, A-Z lower-cased. A template may match a text more than
    once, and texts may hold several; a notice that is part of a longer template is reported beside it.
    A null or empty text matches nothing; rows that repeat give rows that repeat; an empty table
    gives none. Whole texts are scanned, in time linear in their length but for what is aligned. Other columns are not read.
    """
    chosen = TEMPLATES if templates is None else templates
    narrow = docs.select(id_col, text_col)
    kind = dict(narrow.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(chosen)
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                which, rows = [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    for match in index.matches(text, coverage) if text else ():
                        which.append(i)
                        rows.append(match)
                columns = list(zip(*rows)) if rows else [[]] * 5
                kinds = (pa.string(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(which, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=[id_col, "licence", "matched_words", "coverage", "span_start", "span_end"])

    return narrow.mapInArrow(tidy(run), f"`{id_col}` {kind}, licence string, matched_words long, coverage double, span_start long, span_end long")


def op3_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices and texts in all documents."""
    return scan(read(spark, sf_dir, "documents"))
