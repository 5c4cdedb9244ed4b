"""License scan: winnowed fingerprints of templates in an inverted index pick candidates, banded alignment measures them.

Words are runs of letters and digits, A-Z folded. A fingerprint is a word of a template; of every ``window`` neighbouring words the one
that fewest templates have is kept (then the one of smallest hash, then the last). The window is set by the coverage: a match may
lack only so many of a template's words that some ``window`` neighbours are all there, whatever is put between them, so it
holds a fingerprint; and as each lost word costs one fingerprint at most, it holds all but so many of them. Texts, stretches
of a text and diagonals with fewer are ruled out without loss, and so are stretches with too few of the template's words.

Hits of one template on neighbouring diagonals are a place; there template and text are aligned in a band
around the diagonals, which gives the matched words, their share of the template (coverage) and the span of the text.
Of overlapping matches the one with the most matched words stays, then the one with the higher coverage. What lies between the
matches that stay is aligned again until nothing more is found, so repeats on neighbouring lines are each reported.

Spans are code points, the end exclusive. NULL and empty texts match nothing. Repeated rows are reported each. An empty
table or no templates give an empty result. Other columns, whatever their names, are not read. Very long texts are read like others.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineside.llm.common import hashes, runs, slices, text_bytes

BAND = 6
COVERAGE = 0.75
# Licences in full, and the notices by which works state their licence.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "mit-line": "Released under the MIT License.",
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."),
    "bsd-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met."),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT "
        "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES "
        "OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" "
        "AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
        "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS "
        "SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
        "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO "
        "EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
        "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
        "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
        "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE."),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
        "any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, "
        "including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The "
        "origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this "
        "software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered "
        "source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This "
        "notice may not be removed or altered from any source distribution."),
    "bsl-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and "
        "transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is "
        "furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including "
        "the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in "
        "whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of "
        "machine-executable object code generated by a source language processor."),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial "
        "or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software "
        "dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the "
        "public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of "
        "relinquishment in perpetuity of all present and future rights to this software under copyright law."),
}
_kind = np.zeros(256, np.uint8)
_kind[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def hashed_words(column: pa.Array) -> tuple:
    raw, at = text_bytes(column)
    begin, end, first = runs(_kind[raw], at)
    return raw, at, begin, end, first, hashes(raw, begin, end, lower=True)


def needed(n: int, coverage: float) -> int:
    """Words of a template of ``n`` that a match has at least."""
    return max(1, math.ceil(coverage * n))


def winnow(rank: np.ndarray, window: int) -> np.ndarray:
    """Position of the smallest rank (the last one of equals) of each ``window`` neighbours."""
    kept = set()
    for i in range(max(1, len(rank) - window + 1)):
        own = rank[i:i + window]
        if len(own):
            kept.add(i + len(own) - 1 - int(np.argmin(own[::-1])))
    return np.array(sorted(kept), np.int64)


class Template:
    """A template's words, and where its fingerprints stand; ``spots`` are their numbers in the index."""

    def __init__(self, name: str, words: np.ndarray, coverage: float, held_by: dict[int, int]) -> None:
        self.name, self.words = name, words
        self.distinct = np.unique(words)
        self.need = needed(len(words), coverage)
        lost = len(words) - self.need
        rarest = sorted(set(words.tolist()), key=lambda w: (held_by[w], w))
        place = {w: i for i, w in enumerate(rarest)}
        # Words that are left out move what follows them to another diagonal.
        self.band = max(BAND, lost)
        # Of so many neighbours at least, none is among the lost ones.
        self.window = max(1, math.ceil(self.need / (lost + 1)))
        self.at = winnow(np.array([place[w] for w in words.tolist()]), self.window)
        self.prints = words[self.at]
        self.need_prints = max(1, len(self.at) - lost)
        self.spots = np.empty(0, np.int64)


def template_index(texts: dict[str, str], coverage: float) -> tuple[list[Template], np.ndarray, np.ndarray]:
    """The templates; all fingerprints, sorted; how often each template has each: the inverted index."""
    names = sorted(texts)
    words = [hashed_words(pa.array([texts[name]]))[-1] for name in names]
    held_by: dict[int, int] = defaultdict(int)
    for own in words:
        for w in set(own.tolist()):
            held_by[w] += 1
    templates = [Template(name, own, coverage, held_by) for name, own in zip(names, words) if len(own)]
    keys = np.unique(np.concatenate([np.empty(0, np.uint64), *[t.prints for t in templates]]))
    for t in templates:
        t.spots = np.searchsorted(keys, t.prints)
    counts = np.array([np.bincount(t.spots, minlength=len(keys)) for t in templates]).reshape(len(templates), len(keys))
    return templates, keys, counts


def possible(text: np.ndarray, code: np.ndarray, texts: int, counts: np.ndarray, templates: list[Template]) -> Iterator[tuple[int, int]]:
    """Texts and templates such that the text holds enough of the template's fingerprints; ``text`` and ``code`` say which one is where."""
    present = np.unique(text * counts.shape[1] + code)
    text, code = np.divmod(present, counts.shape[1])
    for t, own in enumerate(counts):
        n = np.bincount(text, weights=own[code], minlength=texts)
        yield from ((int(x), t) for x in np.flatnonzero(n >= templates[t].need_prints))


def hits_near(at: np.ndarray, code: np.ndarray, own: np.ndarray, template: Template) -> tuple[np.ndarray, np.ndarray]:
    """Sorted diagonals of the hits of one template and the words they come from, without hits that have too few near them to
    be in a match: no match is longer than the template and the widest band."""
    keep = own[code] > 0
    at, code = at[keep], code[keep]
    reach = len(template.words) + 4 * template.band
    dense = np.searchsorted(at, at + reach, "right") - np.searchsorted(at, at - reach) >= template.need_prints
    at, code = at[dense], code[dense]
    order = np.argsort(template.spots, kind="stable")
    n = own[code]
    first = np.repeat(np.searchsorted(template.spots[order], code) - (np.cumsum(n) - n), n)
    at = np.repeat(at, n)
    diagonals = at - template.at[order[first + np.arange(len(at))]]
    order = np.lexsort((at, diagonals))
    return diagonals[order], at[order]


def align(a: np.ndarray, b: np.ndarray, shift: int, band: int, need: int = 1) -> tuple[int, int, int]:
    """Local alignment of template ``a`` and text ``b`` with word i of ``a`` near word ``i + shift`` of ``b``.

    Equal words score 2, a changed, missing or added one costs 1. Returns matched words and the first and last of
    ``b`` (exclusive) of the best one with ``need`` matched words, or no words; ties go to the earlier end."""
    width = 2 * band + 1
    none = (0, 0, -1, -1)  # score, matched, first, last
    above = [none] * (width + 1)
    best = none
    for i, x in enumerate(a.tolist()):
        row = [none] * (width + 1)
        for d in range(width):
            j = i + shift + d - band
            if not 0 <= j < len(b):
                continue
            s, m, first, last = above[d]
            if int(b[j]) == x:
                cell = (s + 2, m + 1, j if first < 0 else first, j + 1)
            else:
                cell = (s - 1, m, first, last)
            up, left = above[d + 1], row[d - 1] if d else none
            for c in (up, left):
                if c[0] - 1 > cell[0]:
                    cell = (c[0] - 1, *c[1:])
            row[d] = cell if cell[0] > 0 else none
            if row[d][0] > best[0] and row[d][1] >= need:
                best = row[d]
        above = row
    return best[1], best[2], best[3]


def places(diagonals: np.ndarray, at: np.ndarray, band: int, need: int) -> Iterator[tuple[int, int]]:
    """Diagonal to align along and width of the band: sorted diagonals not further apart than the band are one place, and each
    has the whole band around it. Bands with fewer than ``need`` different words of the template are left out."""
    i = 0
    while i < len(diagonals):
        j = int(np.searchsorted(diagonals, diagonals[i] + band, "right"))
        low, high = int(diagonals[i]), int(diagonals[j - 1])
        shift = (low + high) // 2
        wide = band + high - shift
        x, y = np.searchsorted(diagonals, [shift - wide, shift + wide + 1])
        if y - x >= need and len(np.unique(at[x:y] - diagonals[x:y])) >= need:
            yield shift, wide
        i = j


def matches(
    b: np.ndarray, hits: dict[int, tuple[np.ndarray, np.ndarray]], templates: list[Template],
) -> list[tuple[int, int, int, int]]:
    """Matches in the text ``b`` that do not overlap: template, matched words, first and last (exclusive) word. ``hits`` has the
    sorted diagonals of each template and the words of ``b`` they come from."""
    out: list[tuple[int, int, int, int]] = []
    taken: list[tuple[int, int]] = []
    todo = [(t, 0, len(b), *own) for t, own in hits.items()]
    while todo:
        found, again = [], []
        for t, lo, hi, diagonals, at in todo:
            own, seen = templates[t], len(found)
            n, need = len(own.words), own.need
            for shift, band in places(diagonals, at, own.band, own.need_prints):
                x, y = max(lo, shift - band), min(hi, shift + n + band)
                if np.count_nonzero(np.isin(b[x:y], own.distinct)) < need:
                    continue  # too few of the template's words, in any order
                m, first, last = align(own.words, b[lo:hi], shift - lo, band, need)
                if m:
                    found.append((-m, -m / n, own.name, lo + first, lo + last, t))
            if len(found) > seen:
                again.append((t, lo, hi, diagonals, at))
        for m, _, _, first, last, t in sorted(set(found)):
            i = bisect_left(taken, (first, last))
            if (not i or taken[i - 1][1] <= first) and (i == len(taken) or last <= taken[i][0]):
                taken.insert(i, (first, last))
                out.append((t, -m, first, last))
        todo = []
        for t, lo, hi, diagonals, at in again:
            inside = np.array(taken[bisect_left(taken, (lo, lo)):bisect_left(taken, (hi, hi))], np.int64).reshape(-1, 2)
            left, right = np.append(lo, inside[:, 1]), np.append(inside[:, 0], hi)
            gap = np.searchsorted(left, at, "right") - 1
            order = np.flatnonzero(at < right[gap])
            order = order[np.argsort(gap[order], kind="stable")]  # by gap, then by diagonal
            for own in np.split(order, np.flatnonzero(np.diff(gap[order])) + 1) if len(order) else []:
                k = gap[own[0]]
                todo.append((t, int(left[k]), int(right[k]), diagonals[own], at[own]))
    return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """One row per match in ``docs`` (doc_id, text): doc_id, license, coverage, matched (words), start, end."""
    own = TEMPLATES if templates is None else templates

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, keys, counts = template_index(own, coverage)
        for part in slices(batches, "text"):
            raw, at, begin, end, first, h = hashed_words(part.column("text"))
            rows = []
            if len(keys) and len(h):
                spot = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                hits = np.flatnonzero(keys[spot] == h)
                code = spot[hits]
                text = np.searchsorted(first, hits, "right") - 1
                by_text: dict[int, list[int]] = defaultdict(list)
                for n, t in possible(text, code, part.num_rows, counts, index):
                    by_text[n].append(t)
                ids = part.column("doc_id")
                for n, found in sorted(by_text.items()):
                    b = h[first[n]:first[n + 1]]
                    x, y = np.searchsorted(hits, [first[n], first[n + 1]])
                    sides = {t: hits_near(hits[x:y] - first[n], code[x:y], counts[t], index[t]) for t in found}
                    for t, m, lo, hi in matches(b, sides, index):
                        start, stop = int(begin[first[n] + lo]), int(end[first[n] + hi - 1])
                        before = np.count_nonzero((raw[at[n]:start] & 0xC0) != 0x80)
                        inside = np.count_nonzero((raw[start:stop] & 0xC0) != 0x80)
                        rows.append((ids[n].as_py(), index[t].name, m / len(index[t].words), m, before, before + inside))
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "license", "coverage", "matched", "start", "end"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        find, "doc_id long, license string, coverage double, matched long, start long, end long")
