"""License statements in documents, by patience alignment.

A text's words are looked up in the vocabulary of all templates; only stretches that are dense in the words of a template
are aligned with it. Alignment anchors on words that occur once in the stretch and once in the template, keeps the longest
increasing subsequence of the anchors, and goes on the same way in the gaps between them, where other words have become
unique; a gap without such words is aligned by longest common subsequence. A stretch with the words of a template twice is
cut after its first statement, and what is left on both sides of a match is searched again. The share of the template's words
that found a partner is its coverage.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import words

MIN_COVERAGE = 0.8
STRETCH = 1.5
SLACK = 8

# License statements and whole license texts, as they are commonly given.
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_BSD_THIRD = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission."
)
_BSD_WARRANTY = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
    "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
    "above copyright notice and this permission notice appear in all copies."
)
_ISC_WARRANTY = (
    ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
    "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
    "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
)
_MIT_WARRANTY = (
    ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "BSD-2-Clause": _BSD + _BSD_WARRANTY,
    "BSD-3-Clause": _BSD + _BSD_THIRD + _BSD_WARRANTY,
    "BSD-conditions": _BSD,
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the "
        "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details."
    ),
    "ISC": _ISC + _ISC_WARRANTY,
    "ISC-grant": _ISC,
    "MIT": "Released under the MIT License.",
    "MIT-grant": _MIT,
    "MIT-text": _MIT + _MIT_WARRANTY,
    "proprietary": "All rights reserved.",
}


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of pairs (sorted by the first) whose seconds increase, by patience sorting."""
    tops: list[int] = []
    last: list[int] = []
    back = [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        pile = bisect.bisect_left(tops, b)
        back[i] = last[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(b)
            last.append(i)
        else:
            tops[pile], last[pile] = b, i
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def _ends(a: list, b: list) -> list[int]:
    """For each n up to len(a), the longest common subsequence of a[:n] and b."""
    row, out = [0] * (len(b) + 1), [0]
    for x in a:
        corner = 0
        for j, y in enumerate(b, 1):
            up = row[j]
            row[j] = corner + 1 if x == y else max(up, row[j - 1])
            corner = up
        out.append(row[-1])
    return out


def _common(a: list, b: list) -> list[tuple[int, int]]:
    """A longest common subsequence of two lists, as index pairs; halves a, in linear memory."""
    if not a or not b:
        return []
    if len(a) == 1:
        return [(0, b.index(a[0]))] if a[0] in b else []
    half = len(a) // 2
    left, right = _ends(b, a[:half]), _ends(b[::-1], a[half:][::-1])
    cut = max(range(len(b) + 1), key=lambda j: left[j] + right[len(b) - j])
    return _common(a[:half], b[:cut]) + [(half + i, cut + j) for i, j in _common(a[half:], b[cut:])]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs (i, j), increasing in both, of equal items a[i] == b[j]."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        while i0 < i1 and j0 < j1 and a[i0] == b[j0]:
            found.append((i0, j0))
            i0, j0 = i0 + 1, j0 + 1
        while i0 < i1 and j0 < j1 and a[i1 - 1] == b[j1 - 1]:
            i1, j1 = i1 - 1, j1 - 1
            found.append((i1, j1))
        if i0 >= i1 or j0 >= j1:
            continue
        na, nb = Counter(a[i0:i1]), Counter(b[j0:j1])
        at = {b[j]: j for j in range(j0, j1) if nb[b[j]] == 1}
        anchors = _increasing([(i, at[a[i]]) for i in range(i0, i1) if na[a[i]] == 1 and a[i] in at])
        if not anchors:
            found += [(i0 + i, j0 + j) for i, j in _common(a[i0:i1], b[j0:j1])]
            continue
        found += anchors
        for (i, j), (k, m) in zip([(i0 - 1, j0 - 1), *anchors], [*anchors, (i1, j1)], strict=True):
            todo.append((i + 1, k, j + 1, m))
    return sorted(found)


def _stretches(at: np.ndarray, term: np.ndarray, need: Counter, share: float) -> list[tuple[int, int]]:
    """Word ranges of a text that hold enough words of a template; at: positions of its words, term: which.

    A template's word counts as often as the template has it. No alignment can have more words than that, so no match within
    such a range is passed over.
    """
    length = need.total()
    reach = int(STRETCH * length) + SLACK
    out: list[tuple[int, int]] = []
    counts: Counter = Counter()
    lo = shared = 0
    for hi, x in enumerate(term.tolist()):
        counts[x] += 1
        shared += counts[x] <= need[x]
        while at[hi] - at[lo] >= reach:
            y = int(term[lo])
            shared -= counts[y] <= need[y]
            counts[y] -= 1
            lo += 1
        if shared >= share * length:
            span = (int(at[lo]), int(at[hi]) + 1)
            if out and span[0] < out[-1][1] and span[1] - out[-1][0] <= 2 * reach:
                out[-1] = (out[-1][0], span[1])
            else:
                out.append(span)
    return out


def _first_end(a: list, b: list, least: float) -> int:
    """Where the first statement of b in a ends: after so many common words, as long as most further words add one."""
    ends = _ends(a, b)
    first = next((n for n, x in enumerate(ends) if x >= least), len(a))
    return max(range(first, len(a) + 1), key=lambda n: (2 * ends[n] - n, -n))


def matches(a: list, b: list, share: float) -> list[list[tuple[int, int]]]:
    """Alignments of b with parts of a that don't overlap, each with at least this share of b."""
    out, todo, need = [], [(0, len(a))], Counter(b)
    while todo:
        lo, hi = todo.pop()
        has = Counter(a[lo:hi])
        if sum(min(n, has[x]) for x, n in need.items()) < share * len(b):
            continue
        i, j = lo, hi
        if sum(min(2 * n, has[x]) for x, n in need.items()) >= 2 * share * len(b):
            j = lo + _first_end(a[lo:hi], b, share * len(b))
            i = j - _first_end(a[lo:j][::-1], b[::-1], share * len(b))
        pairs = [(i + x, y) for x, y in align(a[i:j], b)]
        if len(pairs) < share * len(b) and (i, j) != (lo, hi):
            pairs = [(i + x, y) for x, y in _common(a[i:j], b)]
        if len(pairs) >= share * len(b):
            out.append(pairs)
            todo += [(lo, pairs[0][0]), (pairs[-1][0] + 1, hi)]
    return out


MATCHES = "array<struct<license: string, start: bigint, end: bigint, coverage: double>>"


def scan(docs: DataFrame, text: str = "text", templates: dict[str, str] | None = None, min_coverage: float = MIN_COVERAGE, name: str = "licenses") -> DataFrame:
    """docs with ``name``: matches (license, start, end, coverage) in order; start and end count words of the whole text.

    A match lies within a stretch of STRETCH times the template's words. Words are runs of digits, letters and non-ASCII bytes,
    A-Z as a-z. Of matches that overlap, the one with more aligned
    words stays (then the one of the smaller name). Null and empty texts have no matches. All rows and other columns
    stay, and a column called ``name`` is replaced; an empty table gives no rows.
    """
    forms = {k: words.split(pa.array([v]), "alnum_lower").h for k, v in sorted((templates or TEMPLATES).items())}
    vocabulary = np.unique(np.concatenate(list(forms.values())))
    own = {k: np.searchsorted(vocabulary, h) for k, h in forms.items()}
    needs = {k: np.bincount(ids, minlength=len(vocabulary)) for k, ids in own.items()}
    base = docs.drop(name)
    columns = base.columns

    def one(term: np.ndarray) -> list[dict]:
        """term: for each word of a text its place in the vocabulary, or -1."""
        at_all = np.flatnonzero(term >= 0)
        has = np.bincount(term[at_all], minlength=len(vocabulary))
        found = []
        for k, ids in own.items():
            if np.minimum(has, needs[k]).sum() < min_coverage * len(ids):
                continue
            at = at_all[np.isin(term[at_all], ids)]
            for lo, hi in _stretches(at, term[at], Counter(ids.tolist()), min_coverage):
                for pairs in matches(term[lo:hi].tolist(), ids.tolist(), min_coverage):
                    found.append((-len(pairs), k, lo + pairs[0][0], lo + pairs[-1][0] + 1, len(pairs) / len(ids)))
        kept: list[dict] = []
        for _, k, lo, hi, share in sorted(found):
            if all(hi <= x["start"] or lo >= x["end"] for x in kept):
                kept.append({"license": k, "start": lo, "end": hi, "coverage": share})
        return sorted(kept, key=lambda x: x["start"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())]))
        for batch in batches:
            for piece in words.slices(batch, text):
                w = words.split(piece.column(text), "alnum_lower")
                i = np.minimum(np.searchsorted(vocabulary, w.h), len(vocabulary) - 1)
                term = np.where(vocabulary[i] == w.h, i, -1)
                # vocabulary words of each text, to pass over the many that hold too few of any template
                hit = term >= 0
                size = len(vocabulary)
                has = np.bincount(w.doc[hit].astype(np.int64) * size + term[hit], minlength=piece.num_rows * size).reshape(piece.num_rows, size)
                likely = np.zeros(piece.num_rows, bool)
                for k, ids in own.items():
                    mine = np.unique(ids)
                    likely |= np.minimum(has[:, mine], needs[k][mine]).sum(axis=1) >= min_coverage * len(ids)
                first = w.first
                found = [one(term[first[d] : first[d + 1]]) if likely[d] else [] for d in range(piece.num_rows)]
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in columns), pa.array(found, kind)], names=[*columns, name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(run, f"{fields}, `{name}` {MATCHES}")


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    """License statements of every document: how many, which, how many words they take, and the best coverage."""
    out = scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("licenses", lambda x: x["license"]))), ",").alias("licenses"),
        F.aggregate("licenses", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"]).alias("license_words"),
        F.coalesce(F.array_max(F.transform("licenses", lambda x: x["coverage"])), F.lit(0.0)).alias("best_coverage"),
        F.coalesce(F.get(F.transform("licenses", lambda x: x["start"]), 0), F.lit(-1).cast("long")).alias("first_start"),
    )


ORACLE_SQL = None
