"""License scan: winnowed fingerprints, then banded alignment.

A license has one or more templates: whole texts, headers, notices and SPDX
lines. Each is cut into words; of every few consecutive hashes of word grams the
smallest is kept and goes into an inverted index (bounded by the templates,
shared with the tasks). Gram and winnowing window follow a template's length, so
that a text with ``COVERAGE`` of its words in place, others replaced or left
out, always shares a fingerprint with it (``lengths``). The same hashes of a
whole document that are in the index name template and diagonal; around each
diagonal a banded alignment of words gives the matched coverage and the span.
Of overlapping matches the one with the most matched words stays (then the
higher coverage), so a license is not reported for the words it shares with another.

Null and empty texts match nothing; each occurrence is a row; other columns are ignored.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.textkit import sequence_hashes, utf8, words

GRAM, BAND, COVERAGE = 3, 4, 0.75
# Public license texts, headers and notices.
AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES '
         "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
         "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
         "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
TEMPLATES = {
    "mit": ("Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
            "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
            "furnished to do so, subject to the following conditions:",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + AS_IS),
    "gpl-3.0": ("This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "gpl-2.0": ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0.",),
    "cc-by-4.0": ("Licensed under CC BY 4.0.",),
    "cc-by-sa-4.0": ("Licensed under CC BY-SA 4.0.",),
    "apache-2.0": ("Licensed under the Apache License, Version 2.0.",
                   'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
                   'to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF '
                   "ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,",),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
}
SPDX = {"mit": "MIT", "gpl-3.0": "GPL-3.0-or-later", "gpl-2.0": "GPL-2.0-or-later", "cc-by-nc-4.0": "CC-BY-NC-4.0", "cc-by-4.0": "CC-BY-4.0",
        "cc-by-sa-4.0": "CC-BY-SA-4.0", "apache-2.0": "Apache-2.0", "bsd": "BSD-3-Clause", "isc": "ISC", "mpl-2.0": "MPL-2.0"}
TEMPLATES = {k: (*v, f"SPDX-License-Identifier: {SPDX[k]}") for k, v in TEMPLATES.items()}
KEEP = np.arange(256, dtype=np.uint8)
KEEP[[ord(c) for c in ".,;:()\"'!"]] = 32


def _words(data):
    return words(KEEP[data])


def lengths(n: int) -> tuple[int, int]:
    """(gram, winnowing window) for a template of ``n`` words: with a share of
    ``COVERAGE`` kept, the longest unbroken run has ``run`` words at least,
    and a run of gram + window - 1 words shares a fingerprint."""
    gone = int(n * (1 - COVERAGE))
    run = -(-(n - gone) // (gone + 1))
    return min(GRAM, run), max(1, run - GRAM + 1)


def index(templates: dict[str, tuple[str, ...]]):
    """(license of each template, {gram: (sorted hashes, [(template, place)] of each)}, word hashes of each template)."""
    names, seqs, found = [], [], {}
    for name, texts in templates.items():
        for text in texts:
            h = _words(np.frombuffer(text.encode(), np.uint8))[0]
            if not len(h):
                continue
            gram, window = lengths(len(h))
            g, inv = sequence_hashes(h, gram), found.setdefault(gram, {})
            for a in range(max(1, len(g) - window + 1)):
                k = a + int(np.argmin(g[a:a + window]))
                inv.setdefault(int(g[k]), set()).add((len(names), k))
            names.append(name)
            seqs.append(h)
    return names, {gram: (np.array(sorted(inv), dtype=np.uint64), inv) for gram, inv in found.items()}, seqs


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """(matched words of ``a``, first, last matched place in ``b``) of the
    longest common subsequence within ``BAND`` of the middle diagonal."""
    prev: dict = {}
    for i in range(len(a)):
        cur: dict = {}
        for j in range(max(0, i), min(len(b), i + 2 * BAND + 1)):
            best = max(prev.get(j, (0, 0, -1)), cur.get(j - 1, (0, 0, -1)), key=lambda x: x[0])
            if a[i] == b[j]:
                n, s, _ = prev.get(j - 1, (0, j, -1))
                if n + 1 > best[0]:
                    best = (n + 1, s if n else j, j)
            cur[j] = best
        prev = {**{k: v for k, v in prev.items() if k < i}, **cur}
    return max(prev.values(), key=lambda x: x[0], default=(0, 0, -1))


def scan_text(data: np.ndarray, idx) -> list[tuple[str, float, int, int]]:
    """(license, coverage, start, end) of the matches, in bytes."""
    names, grams, seqs = idx
    h, starts, ends = _words(data)
    places = set()
    for gram, (keys, inv) in grams.items():
        g = sequence_hashes(h, gram)
        at = np.flatnonzero(keys[np.minimum(np.searchsorted(keys, g), len(keys) - 1)] == g)
        places |= {(i, p - k) for p in at.tolist() for i, k in inv[int(g[p])]}
    out = set()
    for i, first in places:         # each diagonal once
        lo = max(0, first - BAND)
        pad = BAND - (first - lo)
        n, s, e = align(seqs[i], np.concatenate([np.zeros(pad, np.uint64), h[lo:max(lo, first + len(seqs[i]) + BAND)]]))
        if n / len(seqs[i]) >= COVERAGE:
            out.add((-n, -n / len(seqs[i]), names[i], lo + s - pad, lo + e - pad))
    kept: list[tuple[str, float, int, int]] = []
    taken: list[tuple[int, int]] = []
    for _, cov, name, s, e in sorted(out):
        j = bisect.bisect_left(taken, (s, s))      # kept spans do not overlap, so only its neighbours can
        if (j == 0 or taken[j - 1][1] < s) and (j == len(taken) or taken[j][0] > e):
            taken.insert(j, (s, e))
            kept.append((name, -cov, int(starts[s]), int(ends[e])))
    return sorted(kept)


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES) -> DataFrame:
    """doc_id, license, coverage, start, end (code points) of each match."""
    def run(batches):
        idx = index(templates)
        for b in batches:
            data, off = utf8(b.column(1))
            rows = []
            for i, d in enumerate(b.column(0).to_pylist()):
                t = data[off[i]:off[i + 1]]
                for name, cov, s, e in scan_text(t, idx):
                    lead = (t[:e] & 0xC0) != 0x80
                    rows.append((d, name, cov, int(lead[:s].sum()), int(lead.sum())))
            c = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(c, (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()), strict=True)],
                                             names=["doc_id", "license", "coverage", "start", "end"])
    return docs.select(F.col("doc_id"), F.col("text")).mapInArrow(run, "doc_id long, license string, coverage double, start long, end long")
