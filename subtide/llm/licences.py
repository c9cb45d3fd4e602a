"""Licence scan: texts against licence templates by Dice coefficient over word bigrams.

The units of a document are its whole text and each of its lines, and for each
template the windows of as many consecutive words as it has, from every word on;
these find a notice wrapped over lines, behind comment marks or amid other text.
Both sides are normalised (words of lower-case letters and digits). The coefficient
of a unit and a template cannot exceed twice the smaller number of bigrams over the
sum of both, so a template is looked at only where the sizes allow the threshold; a
window only where enough of its bigrams occur in the template.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from subtide.llm.decontamination import words_of
from subtide.llm.frames import append_columns, bytes_of

THRESHOLD = 0.8

# Short notices and standard headers of common licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
    "required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS "
    "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
    "language governing permissions and limitations under the License.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-4.0 short": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction, including without limitation the rights "
    "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
    "to whom the Software is furnished to do so, subject to the following conditions",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
    "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}

FIELDS = [
    T.StructField("licence", T.StringType(), False),
    T.StructField("dice", T.DoubleType(), False),
    T.StructField("n_units", T.LongType(), False),
    T.StructField("n_windows", T.LongType(), False),
]


def bigrams(words: list[bytes]) -> Counter:
    return Counter(zip(words, words[1:]))


class Matcher:
    """Templates in order of their number of bigrams."""

    def __init__(self, templates: dict[str, str], threshold: float):
        self.threshold = threshold
        counted = sorted((len(w) - 1, name, bigrams(w)) for name, w in ((n, words_of(t.encode())) for n, t in templates.items()) if len(w) > 1)
        self.sizes = [size for size, _, _ in counted]
        self.names = [name for _, name, _ in counted]
        self.bigrams = [own for _, _, own in counted]
        self.known = {word for own in self.bigrams for pair in own for word in pair}
        self.codes = {pair: n for n, pair in enumerate(sorted({pair for own in self.bigrams for pair in own}))}
        # Occurrences of each coded bigram in each template; the last column stands for all others.
        self.counts = np.zeros((len(self.names), len(self.codes) + 1), int)
        for row, own in zip(self.counts, self.bigrams):
            for pair, n in own.items():
                row[self.codes[pair]] = n

    def best(self, text: bytes) -> tuple[float, str]:
        """Highest coefficient of at least the threshold, and its template (the first by name)."""
        words = words_of(text)
        n = len(words) - 1
        if n < 1 or not self.sizes:
            return 0.0, ""
        # 2 min(n, m) / (n + m) reaches the threshold for m between these bounds only.
        ratio = (2 - self.threshold) / self.threshold if self.threshold else float("inf")
        first, last = bisect_left(self.sizes, n / ratio - 1e-9), bisect_right(self.sizes, n * ratio + 1e-9)
        # Shared bigrams consist of known words.
        if first == last or 2 * sum(map(self.known.__contains__, words)) < self.threshold * (n + self.sizes[first]):
            return 0.0, ""
        own, best = bigrams(words), (0.0, "")
        for size, name, other in zip(self.sizes[first:last], self.names[first:last], self.bigrams[first:last]):
            dice = 2 * sum((own & other).values()) / (n + size)
            if dice >= self.threshold and (dice > best[0] or dice == best[0] and name < best[1]):
                best = (dice, name)
        return best

    def windows(self, text: bytes) -> tuple[int, tuple[float, str]]:
        """Number of windows that reach the threshold, over all templates, and the best of them (the first by name)."""
        words = words_of(text)
        get, n, best = self.codes.get, len(words) - 1, (0.0, "")
        coded = [get(pair, -1) for pair in zip(words, words[1:])]
        if n < 1 or not self.sizes or n - coded.count(-1) < self.threshold * self.sizes[0] - 1e-9:
            return 0, best
        places, found = np.array(coded), 0
        for size, name, counts in zip(self.sizes, self.names, self.counts):
            if size > n:
                break
            upto = np.concatenate([[0], np.cumsum(counts[places] > 0)])
            likely = np.flatnonzero(upto[size:] - upto[:-size] >= self.threshold * size - 1e-9)
            if len(likely):
                shared = shared_bigrams(coded, counts.tolist(), size, likely.tolist())
                reached = [dice for dice in (s / size for s in shared) if dice >= self.threshold]
                found += len(reached)
                top = max(reached, default=0.0)
                if reached and (not best[1] or top > best[0] or top == best[0] and name < best[1]):
                    best = (top, name)
        return found, best


def shared_bigrams(coded: list[int], counts: list[int], size: int, starts: list[int]) -> list[int]:
    """Bigrams that the windows of ``size`` bigrams from ``starts`` (ascending) share with a template, repeats counted.

    A window is made from the one before it by what leaves and what enters.
    """
    out, own, shared, begin, end = [], [0] * len(counts), 0, 0, 0
    for start in starts:
        if start >= end:
            own, shared, begin, end = [0] * len(counts), 0, start, start
        for code in coded[begin:start]:
            shared -= own[code] <= counts[code]
            own[code] -= 1
        for code in coded[end : start + size]:
            own[code] += 1
            shared += own[code] <= counts[code]
        begin, end = start, start + size
        out.append(shared)
    return out


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append ``licence`` (best template, empty if none), ``dice``, ``n_units`` (lines and whole text that match) and
    ``n_windows`` (windows that match).

    Null texts count as empty and match nothing; units of fewer than two words
    neither. Ties go to the first name. Input columns with these names give way.
    """

    def start():
        matcher = Matcher(templates, threshold)

        def compute(batch):
            found = []
            for text in bytes_of(batch, text_column):
                lines = text.split(b"\n")
                units = [matcher.best(unit) for unit in (lines if len(lines) == 1 else [text, *lines])]
                hits = [u for u in units if u[1]]
                n_windows, top = matcher.windows(text)
                best = min([*hits, top] if top[1] else hits, key=lambda u: (-u[0], u[1]), default=(0.0, ""))
                found.append((*best, len(hits), n_windows))
            dice, names, counts, windows = zip(*found) if found else ((), (), (), ())
            return [pa.array(names, pa.string()), pa.array(dice, pa.float64()), pa.array(counts, pa.int64()), pa.array(windows, pa.int64())]

        return compute

    return append_columns(docs, text_column, FIELDS, start, keep)
