"""License statements in texts: winnowed fingerprints, an inverted index, banded alignment."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundings.llm.common import whole_text

# Wording of licenses and of the usual notices that name them.
TEMPLATES = {
    "Apache-2.0/statement": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the License."
    ),
    "MIT/statement": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "MIT/warranty": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
        "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "MIT/use": "This project uses the MIT license",
    "GPL-3.0/statement": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0/notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."
    ),
    "GPL-2.0/notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version."
    ),
    "LGPL-2.1/notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version."
    ),
    "AGPL-3.0/notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version."
    ),
    "MPL-2.0/notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/."
    ),
    "CC-BY-NC-4.0/statement": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0/statement": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. 3. Neither the name of the copyright holder nor "
        "the names of its contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission."
    ),
    "BSD/warranty": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
        "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
        "THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT "
        "OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
        "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
        "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies."
    ),
    "ISC/warranty": (
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO "
        "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO "
        "EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
        "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
        "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
}
_WORD = re.compile(r"\w+")


def _words(text: str) -> list[str]:
    """Words as they stand, then folded, so that they have the places of `_WORD` in the text."""
    return [word.lower() for word in _WORD.findall(text)]


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _grams(words: list[str], k: int, hashes: dict) -> np.ndarray:
    if len(words) < k:
        return np.zeros(0, np.uint64)
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    total = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        total = total * np.uint64(0x9E3779B97F4A7C15) + values[i : i + len(total)]
    return total ^ (total >> np.uint64(32))


def winnowed(grams: np.ndarray, window: int) -> np.ndarray:
    """Places of the fingerprints: the last smallest gram of every window of grams."""
    if len(grams) <= window:
        return np.array([len(grams) - 1 - int(np.argmin(grams[::-1]))] if len(grams) else [], int)
    views = np.lib.stride_tricks.sliding_window_view(grams, window)[:, ::-1]
    return np.unique(np.arange(len(views)) + window - 1 - np.argmin(views, axis=1))


class TemplateIndex:
    """Every gram of the templates, with where it occurs."""

    def __init__(self, templates: Mapping[str, str], k: int) -> None:
        hashes = _WordHashes()
        self.names = list(templates)
        self.words = [_words(text) for text in templates.values()]
        self.places: dict[int, list[tuple[int, int]]] = {}
        for number, words in enumerate(self.words):
            for at, gram in enumerate(_grams(words, k, hashes).tolist()):
                self.places.setdefault(gram, []).append((number, at))
        self.grams = np.array(sorted(self.places), np.uint64)


def banded_alignment(
    template: list[str], words: list[str], shift: int, band: int
) -> tuple[int, int, int]:
    """Best local alignment near the diagonal `shift`: matched words, first and last word + 1.

    A match scores 1, a replaced, missing or added word costs 1. Cells further than `band` from
    the diagonal are not looked at.
    """
    best = (0, 0, 0, 0)
    row: dict[int, tuple[int, int, int]] = {}
    for i, wanted in enumerate(template):
        new: dict[int, tuple[int, int, int]] = {}
        for j in range(max(0, i + shift - band), min(len(words), i + shift + band + 1)):
            score, matched, start = row.get(j - 1, (0, 0, j))
            if score == 0:
                start = j
            equal = wanted == words[j]
            cell = (score + (1 if equal else -1), matched + equal, start)
            for score, matched, start in (row.get(j, (0, 0, j)), new.get(j - 1, (0, 0, j))):
                if score - 1 > cell[0]:
                    cell = (score - 1, matched, start)
            if cell[0] > 0:
                new[j] = cell
                if cell[0] > best[0]:
                    best = (cell[0], cell[1], cell[2], j + 1)
        row = new
    return best[1], best[2], best[3]


def matches_of(
    text: str, index: TemplateIndex, k: int, window: int, band: int, coverage: float, hashes: dict
) -> list[tuple[str, int, int, float]]:
    """(license, start, end, coverage) of the statements in a text, in code points."""
    words = _words(text)
    grams = _grams(words, k, hashes)
    places = winnowed(grams, window)
    places = places[np.isin(grams[places], index.grams)]
    if not len(places):
        return []
    diagonals: dict[tuple[int, int], None] = {}
    for at in places.tolist():
        for number, where in index.places[int(grams[at])]:
            near = [(number, at - where + d) for d in range(-band // 2, band // 2 + 1)]
            if not any(key in diagonals for key in near):
                diagonals[number, at - where] = None
    found = []
    for number, shift in diagonals:
        template = index.words[number]
        low = max(0, shift - band)
        own = words[low : max(0, shift + len(template) + band)]
        matched, first, last = banded_alignment(template, own, shift - low, band)
        share = matched / len(template)
        if share >= coverage:
            found.append((-matched, number, low + first, low + last, share))
    spans = [m.span() for m in _WORD.finditer(text)] if found else []
    taken: list[tuple[str, int, int, float]] = []
    used = np.zeros(len(words), bool)
    for _, number, first, last, share in sorted(found):
        if not used[first:last].any():
            used[first:last] = True
            taken.append((index.names[number], spans[first][0], spans[last - 1][1], share))
    return sorted(taken, key=lambda t: t[1:])


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, str] | None = None,
    k: int = 3,
    window: int = 2,
    band: int = 8,
    coverage: float = 0.8,
) -> DataFrame:
    """The license statements of every document.

    Any run of `k + window - 1` words shared with a template contains a fingerprint and is looked
    at; it is reported if an alignment no further than `band` words off its diagonal matches
    `coverage` of the template. Where statements overlap the one with more matched words counts.
    The templates are a parameter, and their index travels to the tasks with it.

    Returns doc_id, n_matches, licenses (names, comma-joined, each once, sorted), coverage (the
    largest, 0 without matches) and spans (`name:start:end`). Null texts count as empty and have
    no matches; repeated rows are reported each; an empty table gives no rows.
    """
    index = TemplateIndex(TEMPLATES if templates is None else templates, k)

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _WordHashes()
        for batch in batches:
            found = [
                matches_of(text, index, k, window, band, coverage, hashes)
                for text in batch["text"]
            ]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"],
                "n_matches": [len(f) for f in found],
                "licenses": [",".join(sorted({m[0].split("/")[0] for m in f})) for f in found],
                "coverage": [max((m[3] for m in f), default=0.0) for f in found],
                "spans": [",".join(f"{m[0]}:{m[1]}:{m[2]}" for m in f) for f in found],
            })

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return texts.mapInPandas(
        scanned, "doc_id long, n_matches long, licenses string, coverage double, spans string"
    )
