"""License notices in texts: MinHash bands over overlapping windows, then exact containment.

A text and a template are sequences of lower-case words without punctuation; shingles are five
words. A template of fewer words is one shingle, of its own length: it has a class of its own whose
windows are as long as the template and start at every word. Such a window is the template or
shares nothing with it, so the bands of its one shingle all say the same and one is looked up.

Templates of like length share a class with windows of ``span`` words every ``stride``
words: any stretch of words as long as the longest template of the class lies within one window.
Each window has a MinHash signature with a band per hash function (``ROWS`` = 1, since hardly a window
shares a shingle with a template by chance); a template that shares a band with a window is its
candidate. If the window holds ``CONTAINMENT`` of a template's shingles, their Jaccard similarity
is at least ``least_similarity``, so the chance to miss the template is at most ``(1 -
least_similarity) ** bands``. A class has as many bands as it takes to keep this below
``MOST_MISSED``, at most ``BANDS``; classes are cut, or strides halved, so that these suffice. What
the bands retrieve is verified by counting the template's shingles in the window, exactly.

A window shares a band with a template only if the template's least value is at one of the
window's shingles and no smaller one is beside it. So values are looked up as they are, and least
values are taken of the windows around a hit only; candidates are the same as by comparing all.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.tables import documents, text_bytes
from basketflow.llm.words import WordHashes, plain_words

SHINGLE = 5
CONTAINMENT = 0.8
BANDS, ROWS = 20, 1
MOST_MISSED = 1e-6
SCAN_WORDS = 1 << 16
FILTER_BITS = 16

# Notices by the identifier of the license they announce. Of the AGPL, LGPL and GPL 2
# only the words that tell them from their relatives: too few are shared to count as contained.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License."
    ),
    "AGPL-3.0-header": "GNU Affero General Public License as published by the Free Software Foundation",
    "BSD-2-Clause": "Use of this source code is governed by a BSD 2-Clause license that can be found in the LICENSE file.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD-2-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."
    ),
    "BSD-3-Clause-text": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "EPL-1.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0"
    ),
    "GPL-2.0": "GNU General Public License, version 2.",
    "GPL-2.0-header": (
        "GNU General Public License as published by the Free Software Foundation; either version 2 of the License"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "ISC": "Released under the ISC License.",
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL-2.1-header": (
        "GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"
    ),
    "LGPL-header": "GNU Lesser General Public License as published by the Free Software Foundation",
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."
    ),
}
# Notices of fewer words than a shingle, and tags. The tag alone stands for identifiers not listed.
_TAGGED = (
    "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-1.0", "EPL-2.0", "GPL-2.0",
    "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense",
)
NOTICES = {
    "All-rights-reserved": "All rights reserved.",
    "SPDX": "SPDX-License-Identifier:",
} | {f"SPDX-{name}": f"SPDX-License-Identifier: {name}" for name in _TAGGED}


def shingles(words: list[bytes], size: int = SHINGLE) -> list[tuple[bytes, ...]]:
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]


def least_similarity(shortest: int, span: int, share: float = CONTAINMENT) -> float:
    """Least Jaccard similarity of a window that holds ``share`` of a template's shingles."""
    own, window = shortest - SHINGLE + 1, span - SHINGLE + 1
    common = int(np.ceil(share * own - 1e-9))
    return common / (own + window - common)


def miss_chance(similarity: float, bands: int = BANDS) -> float:
    return (1 - similarity**ROWS) ** bands


def least_bands(similarity: float) -> int:
    """The bands that a class of this least similarity needs."""
    return next(bands for bands in range(1, BANDS + 1) if miss_chance(similarity, bands) <= MOST_MISSED or bands == BANDS)


def classes(lengths: Iterable[int], share: float = CONTAINMENT) -> list[tuple[int, int, int, int]]:
    """``(shortest, longest, span, stride)`` of classes that cover all template lengths, in words."""
    found, rest = [], sorted(set(lengths))
    while rest:
        shortest = rest[0]
        stride = max(1, shortest // 4)
        while stride > 1 and miss_chance(least_similarity(shortest, shortest + stride - 1, share)) > MOST_MISSED:
            stride //= 2
        longest = shortest
        for length in rest:
            if miss_chance(least_similarity(shortest, length + stride - 1, share)) <= MOST_MISSED:
                longest = length
        found.append((shortest, longest, longest + stride - 1, stride))
        rest = [length for length in rest if length > longest]
    return found


class Templates:
    """Signatures and shingles of the templates, and the search of a text for them."""

    def __init__(self, texts: dict[str, str], share: float):
        self.share = share
        rng = np.random.default_rng(20240501)
        self.factors = (rng.integers(1, 1 << 63, BANDS, dtype=np.uint64) | np.uint64(1)).tolist()
        self.shifts = rng.integers(0, 1 << 63, BANDS, dtype=np.uint64).tolist()
        self.hashes = WordHashes()
        words = {name: plain_words(text.encode()) for name, text in sorted(texts.items())}
        # Templates of fewer words than a shingle, by their length and words.
        self.short: dict[int, dict[tuple[bytes, ...], list[str]]] = {}
        for name, own in words.items():
            if 0 < len(own) < SHINGLE:
                self.short.setdefault(len(own), {}).setdefault(tuple(own), []).append(name)
        self.short_bands = {
            n: self._seen(self._mixed(np.concatenate([self._hashed(self.hashes.of(list(own)), n) for own in known])))
            for n, known in self.short.items()
        }
        self.names = [name for name, own in words.items() if len(own) >= SHINGLE]
        self.shingles = [set(shingles(words[name])) for name in self.names]
        length = np.array([len(words[name]) for name in self.names], np.int64)
        self.classes = classes(length.tolist(), share)
        self.widest = max((span for _, _, span, _ in self.classes), default=0)
        # Per hash function: the least values of templates whose class uses it, sorted, and whose they are.
        class_of = [next(c for c, (a, b, _, _) in enumerate(self.classes) if a <= n <= b) for n in length.tolist()]
        needed = [least_bands(least_similarity(shortest, span, share)) for shortest, _, span, _ in self.classes]
        self.bands = []
        for band in range(max(needed, default=0)):
            own = [t for t, c in enumerate(class_of) if band < needed[c]]
            least = np.array([self._values(self._hashed(self.hashes.of(words[self.names[t]]), SHINGLE), band).min() for t in own])
            order = np.argsort(least, kind="stable")
            self.bands.append((least[order], np.array(own)[order], np.array(class_of)[own][order], self._seen(least)))

    @staticmethod
    def _seen(band: np.ndarray) -> np.ndarray:
        seen = np.zeros(1 << FILTER_BITS, bool)
        seen[(band >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        return seen

    @staticmethod
    def _hashed(words: np.ndarray, size: int) -> np.ndarray:
        """Hashes of shingles of ``size`` words, over the hashes of a text's words."""
        n = len(words) - size + 1
        whole = words[:n]
        for at in range(1, size):
            whole = (whole ^ (whole >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + words[at : at + n]
        return whole ^ (whole >> np.uint64(29))

    @staticmethod
    def _mixed(whole: np.ndarray) -> np.ndarray:
        """The band of a short template: of one shingle, the least value is its own."""
        return whole * np.uint64(0xD6E8FEB86659FD93)

    def _values(self, shingles: np.ndarray, band: int) -> np.ndarray:
        """The hash function of a band, over the hashes of shingles."""
        return shingles * np.uint64(self.factors[band]) + np.uint64(self.shifts[band])

    def search(self, text: bytes) -> list[tuple[str, int, int, float]]:
        """``(template, first word, windows, containment)`` of each template in a text.

        ``windows`` counts the windows that hold enough of it; containment is the most of any
        window, which starts at the first word given.
        """
        words = plain_words(text)
        hashes = self.hashes.of(words)
        best: dict[int, tuple[float, int]] = {}
        hits: dict[int, int] = {}
        for number, begin in self._candidates(words, hashes):
            _, _, span, _ = self.classes[number[0]]
            own = self.shingles[number[1]]
            found = len(own.intersection(shingles(words[begin : begin + span]))) / len(own)
            if found >= self.share - 1e-9:
                hits[number[1]] = hits.get(number[1], 0) + 1
                best[number[1]] = max(best.get(number[1], (0.0, 0)), (found, -begin))
        long = [(self.names[t], -begin, hits[t], found) for t, (found, begin) in sorted(best.items())]
        return long + self._short_ones(words, hashes)

    def _short_ones(self, words: list[bytes], hashes: np.ndarray) -> list[tuple[str, int, int, float]]:
        """As ``search``, for templates of fewer words than a shingle."""
        places: dict[str, list[int]] = {}
        for n, known in self.short.items():
            if len(words) < n:
                continue
            band = self._mixed(self._hashed(hashes, n))
            likely = np.flatnonzero(self.short_bands[n][(band >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            for i in likely.tolist():
                for name in known.get(tuple(words[i : i + n]), ()):
                    places.setdefault(name, []).append(i)
        return [(name, at[0], len(at), 1.0) for name, at in sorted(places.items())]

    def _candidates(self, words: list[bytes], hashes: np.ndarray) -> Iterator[tuple[tuple[int, int], int]]:
        """``((class, template), first word)`` for each window and template that share a band."""
        for at in range(0, len(words), SCAN_WORDS):
            part = hashes[at : at + SCAN_WORDS + self.widest]
            if len(part) < SHINGLE:
                return
            hashed = self._hashed(part, SHINGLE)
            pairs: set[tuple[int, int, int]] = set()
            for band, (least, template, of_class, seen) in enumerate(self.bands):
                values = self._values(hashed, band)
                place = np.flatnonzero(seen[(values >> np.uint64(64 - FILTER_BITS)).view(np.int64)])
                if len(place):
                    low, high = (np.searchsorted(least, values[place], side) for side in ("left", "right"))
                    hit = np.repeat(place, high - low)
                    among = np.concatenate([np.arange(a, b) for a, b in zip(low.tolist(), high.tolist(), strict=True)]).astype(np.int64)
                    for c in set(of_class[among].tolist()):
                        own = of_class[among] == c
                        pairs |= self._windows(values, hit[own], template[among[own]], c)
            for c, t, begin in sorted(pairs):
                yield (c, t), at + begin

    def _windows(self, values: np.ndarray, place: np.ndarray, template: np.ndarray, c: int) -> set[tuple[int, int, int]]:
        """``(class, template, first word)`` of the windows around places in which nothing is less."""
        _, _, span, stride = self.classes[c]
        width, n = span - SHINGLE + 1, len(values)
        first = np.maximum(-((width - 1 - place) // stride), 0)
        last = np.minimum(place, min(SCAN_WORDS, n) - 1) // stride
        count = np.maximum(last - first + 1, 0)
        which = np.repeat(np.arange(len(place)), count)
        begin = (first[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)) * stride
        if not len(begin):
            return set()
        # One value more, so that a window may end with the text.
        ends = np.stack([begin, np.minimum(begin + width, n)], axis=1).ravel()
        least = np.minimum.reduceat(np.append(values, np.uint64(0)), ends)[::2]
        found = least == values[place[which]]
        return {(c, t, b) for t, b in zip(template[which[found]].tolist(), begin[found].tolist(), strict=True)}


FOUND = "doc_id long, license string, first_word int, windows int, containment double"


def licenses(
    docs: DataFrame, templates: dict[str, str] = TEMPLATES | NOTICES, share: float = CONTAINMENT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, license, first_word, windows, containment)`` for each template in each row.

    A template of fewer than five words is found where all its words stand in a row; one without
    words is not searched for. One notice may hold several templates (a GPL 3 header is most of an
    AGPL header); the containment tells which is whole. Null and empty texts hold nothing; rows
    with equal keys are searched on their own. Templates are parameters, so what a task keeps of
    them does not grow with the data.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_bytes(text).alias("text"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, share)
        for batch in batches:
            found = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found += [(key, *hit) for hit in known.search(text.as_py())]
            if found:
                types = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.float64()]
                columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in FOUND.split(", ")])

    return rows.mapInArrow(search, FOUND)


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(documents(spark, sf_dir))
