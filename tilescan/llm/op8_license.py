"""License scans: winnowed fingerprints of templates pick candidates, a banded alignment reports what matched.

Templates and texts are sequences of lower-case words.  Hashes of ``gram`` words (of all words of a template that has fewer)
are winnowed in the templates (the least of every ``window`` of them), which makes an inverted index from hash to (template,
position).  A text's hashes are looked up in it; the hits of a template that follow each other in the text make a region, and
an alignment of the template with the region, in a band as wide as the region's diagonals are spread, counts the words that
match and gives their span in the text.  Every hash of a text is looked up, so a passage of gram + window - 1 words of a
template is always found.

Coverage is matched words over the template's words and the words inserted within the span, so that "Lesser" in the middle
costs as much as a word that lacks.  Words that tell licences of a family apart (``TELLING``: numbers of versions, letters of
variants) must all match and none may be inserted, and a notice that a negation leads in ("not licensed under") is none.

Defined results: a null or empty text has no matches; each region of each template with ``least`` coverage or more is
reported, and of templates of ``long`` words or more those of which as many words matched, with what coverage they have (then
telling words that the text leaves out do not count); of templates that overlap in a place the one whose matched less lacking
and inserted words are most, then the first; every row is kept, with repeated or null doc_ids; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilescan.llm.common import ship, texts

# fixed values: public licence texts and customary notices
MIT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
ISC = 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
BSD_START = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
ZLIB = "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
UNLICENSE = "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."
GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name}General Public License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name}General Public License for more details."
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "MIT": "Released under the MIT License.",
    "MIT-text": MIT,
    "ISC-text": ISC,
    "BSD-2-Clause-text": f"{BSD_START} {BSD_END}",
    "BSD-3-Clause-text": f"{BSD_START} {BSD_THIRD} {BSD_END}",
    "Zlib-text": ZLIB,
    "Unlicense-text": UNLICENSE,
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "MPL-2.0-short": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}
for _code, _name, _versions in (("GPL", "", ("1", "2", "3")), ("LGPL", "Lesser ", ("2.1", "3")), ("AGPL", "Affero ", ("3",))):
    for _version in _versions:
        _number = _version if "." in _version else f"{_version}.0"
        TEMPLATES[f"{_code}-{_number}"] = f"This work is licensed under the GNU {_name}General Public License, version {_version}."
        TEMPLATES[f"{_code}-{_number}-or-later"] = GNU.format(name=_name, version=_version)
for _kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
    for _version in ("3.0", "4.0"):
        TEMPLATES[f"CC-{_kind}-{_version}"] = f"Licensed under CC {_kind} {_version}."
# fixed values: words that tell licences of one family apart, and words that negate
TELLING = frozenset("lesser library affero by sa nc nd".split())
NEGATIONS = frozenset("not never no isn aren without nor".split())

WORD = re.compile(r"\w+")


def word_hashes(words: list[str], known: dict[str, int]) -> np.ndarray:
    """64-bit hash of each word; ``known`` remembers them."""
    if len(known) > 1_000_000:
        known.clear()
    h64 = xxhash.xxh64_intdigest
    for w in words:
        if w not in known:
            known[w] = h64(w.encode("utf-8", "surrogatepass"))
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def gram_hashes(h: np.ndarray, gram: int) -> np.ndarray:
    """Hash of each ``gram`` neighbouring words."""
    if len(h) < gram:
        return np.zeros(0, np.uint64)
    out = h[: len(h) - gram + 1].copy()
    for k in range(1, gram):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - gram + 1 + k]
        out ^= out >> np.uint64(29)
    return out


def telling(word: str) -> bool:
    return word in TELLING or any(c.isdigit() for c in word)


class Index:
    """Winnowed fingerprints of the templates, by their length in words."""

    def __init__(self, templates: dict[str, str], gram: int = 3, window: int = 2):
        self.window, self.names = window, list(templates)
        self.words = [WORD.findall(t.lower()) for t in templates.values()]
        self.at: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for t, words in enumerate(self.words):
            if not words:
                continue
            size = min(gram, len(words))
            h = gram_hashes(word_hashes(words, {}), size)
            picked: set[int] = set()
            for k in range(max(1, len(h) - window + 1)):
                part = h[k : k + window]
                picked.add(k + len(part) - 1 - int(part[::-1].argmin()))
            for p in picked:
                self.at.setdefault(size, {}).setdefault(int(h[p]), []).append((t, p))
        self.sorted = {size: np.array(sorted(found), np.uint64) for size, found in self.at.items()}

    def hits(self, hashes: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """By template, (place in the text, place in the template) of the fingerprints that meet, of a text's word hashes."""
        out: dict[int, list[tuple[int, int]]] = {}
        for size, known in self.sorted.items():
            grams = gram_hashes(hashes, size)
            if not len(grams):
                continue
            near = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            for p in np.flatnonzero(known[near] == grams).tolist():
                for t, q in self.at[size][int(grams[p])]:
                    out.setdefault(t, []).append((p, q))
        return out


def regions(hits: list[tuple[int, int]], n: int, slack: int = 12) -> list[tuple[int, int]]:
    """(least, largest diagonal) of the runs of hits of a template of ``n`` words: in the order of the text, a hit goes on with
    the nearest run whose last hit it follows in the template too, no farther than half the template and ``slack`` words."""
    runs: list[list[int]] = []  # last place in the text, in the template, least diagonal, largest
    done: list[list[int]] = []
    for p, q in sorted(hits):
        far = n // 2 + slack
        still = [r for r in runs if p - r[0] <= far + n]
        done += [r for r in runs if p - r[0] > far + n]
        runs = still
        fits = [r for r in runs if r[1] < q and abs((p - r[0]) - (q - r[1])) <= far and r[0] < p]
        if fits:
            best = min(fits, key=lambda r: (abs((p - r[0]) - (q - r[1])), -r[0]))
            best[:] = [p, q, min(best[2], p - q), max(best[3], p - q)]
        else:
            runs.append([p, q, p - q, p - q])
    return sorted({(r[2], r[3]) for r in [*done, *runs]})


def aligned(template: list[str], text: list[str], low: int, high: int) -> list[tuple[int, int]]:
    """The places (template, text) of the words that match in the best alignment of the whole template, whose diagonals (place
    in the text less place in the template) stay between ``low`` and ``high``: most matches less words that lack or are
    inserted between matches."""
    width, n = high - low + 1, len(template)
    none = -(10**9)
    # best[i][d]: a template of i words done, the text up to diagonal d; back: 0 start, 1 match, 2 word lacks, 3 word inserted
    best, back = [0] * width, [[0] * width]
    for i, word in enumerate(template):
        new, turn = [none] * width, [0] * width
        for d in range(width):
            j = i + low + d  # the word of the text that this diagonal pairs with the word i
            score, kind = none, 0
            if 0 <= j < len(text) and text[j] == word:
                score, kind = best[d] + 2, 1
            if d + 1 < width and best[d + 1] - 1 > score:
                score, kind = best[d + 1] - 1, 2
            if d and new[d - 1] - 1 > score:
                score, kind = new[d - 1] - 1, 3
            new[d], turn[d] = score, kind
        best = new
        back.append(turn)
    d, i, out = max(range(width), key=lambda k: best[k]), n, []
    while i:
        kind = back[i][d]
        if kind == 1:
            out.append((i - 1, i - 1 + low + d))
            i -= 1
        elif kind == 2:
            i, d = i - 1, d + 1
        elif kind == 3:
            d -= 1
        else:
            break
    return out[::-1]


def judged(template: list[str], text: list[str], pairs: list[tuple[int, int]], least: float, long: int) -> tuple[int, int, float, int, int] | None:
    """(rank, matched words, coverage, first word, end) of an alignment that counts, or nothing."""
    if not pairs:
        return None
    a, b = pairs[0][1], pairs[-1][1] + 1
    inside = {j for _, j in pairs}
    put_in = [text[j] for j in range(a, b) if j not in inside]
    lacking = set(range(len(template))) - {i for i, _ in pairs}
    m = len(pairs)
    coverage = m / (len(template) + len(put_in))
    denied = NEGATIONS & set(text[max(0, a - 2) : a]) or len(template) < long and NEGATIONS & set(put_in)
    if denied or any(map(telling, put_in)):
        return None
    whole = coverage >= least and not any(telling(template[i]) for i in lacking)
    # a part of a long text: what it lacks may lie before and after, but a telling word must not have another in its place
    part = m >= long and m >= 0.75 * (b - a) and not any(telling(template[i]) for i in lacking if pairs[0][0] < i < pairs[-1][0])
    if not (whole or part):
        return None
    return m - len(put_in) - len(lacking), m, round(coverage, 6), a, b


def scan(index: Index, text: str, known: dict[str, int], least: float = 0.8, long: int = 25) -> list[tuple[str, float, int, int, int]]:
    """(template, coverage, matched words, first character, end) in order of place; of templates that overlap, the best one."""
    found_words = list(WORD.finditer(text))
    lowered = [m.group().lower() for m in found_words]
    hits = index.hits(word_hashes(lowered, known))
    found = []
    for t, places in hits.items():
        words = index.words[t]
        for low, high in regions(places, len(words)):
            got = judged(words, lowered, aligned(words, lowered, low - 4, high + 4), least, long)
            if got:
                found.append((*got, t))
    out: list[tuple[str, float, int, int, int]] = []
    taken: list[tuple[int, int]] = []
    for _, m, coverage, a, b, t in sorted(found, key=lambda x: (-x[0], -x[2], x[3], x[5])):
        if all(b <= x or a >= y for x, y in taken):
            taken.append((a, b))
            out.append((index.names[t], coverage, m, found_words[a].start(), found_words[b - 1].end()))
    return sorted(out, key=lambda x: x[3])


def licenses(docs: DataFrame, templates: dict[str, str] | None = None, gram: int = 3, window: int = 2, least: float = 0.8, long: int = 25) -> DataFrame:
    """doc_id, n_matches, matches (array of template, coverage, matched words, span in characters) of each row of ``docs`` (doc_id, text)."""
    ship(docs.sparkSession)
    index = Index(templates or TEMPLATES, gram, window)
    kind = pa.list_(pa.struct([("template", pa.string()), ("coverage", pa.float64()), ("n_words", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))
    fields = [f.name for f in kind.value_type]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            found = [[dict(zip(fields, m)) for m in scan(index, text, known, least, long)] for text in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(list(map(len, found)), pa.int64()), pa.array(found, kind)], names=["doc_id", "n_matches", "matches"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        walk, "doc_id long, n_matches long, matches array<struct<template: string, coverage: double, n_words: long, start: long, end: long>>"
    )
