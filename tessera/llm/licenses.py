"""License scans by winnowed fingerprints and banded alignment.

Every template is a sequence of words (letters and digits, case folded, signs dropped). The templates' word GRAM-grams are
winnowed: of each WINDOW consecutive ones the smallest hash stays, so a passage shared over GRAM + WINDOW - 1 words always
shares a fingerprint. An inverted index from fingerprints to (template, place) is looked up with every gram of every text;
hits on about the same diagonal make a candidate, and a banded alignment of the template with that part of the text gives the
matched words and the place of the match. Words that the text has more than the template count against the coverage, and words that tell
licenses apart (numbers below 1000 and the words DECISIVE) must be the same ones in the same order, none missing and none more. Of
matches that overlap the one with most matched words stays, then the one with the higher coverage.

Defined cases: a null, empty or wordless text has no match and so no row; several matches are rows of their own and never overlap;
a null id is carried; repeated rows repeat their rows; an empty table gives none; other columns are ignored."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import Words, chain, chunks, lean, tidy

GRAM, WINDOW = 3, 2
#: Words that an alignment may drift from its diagonal, and the least matched share of a template.
BAND, COVERAGE = 6, 0.8

#: Words that tell licenses apart, besides numbers.
DECISIVE = ("affero", "alike", "commercial", "derivative", "derivatives", "lesser", "library", "nc", "nd", "noderivatives", "noderivs", "noncommercial", "sa", "sharealike", "zero")

_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_3 = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
    "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
    "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public License "
    "as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
)

# License statements as they are commonly written, whole license texts where they are short.
TEMPLATES = {
    "0bsd": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
    ),
    "agpl-3.0-header": _GNU.format(kind="Affero General", version=3),
    "agpl-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "bsd-clauses": _BSD,
    "bsd-2-clause": f"{_BSD} {_BSD_END}",
    "bsd-3-clause": f"{_BSD} {_BSD_3} {_BSD_END}",
    "bsl-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") "
        "to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, "
        "all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, "
        "must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, "
        "unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor."
    ),
    "cc0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0 Universal.",
    "gpl-2.0-header": _GNU.format(kind="General", version=2),
    "gpl-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": _GNU.format(kind="General", version=3),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "lgpl-2.1-header": _GNU.format(kind="Lesser General", version=2.1),
    "lgpl-3.0-header": _GNU.format(kind="Lesser General", version=3),
    "lgpl-2.1-notice": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "mit-notice": "Released under the MIT License.",
    "mit": _MIT,
    "mit-full": (
        f"{_MIT} THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "mpl-1.1-header": "The contents of this file are subject to the Mozilla Public License Version 1.1; you may not use this file except in compliance with the License.",
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
        "either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
        "The origin of this software must not be misrepresented; you must not claim that you wrote the original software. "
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "This notice may not be removed or altered from any source distribution."
    ),
}
for _code, _words in (("", ""), ("-nc", "-NonCommercial"), ("-sa", "-ShareAlike"), ("-nd", "-NoDerivatives"), ("-nc-sa", "-NonCommercial-ShareAlike"), ("-nc-nd", "-NonCommercial-NoDerivatives")):
    for _version in ("3.0", "4.0"):
        TEMPLATES[f"cc-by{_code}-{_version}-notice"] = f"Licensed under CC BY{_code.upper()} {_version}."
        TEMPLATES[f"cc-by{_code}-{_version}-statement"] = f"This work is licensed under a Creative Commons Attribution{_words} {_version} {'International' if _version == '4.0' else 'Unported'} License."


def winnow(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the fingerprints: the smallest hash of each window, the last one of equals."""
    if len(hashes) <= window:
        return np.array([len(hashes) - 1 - int(np.argmin(hashes[::-1]))]) if len(hashes) else np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)[:, ::-1]
    return np.unique(np.arange(len(views)) + window - 1 - views.argmin(axis=1))


def align(template: np.ndarray, part: np.ndarray, shift: int, band: int = BAND) -> tuple[int, int, int]:
    """Matched words, first and last matched place in ``part``, of the best alignment of the whole template; of equal ones that
    which ends nearest to the diagonal.

    Word i of the template may meet part[i + shift - band .. i + shift + band]; a match scores 1, a word left out costs 0.1."""
    width = 2 * band + 1
    none = (-1e9, 0, 0, 0)
    before = [(0.0, 0, -1, -1)] * width  # (score, matched, first, last) before any word of the template
    for i in range(len(template)):
        row = []
        for d in range(width):
            j = i + shift - band + d
            best = none
            if 0 <= j < len(part):
                s, m, f, e = before[d]
                best = (s + 1, m + 1, j if f < 0 else f, j) if template[i] == part[j] else (s - 0.2, m, f, e)
            if d + 1 < width and before[d + 1][0] - 0.1 > best[0]:  # the template's word is missing
                s, m, f, e = before[d + 1]
                best = (s - 0.1, m, f, e)
            if d and row[-1][0] - 0.1 > best[0]:  # the text has a word more
                s, m, f, e = row[-1]
                best = (s - 0.1, m, f, e)
            row.append(best)
        before = row
    _, (_, matched, first, last) = max(enumerate(before), key=lambda x: (x[1][0], x[1][1], -abs(x[0] - band)))
    return matched, first, last


class Index:
    """The templates' words and the inverted index of their fingerprints."""

    def __init__(self, templates: dict[str, str], gram: int = GRAM, window: int = WINDOW):
        self.names, self.gram = sorted(templates), gram
        found = Words([templates[x].encode() for x in self.names], "plain")
        self.words = [found.hash[a:b] for a, b in zip(found.first, found.first[1:], strict=False)]
        rows = []
        for i, words in enumerate(self.words):
            if len(words) < gram:
                raise ValueError(f"template {self.names[i]} has fewer than {gram} words")
            grams = chain(words, gram)
            rows += [(int(grams[p]), i, int(p)) for p in winnow(grams, window)]
        rows.sort()
        self.keys = np.array([r[0] for r in rows], dtype=np.uint64)
        self.template, self.place = (np.array([r[x] for r in rows], dtype=np.int64) for x in (1, 2))
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[(self.keys >> np.uint64(48)).astype(np.int64)] = True
        self.decisive = np.unique(Words([x.encode() for x in (*DECISIVE, *map(str, range(1000)))], "plain").hash)
        self.marks = [self.marked(words) for words in self.words]

    def marked(self, words: np.ndarray) -> list[int]:
        """The decisive words among some words, in order."""
        return words[np.isin(words, self.decisive)].tolist()

    def matches(self, words: Words, coverage: float = COVERAGE, band: int = BAND) -> list[tuple[int, int, int, int, int, float]]:
        """(text, template, first word, last word, matched words, coverage), words counted in the whole chunk."""
        if len(words.hash) < self.gram:
            return []
        grams = chain(words.hash, self.gram)
        at = np.flatnonzero(self.maybe[(grams >> np.uint64(48)).astype(np.int64)])
        low, high = np.searchsorted(self.keys, grams[at], "left"), np.searchsorted(self.keys, grams[at], "right")
        hits = {}
        for p, a, b in zip(at[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist(), strict=True):
            text = int(np.searchsorted(words.first, p, side="right")) - 1
            if p + self.gram > words.first[text + 1]:
                continue  # the gram runs into the next text
            for k in range(a, b):
                hits.setdefault((text, int(self.template[k])), set()).add(p - int(self.place[k]))
        found: dict[int, list[tuple[int, float, int, int, int]]] = {}
        for (text, t), diagonals in hits.items():
            template = self.words[t]
            begin, end = int(words.first[text]), int(words.first[text + 1])
            last = None
            for diagonal in sorted(diagonals):
                if last is not None and diagonal - last <= band // 2:
                    continue  # inside the band of the one before
                last = diagonal
                low_, high_ = max(begin, diagonal - band), min(end, diagonal + len(template) + band)
                matched, first, stop = align(template, words.hash[low_:high_], diagonal - low_, band)
                share = matched / max(len(template), stop - first + 1)
                if share >= coverage and self.marked(words.hash[low_ + first : low_ + stop + 1]) == self.marks[t]:
                    found.setdefault(text, []).append((-matched, -share, low_ + first, low_ + stop, t))
        out = []
        for text, rows in found.items():
            begins: list[int] = []
            ends: list[int] = []
            for matched, share, first, stop, t in sorted(rows):
                at = bisect_right(begins, first)
                if (at and ends[at - 1] >= first) or (at < len(begins) and begins[at] <= stop):
                    continue
                begins.insert(at, first)
                ends.insert(at, stop)
                out.append((text, t, first, stop, -matched, -share))
        return sorted(out, key=lambda x: (x[0], x[2], x[1]))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, license, coverage, matched_words, template_words, start_char, end_char: a row for each match."""
    lean(docs.sparkSession)
    index = docs.sparkSession.sparkContext.broadcast(Index(templates))  # as large as the templates
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("license", T.StringType()), T.StructField("coverage", T.DoubleType()), *(T.StructField(x, T.LongType()) for x in ("matched_words", "template_words", "start_char", "end_char"))])

    def run(batches):
        for batch in batches:
            for part, texts in chunks(batch):
                words = Words(texts, "plain")
                at, out, current, before = [], [], None, None
                for text, t, first, last, matched, share in index.value.matches(words, coverage):
                    base = int(words.base[text])
                    if text != current:  # characters before each byte of the text
                        current, raw = text, np.frombuffer(texts[text], np.uint8)
                        before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                    at.append(text)
                    out.append((index.value.names[t], share, matched, len(index.value.words[t]), int(before[words.start[first] - base]), int(before[words.end[last] - base])))
                columns = list(zip(*out, strict=True)) if out else [()] * 6
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.float64(), *[pa.int64()] * 4), strict=True))], names=schema.names)

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(tidy(run), schema)
