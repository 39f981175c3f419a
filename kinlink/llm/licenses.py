"""Licence scans: Dice coefficient over word bigrams between pieces of a text and licence templates.

Texts are normalised: lower-cased, words are runs of letters, digits and inner dots (``2.0``), all else separates. The pieces of a text are
all runs of its sentences (a line's end ends a sentence too): so also its lines, its paragraphs, licences of several paragraphs however
they are wrapped, and the whole. A piece of n bigrams can only reach a coefficient t with templates of between n * t / (2 - t) and
n * (2 - t) / t bigrams, and only if it has the share t / (2 - t) of a template's bigrams. So a text is first asked which templates it has so much of, all in all
(most have none and are done); from each sentence that has a bigram of these on, pieces then grow sentence by sentence
up to the size bound, and their common bigrams are counted as they grow. Templates are a table (``TEMPLATES`` unless another is given) of at most ``TABLE_BYTES``, full licence texts included.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.llm.common import small_batches

THRESHOLD = 0.8
TABLE_BYTES = 16 << 20  # of template texts, as they go to all machines
_WORD = re.compile(r"[^\W_]+(?:\.[^\W_]+)*\+?")
_SENTENCE = re.compile(r"(?<=[.;!?])\s+(?=\S)")

_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    " IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    " Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    " Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_END = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
    " IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)"
    " HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General Public License as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version."
    " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0}General Public License for more details."
    " You should have received a copy of the GNU {0}General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."
)
#: Public licence texts and the notices by which texts name a licence.
TEMPLATES: tuple[tuple[str, str], ...] = (
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights"
        " to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
        " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _WARRANTY,
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission." + _BSD_END),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
        " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT,"
        " OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
        " Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
        " See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-2.0", _GPL.format("", "2")),
    ("GPL-3.0", _GPL.format("", "3")),
    ("LGPL-3.0", _GPL.format("Lesser ", "3")),
    ("AGPL-3.0", _GPL.format("Affero ", "3")),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher."),
)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def bigrams(words: list[str]) -> Counter:
    return Counter(zip(words, words[1:], strict=False))


class Templates:
    """Templates with the sizes and bigrams they have, and for each bigram the templates that have it, how often."""

    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> None:
        made = [(name, b) for name, text in templates if (b := bigrams(words_of(text)))]
        self.names = [name for name, _ in made]
        self.sizes = [b.total() for _, b in made]
        self.having: dict[tuple[str, str], list[tuple[int, int]]] = {}
        for i, (_, b) in enumerate(made):
            for pair, n in b.items():
                self.having.setdefault(pair, []).append((i, n))

    def possible(self, met: Counter, threshold: float) -> set[int]:
        """The templates that a text with these bigrams has enough of for some piece to reach the threshold."""
        common: Counter = Counter()
        for pair, n in met.items():
            for i, most in self.having[pair]:
                common[i] += min(n, most)
        return {i for i, n in common.items() if n >= self.sizes[i] * threshold / (2 - threshold) - 1e-9}


def _sentences(line: str) -> Iterator[tuple[int, int]]:
    """Start and end of each sentence of a line."""
    start = 0
    for m in _SENTENCE.finditer(line):
        yield start, m.end()
        start = m.end()
    yield start, len(line)


def _spans(text: str) -> tuple[list[str], list[int], list[int]]:
    """A text's words, and each sentence's start in the text and number of words; sentences without words are left out."""
    words, starts, counts, at = [], [], [], 0
    for line in text.split("\n"):
        for start, end in _sentences(line):
            if own := words_of(line[start:end]):
                starts.append(at + start)
                counts.append(len(own))
                words += own
        at += len(line) + 1
    return words, starts, counts


def scan(text: str, templates: Templates, threshold: float) -> list[tuple[str, float, int]]:
    """``(licence, best coefficient, where its piece starts)`` of the licences found, by name; of equal coefficients the earliest piece. A piece counts for its best templates only."""
    having = templates.having
    words = words_of(text)
    met = Counter(p for p in zip(words, words[1:], strict=False) if p in having)
    possible = templates.possible(met, threshold) if met else set()
    if not possible:
        return []
    words, starts, counts = _spans(text)  # cut by sentence, words are the same unless one goes on after a stop
    of = [[(i, most) for i, most in having.get(p, ()) if i in possible] for p in zip(words, words[1:], strict=False)]
    first = [0]
    for n in counts:
        first.append(first[-1] + n)
    hits = [0]  # bigrams of any possible template that begin before each word
    for x in of:
        hits.append(hits[-1] + bool(x))
    share = threshold / (2 - threshold)
    longest, shortest = max(templates.sizes[i] for i in possible) / share + 1e-9, min(templates.sizes[i] for i in possible)
    best: dict[str, tuple[float, int]] = {}
    for k, at in enumerate(starts):
        low = first[k]
        # no piece that begins here has enough known bigrams: neither of its own, nor of a template
        if hits[min(low + int(longest) + 1, len(of))] - hits[low] < max(1, share * shortest - 1e-9) or (k + 1 < len(starts) and hits[min(first[k + 1], len(of))] == hits[low]):
            continue
        seen: Counter = Counter()
        common: Counter = Counter()
        done = low
        for end in first[k + 1 :]:
            size = end - low - 1
            if size > longest:
                break
            for b in range(done, end - 1):
                for i, most in of[b]:
                    key = (i, words[b], words[b + 1])
                    seen[key] += 1
                    if seen[key] <= most:
                        common[i] += 1
            done = max(done, end - 1)
            scored = [(2 * n / (size + templates.sizes[i]), i) for i, n in common.items()]
            top = max(scored, default=(0.0, 0))[0]
            if top >= threshold:
                for d, i in scored:
                    name = templates.names[i]
                    if d == top and (name not in best or (-d, at) < (-best[name][0], best[name][1])):
                        best[name] = (d, at)
    return [(name, d, at) for name, (d, at) in sorted(best.items())]


def template_rows(templates: DataFrame | tuple[tuple[str, str], ...]) -> tuple[tuple[str, str], ...]:
    """Templates as rows ``(licence, text)``; a table is measured before it is collected, null names and texts are left out."""
    if not isinstance(templates, DataFrame):
        return templates
    rows = templates.select(F.col("licence").cast("string"), F.col("text").cast("string")).dropna()
    if (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) > TABLE_BYTES:
        raise ValueError(f"the templates have more than {TABLE_BYTES} bytes")
    return tuple(sorted(tuple(r) for r in rows.collect()))


def licence_hits(docs: DataFrame, threshold: float = THRESHOLD, templates: DataFrame | tuple[tuple[str, str], ...] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, licence, dice, start)``: one row for each row of ``docs`` and licence in it; ``templates`` may be a table ``(licence, text)``.

    Null texts count as empty and have none; repeated rows give repeated results; an empty table gives an empty result; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    table = template_rows(templates)
    schema = pa.schema([("doc_id", pa.int64()), ("licence", pa.string()), ("dice", pa.float64()), ("start", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Templates(table)
        for b in batches:
            found = [(doc, *hit) for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for hit in scan(text, made, threshold)]
            cols = list(zip(*found, strict=True)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types, strict=True)], schema=schema)

    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, licence string, dice double, start bigint")
