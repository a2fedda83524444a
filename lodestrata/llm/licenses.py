"""License scans by patience alignment of texts with license templates.

Words that occur once in the text and once in the template are anchors; the
longest increasing subsequence of their positions is kept, and the gaps between
anchors are aligned in the same way. Gaps without unique words are aligned by
longest common subsequence. The share of a template's words that align is its
coverage.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, rows_of, sliced

# Public license statements, the opening terms of public licenses, and whole texts of the shorter ones.
_BSD_DISCLAIMER = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT-terms": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    # Whole texts.
    "0BSD-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
    + _BSD_DISCLAIMER,
    "BSD-3-Clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
    + _BSD_DISCLAIMER,
    "BSL-1.0-text": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
}

WORD = re.compile(rb"[a-z0-9\x80-\xff]+(?:[.-][a-z0-9]+)*")
#: Share of a template's words that have to align; of a statement shorter than so many words, all that name the license as well.
COVERAGE, SHORT = 0.8, 25


def words_with_bounds(data: bytes) -> tuple[list[bytes], list[tuple[int, int]]]:
    found = [(m[0], m.span()) for m in WORD.finditer(data.lower())]
    return [w for w, _ in found], [s for _, s in found]


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of pairs that increase in both members; pairs come sorted by the first."""
    ends: list[int] = []
    last: list[int] = []
    before = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(ends, j)
        if at == len(ends):
            ends.append(j)
            last.append(k)
        else:
            ends[at], last[at] = j, k
        before[k] = last[at - 1] if at else -1
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def patience(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Aligned positions (in a, in b), increasing in both."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = _increasing([(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in place])
        if not anchors:
            where: dict[bytes, list[int]] = {}
            for j in range(b1 - 1, b0 - 1, -1):
                where.setdefault(b[j], []).append(j)
            # Several places of one word come in falling order, so that at most one of them is kept.
            out += _increasing([(i, j) for i in range(a0, a1) for j in where.get(a[i], ())])
            continue
        out += anchors
        for (i0, j0), (i1, j1) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)], strict=True):
            work.append((i0 + 1, i1, j0 + 1, j1))
    return sorted(out)


def _names_of(text: str) -> frozenset[int]:
    """The places of the words of a statement of under ``SHORT`` words that begin with a capital or hold a digit, the first word left out."""
    data = text.encode()
    found = [data[a:b] for a, b in words_with_bounds(data)[1]]
    if len(found) >= SHORT:
        return frozenset()
    return frozenset(i for i, w in enumerate(found) if i and (w[:1].isupper() or any(48 <= c <= 57 for c in w)))


class Scanner:
    def __init__(self, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE):
        self.coverage = coverage
        self.templates = [(name, w, Counter(w)) for name, text in sorted(templates.items()) if (w := words_with_bounds(text.encode())[0])]
        self.vocabulary = {w for _, words, _ in self.templates for w in words}
        self.required = {tuple(words_with_bounds(t.encode())[0]): _names_of(t) for t in templates.values()}

    def scan(self, data: bytes) -> list[tuple[str, float, int, int]]:
        """(template, coverage, start, end) of each match, in bytes, in order."""
        words, bounds = words_with_bounds(data)
        present = self.vocabulary.intersection(words)
        out = []
        for name, template, counts in self.templates:
            # What isn't in the text can't align: an upper bound of the coverage.
            if sum(c for w, c in counts.items() if w in present) < self.coverage * len(template):
                continue
            out += [(name, c, bounds[i][0], bounds[j][1]) for c, i, j in self._places(words, template, counts)]
        return sorted(out, key=lambda m: (m[2], m[3], m[0]))

    def _places(self, words: list[bytes], template: list[bytes], counts: Counter):
        """Every place of the text that aligns well enough, in order, none within another: (coverage, first word, last word).

        A place spans at most 5/4 of the template's words. Where the next words
        of that number hold enough of the template's, whatever their order, the
        place nearby that holds the most is aligned, else this one; the search
        goes on behind a match, or an eighth of the template further.
        """
        need, span, hop = self.coverage * len(template), len(template) + len(template) // 4, max(1, len(template) // 8)
        at, held = 0, self._overlaps(words, counts, span)
        tried: set[int] = set()
        while at < len(words):
            if held[at] < need:
                at += 1
                continue
            near = range(at, min(len(words), at + len(template) // 2 + 1))
            for place in (max(near, key=lambda i: (held[i], -i)), at):
                if place in tried:
                    continue
                tried.add(place)
                pairs = patience(words[place : place + span], template)
                if len(pairs) >= need and self._named(pairs, template):
                    yield len(pairs) / len(template), place + pairs[0][0], place + pairs[-1][0]
                    at = place + pairs[-1][0] + 1
                    break
            else:
                at += hop

    @staticmethod
    def _overlaps(words: list[bytes], counts: Counter, span: int) -> list[int]:
        """For each place, how many words of the template, repeats counted, the next ``span`` words hold; in one pass from the end."""
        have: Counter = Counter()
        total, out = 0, [0] * len(words)
        for i in range(len(words) - 1, -1, -1):
            w = words[i]
            if w in counts:
                have[w] += 1
                total += have[w] <= counts[w]
            if i + span < len(words):
                w = words[i + span]
                if w in counts:
                    total -= have[w] <= counts[w]
                    have[w] -= 1
            out[i] = total
        return out

    def _named(self, pairs: list[tuple[int, int]], template: list[bytes]) -> bool:
        """Whether the words of a short statement that name the license and its version are all there."""
        required = self.required[tuple(template)]
        return required <= {j for _, j in pairs}


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, matches)`` of every row: license, coverage, start and end in bytes of the text.

    Every place of the whole text that aligns with enough of a template is a
    match; those of one template don't overlap, those of several may, each with
    its own coverage, and are ordered by start, end and name. Null and empty
    texts have none. Rows are handled one by one, so
    repeated rows, null ids and other columns make no difference; an empty
    table gives no rows.
    """
    scanner = docs.sparkSession.sparkContext.broadcast(Scanner(templates, coverage))
    kinds = [("license", T.StringType(), pa.string()), ("coverage", T.DoubleType(), pa.float64()), ("start", T.IntegerType(), pa.int32()), ("end", T.IntegerType(), pa.int32())]
    schema = T.StructType([docs.schema[id_col], T.StructField("matches", T.ArrayType(T.StructType([T.StructField(n, t) for n, t, _ in kinds])))])
    arrow = pa.list_(pa.struct([(n, t) for n, _, t in kinds]))

    def run(batches):
        for batch in sliced(batches):
            found = [[dict(zip(("license", "coverage", "start", "end"), m, strict=True)) for m in scanner.value.scan(t)] for (t,) in rows_of([batch], "t")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, arrow)], schema.names)

    return docs.select(F.col(id_col), as_bytes(text_col).alias("t")).mapInArrow(run, schema)
