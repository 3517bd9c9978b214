"""License scans by conditional compression.

Words around cues of licensing, on whatever lines they stand, are candidate windows: a
longest template's words on either side of every cue, so no notice is cut. Each window is
compressed plainly and with every license template as a zstandard raw dictionary; templates
are taken by how much they shorten it, and confirmed word by word wherever they lie in the
window. A window is much longer than a notice, so a short notice may save less in it than its
dictionary costs: the size reduction ranks templates and rules none out. What the window
does not show is measured again on the place itself, without the words around it. Of all
places that overlap the best stays: most words of a template, less DIFFERENCE_COSTS for each
that differs, so that a whole text is preferred to a notice inside it; of equal ones the
template with the greater reduction.

Defined results: null texts are empty; a text without licenses has an empty list; words
alone are compared, so line ends, white space and comment signs between them do not
matter; long runs of cues are read in windows that overlap by a longest template, so
windows are bounded while every cue of the whole text is read; repeated rows count as rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import deque
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices

#: Names, notices and texts of public licenses, as their stewards word them.
BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
GNU_NOTICE = """you can redistribute it and/or modify it under the terms of the GNU {0} Public License as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} Public License for more details."""
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL", "under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights: CC0 1.0 Universal"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0"),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0"),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", f"{BSD_HEAD} {BSD_TAIL}"),
    ("BSD-3-Clause", f"{BSD_HEAD} {BSD_THIRD} {BSD_TAIL}"),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("GPL-2.0-or-later", GNU_NOTICE.format("General", "2")),
    ("GPL-3.0-or-later", GNU_NOTICE.format("General", "3")),
    ("LGPL-2.1-or-later", GNU_NOTICE.format("Lesser General", "2.1")),
    ("LGPL-3.0-or-later", GNU_NOTICE.format("Lesser General", "3")),
    ("AGPL-3.0-or-later", GNU_NOTICE.format("Affero General", "3")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"""),
)
#: Words of a cue may stand on different lines.
CUE = re.compile(r"licen[cs]|copyright|creative[\W_]+commons|public[\W_]+domain|hereby[\W_]+granted|redistribution[\W_]+and[\W_]+use|permission[\W_]+is[\W_]+granted|\bcc[\W_]*(?:by|0)\b", re.IGNORECASE)
#: Share of a template's words that may differ.
MAX_DIFFERENCE = 0.1
DIFFERENCE_COSTS = 3
#: Code points of a word that are compared; words of templates are shorter.
WORD_CHARS = 64

_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


def words_of(text: str) -> list[str]:
    return [m[0].lower() for m in _WORD.finditer(text)]


def windows(text: str, span: int):
    """Lists of (word, start, end): the words of text within span words of a cue, at most
    3 * span in a list. Lists of one run overlap by span words."""
    cues = CUE.finditer(text)
    cue, begin = next(cues, None), 0
    while cue is not None:
        # far enough back for span words and one that may be cut
        back = 16 * span
        while (lo := max(0, cue.start() - back)) > begin and sum(1 for _ in islice(_WORD.finditer(text, lo, cue.start()), span + 2)) < span + 2:
            back *= 2
        run, before, left, fresh = None, deque(maxlen=span), span, False
        for m in _WORD.finditer(text, lo):
            if lo and m.start() <= lo + 1 and m.end() <= cue.start():
                continue
            word = (m[0][:WORD_CHARS].lower(), m.start(), m.end())
            if run is None:
                if m.end() <= cue.start():
                    before.append(word)
                    continue
                run = list(before)
                begin = run[0][1] if run else m.start()
            while cue is not None and cue.start() < m.end():
                cue, left = next(cues, None), span
            run.append(word)
            fresh = True
            if len(run) == 3 * span:
                yield run
                run, fresh = run[-span:], False
            left -= 1
            if not left:
                break
        if fresh:
            yield run


class Scanner:
    """The templates as compressors and word lists, built once in each task."""

    def __init__(self, templates=TEMPLATES):
        import zstandard

        self.plain = zstandard.ZstdCompressor(level=3)
        self.named = []
        for name, t in templates:
            own = words_of(t)
            most = max(d for d in range(len(own)) if d <= MAX_DIFFERENCE * len(own))
            # of most + 1 parts of a template one stands unchanged wherever no more than most words differ
            cuts = [len(own) * k // (most + 1) for k in range(most + 2)]
            parts = [f" {' '.join(own[x:y])} " for x, y in zip(cuts, cuts[1:])]
            packed = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(" ".join(own).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            self.named.append((name, own, most, parts, packed))
        self.span = max(len(own) + most for _, own, most, _, _ in self.named)

    def reductions(self, block: str) -> list[tuple[float, int]]:
        """(share by which a template shortens the block, below 0 if it does not; template), the greatest first."""
        data = block.encode("utf-8", "surrogatepass")
        alone = len(self.plain.compress(data))
        return sorted(((1 - len(c.compress(data)) / alone, i) for i, (*_, c) in enumerate(self.named)), key=lambda x: (-x[0], x[1]))

    def reduction(self, i: int, block: str) -> float:
        data = block.encode("utf-8", "surrogatepass")
        return 1 - len(self.named[i][4].compress(data)) / len(self.plain.compress(data))

    def places(self, i: int, block: str, words: list[tuple[str, int, int]]):
        """(words that differ, start, end) of the places of the words where template i lies."""
        _, own, most, parts, _ = self.named[i]
        if not any(p in block for p in parts):
            return
        # row k: (differences, first word) of the best place that ends here for the first k words of the template
        last = [(k, 0) for k in range(len(own) + 1)]
        for j, (word, _, end) in enumerate(words):
            row = [(0, j + 1)]
            for k, w in enumerate(own, 1):
                d, at = last[k - 1] if w == word else row[k - 1] if row[k - 1][0] < last[k][0] else last[k]
                row.append((d, at) if w == word else (d + 1, at))
            last = row
            if row[-1][0] <= most:
                yield row[-1][0], words[row[-1][1]][1], end

    def find(self, text: str) -> list[tuple[int, int, str, int, float]]:
        """(start, end, license, differing words, size reduction) of all winners, none overlapping another."""
        seen = []
        for words in windows(text, self.span):
            block = f" {' '.join(w for w, _, _ in words)} "
            for share, i in self.reductions(block):
                for d, a, b in self.places(i, block, words):
                    own = share if share > 0 else self.reduction(i, " ".join(w for w, x, y in words if a <= x and y <= b))
                    seen.append((DIFFERENCE_COSTS * d - len(self.named[i][1]), d, -own, i, a, b))
        won, at = [], []
        won, at = [], []
        for _, d, share, i, a, b in sorted(seen):
            k = bisect_left(at, a)
            if (k == 0 or won[k - 1][1] <= a) and (k == len(won) or b <= at[k]):
                at.insert(k, a)
                won.insert(k, (a, b, self.named[i][0], d, round(-share, 6)))
        return won


OUT = "doc_id long, n_licenses long, n_exact long, licenses string, spans array<struct<start:long,end:long,license:string,differences:long,reduction:double>>"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("license", pa.string()), ("differences", pa.int64()), ("reduction", pa.float64())]))
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_licenses", pa.int64()), ("n_exact", pa.int64()), ("licenses", pa.string()), ("spans", _SPAN)])


def _scan(batches):
    scanner = Scanner()
    for batch in slices(batches):
        rows = []
        for i in range(batch.num_rows):
            found = scanner.find(batch.column(1)[i].as_py() or "")
            rows.append({
                "doc_id": batch.column(0)[i].as_py(), "n_licenses": len(found), "n_exact": sum(not f[3] for f in found),
                "licenses": ",".join(f"{f[2]}:{f[0]}:{f[1]}" for f in found),
                "spans": [dict(zip(("start", "end", "license", "differences", "reduction"), f, strict=True)) for f in found],
            })
        yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row for each of docs (doc_id, text) with the licenses its text states."""
    from pyspark.sql import functions as F

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan, OUT)


def op3_licenses(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).drop("spans")
