"""License scans: lines, whole texts and passages against license templates by the Dice coefficient of their word bigrams.

A unit is a line, a whole text, or a run of as many words as the template has, wherever it begins and whatever line ends lie
in it. Words are runs of letters and digits, lower-cased in ASCII. A unit matches a template if twice their shared bigrams
reach ``THRESHOLD`` percent of both counts together. The counts alone bound that coefficient: a template is compared only
with lines and texts of a fitting size, and its runs are counted only in texts that hold enough of its bigrams at all. The
counts of all runs of a text come from differences: a bigram adds one to the runs that begin behind its last occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logstrata.llm.textblocks import LOWER, PrefixHash, flat, mix, slices, windows, word_spans

THRESHOLD = 80

# Usual short notices, standard headers and whole texts of common licenses, without names of holders and years.
TEMPLATES = {
    "AGPL-3.0": "This program is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "BSD-style": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has dedicated all copyright and related rights to this work to the public domain.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. "
        "You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."
    ),
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "BSD-2-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
        "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
        "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
        "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
        "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-opening": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "BSD-3-Clause-clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission."
    ),
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. "
        "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."
    ),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
        "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "LGPL-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. "
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "zlib-text": (
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, "
        "and to alter it and redistribute it freely, subject to the following restrictions: "
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. "
        "If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "3. This notice may not be removed or altered from any source distribution."
    ),
}

_WORD = ((LOWER >= 97) & (LOWER <= 122)) | ((LOWER >= 48) & (LOWER <= 57)) | (LOWER >= 128)
FOLD = np.where(_WORD, LOWER, np.uint8(32))


def _bigrams(data: np.ndarray, bounds: np.ndarray, lines: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Hash and unit of each word pair inside a unit, the text of each unit, and how many units there are."""
    edges = bounds if not lines else np.union1d(bounds, np.flatnonzero(data == 10) + 1)
    starts, ends, _ = word_spans(FOLD[data], bounds)
    unit = np.searchsorted(edges, starts, "right") - 1
    pairs = windows(PrefixHash(FOLD[data]).of(starts, ends), 2)
    same = unit[1:] == unit[:-1] if len(unit) else np.zeros(0, bool)
    return pairs[same], unit[1:][same], np.searchsorted(bounds, edges[:-1], "right") - 1, len(edges) - 1


class Templates:
    """The distinct bigrams of all templates, who holds which, and how many each has."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        texts = pa.array([templates[n] for n in self.names])
        pairs, owner, _, _ = _bigrams(*flat(texts), lines=False)
        self.hashes, back = np.unique(pairs, return_inverse=True)
        self.holds = np.zeros((len(self.hashes), len(self.names)), np.int64)
        self.holds[back, owner] = 1
        self.sizes = self.holds.sum(0)
        starts, _, owner = word_spans(FOLD[flat(texts)[0]], flat(texts)[1])
        self.words = np.bincount(owner, minlength=len(self.names))

    def passages(self, data: np.ndarray, bounds: np.ndarray, threshold: int) -> Iterator[tuple[int, int, int, float]]:
        """Text, template, number of passages (matching runs that follow each other are one) and the best coefficient."""
        pairs, owner, _, _ = _bigrams(data, bounds, lines=False)
        at = np.minimum(np.searchsorted(self.hashes, pairs), len(self.hashes) - 1)
        known = self.hashes[at] == pairs
        texts = len(bounds) - 1
        # Distinct bigrams of a template that a text holds at all.
        seen = np.unique(owner[known].astype(np.int64) * len(self.hashes) + at[known])
        held = np.zeros((texts, len(self.names)), np.int64)
        if len(seen):
            some, first = np.unique(seen // len(self.hashes), return_index=True)
            held[some] = np.add.reduceat(self.holds[seen % len(self.hashes)], first, axis=0)
        enough = (held * (200 - threshold) >= threshold * self.sizes) & (held > 0)
        cuts = np.searchsorted(owner, np.arange(texts + 1))
        for text in np.flatnonzero(enough.any(1)).tolist():
            own, place, here = pairs[cuts[text] : cuts[text + 1]], at[cuts[text] : cuts[text + 1]], known[cuts[text] : cuts[text + 1]]
            order = np.argsort(own, kind="stable")
            before = np.full(len(own), -1)
            again = own[order][1:] == own[order][:-1]
            before[order[1:][again]] = order[:-1][again]
            for template in np.flatnonzero(enough[text]).tolist():
                length = int(self.words[template]) - 1
                if length < 1 or len(own) < length:
                    continue
                part = here & (self.holds[place, template] > 0)
                distinct = self._in_runs(np.arange(len(own)), before, length)
                shared = self._in_runs(np.flatnonzero(part), before[part], length, len(own))
                fits = 200 * shared >= threshold * (distinct + self.sizes[template])
                if fits.any():
                    first = fits & ~np.concatenate(([False], fits[:-1]))
                    yield text, template, int(first.sum()), float((2 * shared / (distinct + self.sizes[template])).max())

    @staticmethod
    def _in_runs(places: np.ndarray, before: np.ndarray, length: int, total: int | None = None) -> np.ndarray:
        """For each run of ``length`` places, how many of the given ones are the first of their kind in it."""
        total = len(places) if total is None else total
        steps = np.zeros(total + 1, np.int64)
        np.add.at(steps, np.maximum(before + 1, np.maximum(places - length + 1, 0)), 1)
        np.add.at(steps, places + 1, -1)
        return np.cumsum(steps)[: total - length + 1]

    def match(self, data: np.ndarray, bounds: np.ndarray, lines: bool, threshold: int) -> tuple[np.ndarray, ...]:
        """Text, template, shared bigrams and both sizes of each match."""
        pairs, unit, text, units = _bigrams(data, bounds, lines)
        at = np.minimum(np.searchsorted(self.hashes, pairs), len(self.hashes) - 1)
        known = self.hashes[at] == pairs
        # A match shares at least this many bigrams, whatever the size of the unit.
        likely = np.bincount(unit[known], minlength=units) >= threshold * self.sizes.min() / 200
        own = likely[unit]
        _, first = np.unique(mix(pairs[own] + unit[own].astype(np.uint64)), return_index=True)
        unit, at, known = unit[own][first], at[own][first], known[own][first]
        sizes = np.bincount(unit, minlength=units)
        seen, back = np.unique(unit[known], return_inverse=True)
        shared = np.zeros((len(seen), len(self.names)), np.int64)
        fits = (sizes[seen][:, None] * threshold <= (200 - threshold) * self.sizes) & (self.sizes * threshold <= (200 - threshold) * sizes[seen][:, None])
        np.add.at(shared, back, self.holds[at[known]])
        hit, template = np.nonzero(fits & (200 * shared >= threshold * (sizes[seen][:, None] + self.sizes)))
        return text[seen[hit]], template, shared[hit, template], sizes[seen[hit]], self.sizes[template]


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: int = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each text and license that match: matching ``lines`` and ``passages``, and ``dice`` of the best unit.

    Runs that match one after another are one passage. Null texts, texts without two words, and an empty table give no rows.
    Repeated rows give repeated rows; other columns are ignored. Texts are read whole.
    """
    known = Templates(TEMPLATES if templates is None else templates)
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = source.schema["key"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, bounds = flat(part.column("text"))
            found: dict[tuple[int, int], list[float]] = {}
            for row, template, n, dice in known.passages(data, bounds, threshold):
                found[row, template] = [0, dice, n]
            for lines in (True, False):
                for row, template, shared, a, b in zip(*(x.tolist() for x in known.match(data, bounds, lines, threshold))):
                    best = found.setdefault((row, template), [0, 0.0, 0])
                    best[0] += lines
                    best[1] = max(best[1], 2 * shared / (a + b))
            rows = pa.array([r for r, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("key").take(rows),
                    pa.array([known.names[t] for _, t in found], pa.string()),
                    pa.array([v[0] for v in found.values()], pa.int64()),
                    pa.array([v[2] for v in found.values()], pa.int64()),
                    pa.array([v[1] for v in found.values()], pa.float64()),
                ],
                names=["key", "license", "lines", "passages", "dice"],
            )

    return source.mapInArrow(scan, f"key {kind}, license string, lines long, passages long, dice double").withColumnRenamed("key", key)


def oracle(threshold: int = THRESHOLD) -> str:
    """The same rows in DuckDB's SQL, unit by unit and template by template."""
    templates = ", ".join(f"('{name}', '{notice}')" for name, notice in TEMPLATES.items())
    words = (
        "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        "'[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+')"
    )
    pairs = "list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))])"
    return f"""
with t as (select name as license, {words.format('notice')} as w from (values {templates}) as v(name, notice)),
tb as (select license, len(w) as words, {pairs} as b from t),
units as (
  select doc_id, 1 as is_line, unnest(string_split(text, chr(10))) as unit from documents
  union all select doc_id, 0, text from documents),
u as (select doc_id, is_line, {words.format('unit')} as w from units where unit is not null),
ub as (select doc_id, is_line, {pairs} as b from u where len(w) > 1),
m as (
  select doc_id, license, is_line, 2 * len(list_intersect(ub.b, tb.b)) as twice, len(ub.b) + len(tb.b) as total
  from ub join tb on len(ub.b) * {threshold} <= {200 - threshold} * len(tb.b) and len(tb.b) * {threshold} <= {200 - threshold} * len(ub.b)),
whole as (select doc_id, [w[i] || ' ' || w[i + 1] for i in range(1, len(w))] as p from (select doc_id, {words.format('text')} as w from documents) where len(w) > 1),
holding as (
  select doc_id, license, words, b, p from whole join tb on len(p) >= words - 1
  where len(list_intersect(list_distinct(p), b)) * {200 - threshold} >= {threshold} * len(b)),
runs as (select doc_id, license, b, i, list_distinct(p[i:i + words - 2]) as r from (select *, unnest(range(1, len(p) - words + 3)) as i from holding)),
fitting as (
  select doc_id, license, i, 2 * len(list_intersect(r, b)) / (len(r) + len(b)) as dice from runs
  where 200 * len(list_intersect(r, b)) >= {threshold} * (len(r) + len(b))),
islands as (select *, i - row_number() over (partition by doc_id, license order by i) as island from fitting),
found as (
  select doc_id, license, is_line as lines, 0 as passages, twice / total as dice from m where 100 * twice >= {threshold} * total
  union all select doc_id, license, 0, count(distinct island), max(dice) from islands group by doc_id, license)
select doc_id, license, sum(lines)::bigint as lines, sum(passages)::bigint as passages, max(dice) as dice from found group by doc_id, license
"""
