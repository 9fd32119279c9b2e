"""License scan: texts against licence templates by Dice coefficient.

A text, each of its paragraphs and each of its lines is a unit. A unit and a
template are sets of word pairs; their Dice coefficient is twice the shared
pairs over the sum of both sizes. It can reach a threshold t only if the sizes
a and b obey ``t / (2 - t) <= a / b <= (2 - t) / t``, so a unit is compared with
the few templates in that range and most units with none. The templates are
constants of the scan: nothing is joined or shuffled.

A licence inside a longer text or line is found as a passage: any run of the text's
words, across lines and paragraphs, in which the sizes obey the bounds. Only runs are
tried that begin with a pair of the template and end before that pair comes again, as
others have the same pairs or more foreign ones. So a text's work is at most its length
times a template's, and none if it has too few of the template's pairs. Passages
are not counted as units.

Words are letters, digits and bytes above ASCII, in ASCII lower case; British
and American spelling of "licence" are one, and lines that begin with a
copyright sign or word are left out, as each owner has another.

Defined results: a null, blank or one-word text has no unit with word pairs and
matches nothing; its best coefficient is 0 and its licence null. Ties go to the
template that sorts first. Repeated rows get a row each. Other columns pass
unchanged; input columns named like a result are replaced.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyframe.llm.common import add_columns, as_bytes

THRESHOLD = 0.8
RESULT = "licence string, dice double, licences array<string>, n_units bigint"

_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_SPELLING = {b"licence": b"license", b"licenced": b"licensed", b"licences": b"licenses"}

# Public notices and short licence texts, by SPDX identifier.
_PERMISSION = (
    'to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    'publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is '
    'furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall '
    'be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY '
    'OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A '
    'PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, '
    'DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION '
    'WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
)
_BSD = (
    'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the '
    'following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of '
    'conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, '
    'this list of conditions and the following disclaimer in the documentation and/or other materials provided with the '
    'distribution. '
)
_BSD_THIRD = (
    '3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote '
    'products derived from this software without specific prior written permission. '
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    'INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE '
    'DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, '
    'SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR '
    'SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, '
    'WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF '
    'THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
)
_GPL = (
    'This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public '
    'License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later '
    'version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the '
    'implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more '
    'details. You should have received a copy of the GNU General Public License along with this program. If not, see '
    'https://www.gnu.org/licenses/.'
)
_APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
    'License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable '
    'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
    'WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing '
    'permissions and limitations under the License.'
)
_ISC = (
    'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, '
    'provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS '
    'IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    'MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL '
    'DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, '
    'NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
)
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), ' + _PERMISSION),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", _APACHE),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + _BSD_THIRD + _BSD_END),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("ISC", _ISC),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", _GPL),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
)


def line_words(line: bytes) -> list[bytes]:
    """Normalised words of a line; none of a copyright line."""
    words = line.translate(_WORD_BYTES).split()
    if words and (words[0] == b"copyright" or words[0] == "©".encode()):
        return []
    return [_SPELLING.get(w, w) for w in words]


def pairs(words: list[bytes]) -> set[tuple[bytes, bytes]]:
    return set(zip(words, words[1:], strict=False))


class Scan:
    """Templates by number of word pairs, with the ranges of sizes that can match them."""

    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD):
        self.threshold = threshold
        sets = [(name, pairs([w for line in text.encode().split(b"\n") for w in line_words(line)])) for name, text in templates]
        # The small shift keeps sizes that lie on a bound in spite of rounding.
        self.sets = [(name, s, threshold / (2 - threshold) * len(s) - 1e-9, (2 - threshold) / threshold * len(s) + 1e-9) for name, s in sets if s]
        self.having: dict[tuple[bytes, bytes], list[int]] = {}
        for k, (_, template, _, _) in enumerate(self.sets):
            for pair in template:
                self.having.setdefault(pair, []).append(k)
        self.least = min((low for *_, low, _ in self.sets), default=float("inf"))

    def unit(self, words: list[bytes], found: dict[str, float]) -> None:
        """Add the templates that a unit reaches."""
        if len(words) - 1 < self.least:  # a set has at most as many pairs as the unit
            return
        own = None
        for name, template, low, high in self.sets:
            if len(words) - 1 < low:
                continue
            own = pairs(words) if own is None else own
            if low <= len(own) <= high:
                dice = 2 * len(own & template) / (len(own) + len(template))
                if dice >= self.threshold and dice > found.get(name, 0.0):
                    found[name] = dice

    def passages(self, words: list[bytes], found: dict[str, float]) -> None:
        """Add the templates that a run of words reaches."""
        sequence = list(zip(words, words[1:], strict=False))
        starts: dict[int, list[int]] = {}
        for at, templates in enumerate(map(self.having.get, sequence)):
            for k in templates or ():
                starts.setdefault(k, []).append(at)
        for k, places in starts.items():
            name, template, low, high = self.sets[k]
            if len(places) < low or len({sequence[at] for at in places}) < low:  # too few can be shared
                continue
            best = found.get(name, 0.0)
            for start in places:
                if best == 1.0:
                    break
                seen: set[tuple[bytes, bytes]] = set()
                shared = 0
                for at in range(start, len(sequence)):
                    pair = sequence[at]
                    if pair in seen:
                        if pair == sequence[start]:
                            break
                        continue
                    seen.add(pair)
                    if len(seen) > high:
                        break
                    if pair in template:
                        shared += 1
                        best = max(best, 2 * shared / (len(seen) + len(template)))
            if best >= self.threshold:
                found[name] = best

    def text(self, text: bytes) -> tuple[dict[str, float], int]:
        """Best coefficient per licence reached, and the number of different units."""
        found: dict[str, float] = {}
        units: set[tuple[bytes, ...]] = set()
        block: list[bytes] = []
        whole: list[bytes] = []
        for line in text.split(b"\n"):
            words = line_words(line)
            if words:
                units.add(tuple(words))
            if line.strip():
                block += words
            else:
                units.add(tuple(block))
                whole += block
                block = []
        units.add(tuple(block))
        units.add(tuple(whole + block))
        units.discard(())
        for unit in units:
            self.unit(list(unit), found)
        self.passages(whole + block, found)
        return found, len(units)


def scan(docs: DataFrame, keep: list[str], text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """The columns ``keep``, the best licence and its coefficient, all licences reached in order, and the number of units."""

    def start():
        scanner = Scan(templates, threshold)

        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            best, dice, every, units = [], [], [], []
            for t in as_bytes(batch.column(text)):
                found, n = scanner.text(t or b"")
                ranked = sorted(found, key=lambda name: (-found[name], name))
                best.append(ranked[0] if ranked else None)
                dice.append(found[ranked[0]] if ranked else 0.0)
                every.append(sorted(found))
                units.append(n)
            return [pa.array(best, pa.string()), pa.array(dice, pa.float64()), pa.array(every, pa.list_(pa.string())), pa.array(units, pa.int64())]

        return work

    return add_columns(docs, text, keep, RESULT, start)
