"""Licence scans by the likeness of text to licence templates."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm._frames import Carried, parts

_GNU = (
    ("GPL-1.0", "General", "1"),
    ("GPL-2.0", "General", "2"),
    ("GPL-3.0", "General", "3"),
    ("LGPL-2.0", "Library General", "2"),
    ("LGPL-2.1", "Lesser General", "2.1"),
    ("LGPL-3.0", "Lesser General", "3"),
    ("AGPL-3.0", "Affero General", "3"),
)


def _gnu_notices(kind: str, version: str) -> tuple[str, ...]:
    """The usual wordings for a GNU licence, the header of a source file last."""
    name = f"GNU {kind} Public License"
    full = version if "." in version else f"{version}.0"
    return (
        f"This work is licensed under the {name}, version {version}.",
        f"Licensed under the {name} v{version}.",
        f"Licensed under the {name} v{full}.",
        f"This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details. You should have received a copy of the {name} along with this program. If not, see <https://www.gnu.org/licenses/>.",
    )


_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. ",
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. ",
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
)

#: Creative Commons licences: the short name, and the long one in a notice; their versions before 4.0 with the word that follows.
_CC = (
    ("BY", "Attribution"),
    ("BY-SA", "Attribution-ShareAlike"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-ND", "Attribution-NoDerivs"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivs"),
)
_CC_VERSIONS = (("1.0", "Generic"), ("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"))


def _cc_notices(short: str, long: str) -> tuple[tuple[str, str], ...]:
    """The usual wordings of a licence in each earlier version, and one that names no version."""
    told = [(f"CC-{short}", f"Licensed under CC {short}.")]
    for version, word in _CC_VERSIONS:
        told.append((f"CC-{short}-{version}", f"Licensed under CC {short} {version}."))
        told.append((f"CC-{short}-{version}", f"This work is licensed under a Creative Commons {long} {version} {word} License."))
    return tuple(told)


#: Identifiers of six words: of shorter and longer ones, what they share with others could match.
_IDENTIFIERS = (
    *("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "EPL-2.0", "BSL-1.0", "CC0-1.0"),
    *(name for name, *_ in _GNU),
)

#: Public notices and short licence texts, by SPDX id. A text that reserves all
#: rights is listed under "All-Rights-Reserved".
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("All-Rights-Reserved", "All rights reserved."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", "Licensed under the ISC License."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", _BSD[0] + _BSD[2]),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "".join(_BSD)),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("MPL-2.0", "Licensed under the Mozilla Public License 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("EPL-2.0", "Licensed under the Eclipse Public License 2.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    *((f"Apache-{v}", f"Licensed under the Apache License, Version {v}.") for v in ("1.0", "1.1")),
    *((f"MPL-{v}", f"Licensed under the Mozilla Public License, version {v}.") for v in ("1.0", "1.1")),
    *((f"MPL-{v}", f"Licensed under the Mozilla Public License {v}.") for v in ("1.0", "1.1")),
    ("EPL-1.0", "Licensed under the Eclipse Public License 1.0."),
    *((f"Apache-{v}", f"Licensed under the Apache License {v}.") for v in ("1.0", "1.1", "2.0")),
    *(notice for short, long in _CC for notice in _cc_notices(short, long)),
    *((name, notice) for name, kind, version in _GNU for notice in _gnu_notices(kind, version)),
    *((name, f"SPDX-License-Identifier: {name}") for name in _IDENTIFIERS),
)

#: Bytes that do not end a word: digits, letters and everything beyond ASCII.
_LETTERS = bytes(b for b in range(256) if b >= 0x80 or chr(b).isalnum())
_TO_SPACE = bytes(b if b in _LETTERS else 0x20 for b in range(256))


def normalised(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words: runs of digits, letters and what is beyond ASCII."""
    return text.translate(_TO_SPACE).lower().split()


def bigrams(words: list[bytes]) -> frozenset[tuple[bytes, bytes]]:
    return frozenset(zip(words, words[1:], strict=False))


def dice(a: frozenset, b: frozenset) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


@dataclass(frozen=True)
class Scanner:
    """Templates by their bigrams, the least likeness, the longest runs held against each, all bigrams.

    A run of words is at most so much longer than its template as sets of bigrams may differ in size.
    """

    templates: tuple[tuple[str, frozenset], ...]
    least: float
    longest: tuple[int, ...]
    bigrams: frozenset

    @classmethod
    def of(cls, templates=TEMPLATES, least: float = 0.8) -> Scanner:
        told = [(name, normalised(text.encode())) for name, text in templates]
        longest = (int((len(words) - 1) * (2 - least) / least) for _, words in told)
        templates = tuple((name, bigrams(words)) for name, words in told)
        return cls(templates, least, tuple(longest), frozenset().union(*(b for _, b in templates)))

    def match(self, grams: frozenset) -> tuple[float, str] | None:
        """Likeness and name of the best template; of equal ones, the first by name.

        2 min / (sum of both sizes) bounds the likeness, so most templates are never compared.
        """
        found = [
            (dice(grams, b), name)
            for name, b in self.templates
            if b and 2 * min(len(grams), len(b)) >= self.least * (len(grams) + len(b))
        ]
        score, name = min(found, key=lambda f: (-f[0], f[1]), default=(0.0, ""))
        return (score, name) if score >= self.least else None

    def enough(self, shared: int, size: int) -> bool:
        """Whether ``shared`` bigrams of a template of ``size`` can make a match; rounding never says no."""
        return 2 * shared >= self.least * (shared + size) - 1e-9

    def scan(self, text: bytes) -> list[tuple[float, str]]:
        """Matches of the whole text, of its paragraphs and lines, each span once, and of runs of words.

        A text with too few bigrams of every template is not looked at further: no part of it can match.
        """
        words, units = _units(text)
        grams = bigrams(words)
        known = self.bigrams & grams
        possible = [k for k, (_, b) in enumerate(self.templates) if b and self.enough(len(b & known), len(b))]
        if not possible:
            return []
        found = []
        for start, end in units:
            match = self.match(grams if end - start == len(words) else bigrams(words[start:end]))
            if match is not None:
                found.append((start, end, *match))
        return [(score, name) for _, _, score, name in found] + self.inside(words, found, possible)

    def inside(self, words: list[bytes], told: list[tuple[int, int, float, str]], possible: list[int]) -> list[tuple[float, str]]:
        """Matches of runs of words that begin and end anywhere, beside the units ``told``.

        From each word pair of a template the best run is held. Of runs that share words the best
        one counts (then the longer one, then name and place decide). A run that meets a unit of its own license is already
        told and not counted again; such runs go first, so that no other license takes their words.
        """
        units: dict[str, bytearray] = {}
        for start, end, _, name in told:
            units.setdefault(name, bytearray(len(words)))[start:end] = b"\1" * (end - start)
        pairs = list(zip(words, words[1:], strict=False))
        runs = []
        for k in possible:
            name = self.templates[k][0]
            for score, start, end in self.runs(pairs, k):
                known = name in units and units[name].find(1, start, end) >= 0
                runs.append((not known, -score, start - end, name, start, end))
        taken, found = bytearray(len(words)), []
        for new, score, _, name, start, end in sorted(runs):
            if taken.find(1, start, end) < 0:
                taken[start:end] = b"\1" * (end - start)
                if new:
                    found.append((-score, name))
        return found

    def runs(self, pairs: list[tuple[bytes, bytes]], k: int) -> Iterator[tuple[float, int, int]]:
        """The best run of words, as likeness, start and end, from each pair of template ``k`` that has one.

        The best run from a pair ends with another of the template. A start is only tried when the
        pairs within reach are enough; their number is kept while going through the text once.
        """
        grams, longest = self.templates[k][1], self.longest[k]
        at = [i for i, pair in enumerate(pairs) if pair in grams]
        within, ahead = Counter(), 0
        for start in at:
            while ahead < len(at) and at[ahead] < start + longest:
                within[pairs[at[ahead]]] += 1
                ahead += 1
            if self.enough(len(within), len(grams)):
                best, end = 0.0, start
                seen, shared = set(), 0
                for i in range(start, at[ahead - 1] + 1):
                    pair = pairs[i]
                    if pair in seen:
                        continue
                    seen.add(pair)
                    if pair in grams:
                        shared += 1
                        score = 2 * shared / (len(seen) + len(grams))
                        if score > best:
                            best, end = score, i + 2
                if best >= self.least:
                    yield best, start, end
            within[pairs[start]] -= 1
            if not within[pairs[start]]:
                del within[pairs[start]]


def _units(text: bytes) -> tuple[list[bytes], list[tuple[int, int]]]:
    """The words of a text, and which of them are its units.

    Units are lines that are not blank, paragraphs of several such lines, and the text if of several paragraphs.
    """
    words: list[bytes] = []
    units: list[tuple[int, int]] = []
    paragraphs, lines, first = 0, 0, 0
    for line in [*text.split(b"\n"), b""]:
        if line.strip():
            if not lines:
                first = len(words)
            lines += 1
            start = len(words)
            words += normalised(line)
            units.append((start, len(words)))
        else:
            if lines:
                paragraphs += 1
            if lines > 1:
                units.append((first, len(words)))
            lines = 0
    if paragraphs > 1:
        units.append((0, len(words)))
    return words, units


def matches(text: Column, scanner: Scanner) -> Column:
    """Array of (score, license) of every match in a text, best first; null text: empty."""

    @F.arrow_udf("array<struct<score: double, license: string>>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("score", pa.float64()), ("license", pa.string())]))
        for batch in batches:
            rows = []
            for part in parts(pc.cast(batch, pa.binary())):
                for raw in part.to_pylist():
                    found = sorted(scanner.scan(raw or b""), key=lambda m: (-m[0], m[1]))
                    rows.append([{"score": s, "license": n} for s, n in found])
            yield pa.array(rows, kind)

    return of(text)


def scan(docs: DataFrame, text: str = "text", templates=TEMPLATES, least: float = 0.8) -> DataFrame:
    """``docs`` with ``license``, ``license_score``, ``n_matches`` and ``licenses``.

    Every line, every paragraph of several lines and the whole text are normalised (case,
    punctuation and white space don't count) and held against the templates by the Dice coefficient
    of their sets of word bigrams. Templates whose size alone keeps the coefficient under ``least``
    are not compared. So are runs of words that begin and end anywhere, across lines and paragraphs
    or inside a line, up to 2 / least - 1 times as long as the template; a run counts where no unit tells
    of the same license, and of runs that share words only the best. ``license`` is the best match
    (null: none; ties by name), ``licenses`` all names found, sorted.

    Null and empty texts match nothing. Whole texts are read, whatever their length. Repeated rows
    are all kept, an empty table gives an empty table. Input columns with the names of the
    results are replaced, others kept. One pass over the rows, no shuffle.
    """
    carried = Carried(docs)
    found = carried.flat.withColumn("_m", matches(carried.column(text), Scanner.of(templates, least)))
    first = F.get("_m", F.lit(0))
    return carried.named(
        found,
        added={
            "license": first.license,
            "license_score": first.score,
            "n_matches": F.size("_m").cast("bigint"),
            "licenses": F.array_sort(F.array_distinct(F.col("_m.license"))),
        },
    )
