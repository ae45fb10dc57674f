"""License scans by conditional compression.

Blocks of a text that speak of licenses are compressed alone and with each license template as a raw zstandard
dictionary. Templates are ranked by the bytes that they save; those that save less than ``LEAST_SHARE`` of what they take
compressed themselves are out. Then they are confirmed in that order by their wording: the template's words are aligned with the
block's, and the differing words are counted. The first that is confirmed is the winner: its places are findings, no further
template is looked at there, and what lies between and beside them is a block again. A finding is exact
when no words differ; it stands while they are at most ``MOST_DIFFERENT`` of the template's words and neither a
number of the template nor a word of ``TELLING`` is among them, so that versions and kinds are told apart.

An SPDX tag is no wording but names its licenses: each identifier of its expression is a finding as it is written, with
``-only``, ``-or-later`` or ``+``.

A block is a line with a hint, or its part around the hint, for templates of one line. For longer templates it is the text around hints, as far as the
longest template reaches, cut into parts of bounded length that overlap by as much.
Looked for are the licenses of ``NAMES`` by notice, all by SPDX tag, and the permission texts and file headers of ``TEXTS``. The whole
texts of Apache, GPL, LGPL, AGPL, MPL and Creative Commons licenses are not among them. What leads to "under" in a notice is free.
Null and empty texts have no findings. A text may have many; repeated rows have theirs each. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import difflib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVEL = 3
LEAST_SHARE = 0.3
MOST_DIFFERENT = 0.1
#: How far around a hint a notice of one line is looked for.
NOTICE_REACH = 400
HINT = r"(?i)licen[sc]e|copyright|permission|redistribut|free software|cc[ -]by|creative commons|gpl|mpl 2|spdx|©"
TAG = re.compile(r"SPDX-License-Identifier:[ \t]*((?:[\w.+-]+|[()])(?:[ \t]*(?:[\w.+-]+|[()]))*)", re.IGNORECASE)
IDENTIFIER = re.compile(r"[\w.+-]+")
WORD = re.compile(r"[^\W_]+(?:\.\d+)*")

# Notices and license texts without names and years, by SPDX identifier.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "Licensed under the Mozilla Public License, Version 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
}
# Names as notices give them; what leads to "under" does not count.
NAMES = {
    "Apache-2.0": ("Apache License 2.0", "Apache License, Version 2.0", "Apache 2.0 License", "Apache-2.0 License"),
    "MIT": ("MIT License",),
    "ISC": ("ISC License",),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0"),
    **{
        f"{short}-{version}": tuple(
            f"{name}{between}{version.removesuffix('.0')}{end}"
            for name in (f"GNU {long}", f"GNU {short}", short)
            for between in (", version ", " version ", " v", " ")
            for end in ("", ".0")[: 2 if version.endswith(".0") else 1]
        )
        for short, long, versions in (
            ("GPL", "General Public License", ("2.0", "3.0")),
            ("LGPL", "Lesser General Public License", ("2.1", "3.0")),
            ("AGPL", "Affero General Public License", ("3.0",)),
        )
        for version in versions
    },
    **{
        f"CC-{kind}-4.0": (
            f"CC {kind} 4.0", f"CC {kind} 4.0 License", f"Creative Commons {long} 4.0 License",
            f"Creative Commons {long} 4.0 International License",
        )
        for kind, long in (
            ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
            ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
    },
}
#: Words that tell licenses apart; they may neither lack nor be added.
TELLING = frozenset(
    "noncommercial sharealike noderivatives nc sa nd lesser affero library gpl lgpl agpl mpl mit isc bsd apache mozilla boost".split()
)
LEADS = ("under the {}", "under {}", "under a {}", "under the terms of the {}")
BSD_2 = """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met:
        1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer.
        2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
        following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_3 = """
        3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission."""
TEXTS = {
    "BSD-2-Clause": BSD_2,
    "BSD-3-Clause": BSD_2 + BSD_3,
    "MIT": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
        THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
        AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
        CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
        IN THE SOFTWARE.""",
    "ISC": """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
        ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
        DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
        USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Apache-2.0": """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License.""",
    "MPL-2.0": """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "BSL-1.0": """
        Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
        accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute,
        execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties
        to whom the Software is furnished to do so""",
    "GPL-2.0": """
        This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any
        later version.""",
    "LGPL-2.1": """
        This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your
        option) any later version.""",
    "AGPL-3.0": """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
        any later version.""",
    "GPL-3.0": """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version.
        This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for
        more details.""",
}


def words(text: str) -> list[tuple[str, int, int]]:
    """Words in lower case with their places."""
    return [(m[0].lower(), m.start(), m.end()) for m in WORD.finditer(text)]


def wording(template: list[str], block: list[str]) -> Iterator[tuple[int, int, int]]:
    """(differing words, first and last aligned word of the block + 1) of each place that has the template's wording.

    The words on both sides of a place, and of a longest match that is none, are searched again, as long as matches are so
    long that the allowed differences could lie between them.
    """
    most = int(MOST_DIFFERENT * len(template))
    least = -(-(len(template) - most) // (most + 1))
    search = difflib.SequenceMatcher(None, template, block, autojunk=False)
    spans = [(0, len(block))]
    while spans:
        low, high = spans.pop()
        if high - low < len(template) - most:
            continue
        longest = search.find_longest_match(0, len(template), low, high)
        if longest.size < least:
            continue
        slack = len(template) // 10 + 1
        start = max(low, longest.b - longest.a - slack)
        part = block[start : min(high, longest.b + len(template) - longest.a + slack)]
        matches = difflib.SequenceMatcher(None, template, part, autojunk=False).get_matching_blocks()[:-1]
        first, last = matches[0].b, matches[-1].b + matches[-1].size
        covered = {k for match in matches for k in range(match.a, match.a + match.size)}
        missing = [word for k, word in enumerate(template) if k not in covered]
        there = {k for match in matches for k in range(match.b, match.b + match.size)}
        more = [part[k] for k in range(first, last) if k not in there]
        differing = len(missing) + len(more)
        tells = any(any(c.isdigit() for c in word) for word in missing) or not TELLING.isdisjoint([*missing, *more])
        if differing <= most and not tells:
            first, last = start + first, start + last
            yield differing, first, last
        else:
            first, last = longest.b, longest.b + longest.size
        spans += [(low, first), (last, high)]


class Scanner:
    """Templates as dictionaries, ready for many blocks."""

    def __init__(self):
        clean = {name: " ".join(text.split()) for name, text in TEXTS.items()}
        self.plain = zstandard.ZstdCompressor(level=LEVEL)
        notices = [*NOTICES.items()]
        notices += [(name, lead.format(x)) for name, wordings in NAMES.items() for x in wordings for lead in LEADS]
        self.short, self.long = ([self._prepared(*x) for x in kind] for kind in (notices, clean.items()))
        self.reach = max(map(len, clean.values()))
        self.hint = re.compile(HINT)

    def _prepared(self, name: str, text: str):
        known = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=LEVEL)
        size = len(self.plain.compress(text.encode()))
        return name, zstandard.ZstdCompressor(level=LEVEL, dict_data=known), size, [w for w, _, _ in words(text)]

    def blocks(self, text: str) -> Iterator[tuple[int, int, bool]]:
        """(start, end, whether it is for templates of one line) of the blocks to look at."""
        near, around = -1, []
        for hint in self.hint.finditer(text):
            at = hint.start()
            if at >= near:  # else within the last line block
                start = max(text.rfind("\n", 0, at) + 1, at - NOTICE_REACH)
                end = text.find("\n", at)
                end = min(len(text) if end < 0 else end, at + NOTICE_REACH)
                yield start, end, True
                near = max(at + 1, end - NOTICE_REACH // 2)
            start, end = max(0, at - self.reach), min(len(text), at + self.reach)
            if around and start <= around[-1][1]:
                around[-1][1] = end
            else:
                around.append([start, end])
        for start, end in around:
            for part in range(start, max(start + 1, end - self.reach), 2 * self.reach):
                yield part, min(end, part + 3 * self.reach), False

    def ranked(self, block: str, line: bool) -> list[tuple[int, float, str, list[str]]]:
        """(bytes saved, their share of the template, license, its words) of the templates that may be in a block, best first."""
        data = block.encode()
        alone = len(self.plain.compress(data))
        saved = ((alone - len(known.compress(data)), size, name, template) for name, known, size, template in (self.short if line else self.long))
        kept = [(n, n / size, name, template) for n, size, name, template in saved if n >= LEAST_SHARE * size]
        return sorted(kept, key=lambda x: (-x[0], -len(x[3]), x[2]))

    def _winners(self, block: str, line: bool) -> Iterator[tuple[int, int, str, float, int]]:
        """The findings of a block. Every step hands on shorter blocks, and only those with a hint are compressed."""
        rest = [(0, len(block))]
        while rest:
            low, high = rest.pop()
            part = block[low:high]
            if not self.hint.search(part):
                continue
            split = words(part)
            plain = [word for word, _, _ in split]
            for _, share, name, template in self.ranked(part, line):
                places = sorted((first, last, differing) for differing, first, last in wording(template, plain))
                if not places:
                    continue
                at = low
                for first, last, differing in places:
                    start, end = low + split[first][1], low + split[last - 1][2]
                    yield start, end, name, share, differing
                    rest.append((at, start))
                    at = end
                rest.append((at, high))
                break

    @staticmethod
    def tags(text: str) -> Iterator[tuple[int, int, str, float, int]]:
        """The identifiers of SPDX tags; what follows ``WITH`` is an exception and no license."""
        for tag in TAG.finditer(text):
            start, expected, skip = tag.start(), True, False
            for found in IDENTIFIER.finditer(text, tag.start(1), tag.end(1)):
                if found[0] in ("AND", "OR", "WITH"):
                    expected = found[0] != "WITH"
                    skip = not expected
                    continue
                if not expected and not skip:
                    break  # words behind the expression
                if expected:
                    if found[0].upper() not in ("NONE", "NOASSERTION"):
                        yield start, found.end(), found[0], 1.0, 0
                    start = found.end()
                expected = skip = False

    def findings(self, text: str) -> list[tuple[int, int, str, float, int]]:
        """(start, end, license, share of the template saved, differing words) of each finding, by place."""
        found = [(*tag, True) for tag in self.tags(text)]
        for start, end, line in self.blocks(text):
            found += [(start + a, start + b, *rest, False) for a, b, *rest in self._winners(text[start:end], line)]
        # Blocks overlap, and lines lie inside the others: of two findings at a place the longer counts.
        chosen = []
        for start, end, name, share, differing, _ in sorted(found, key=lambda x: (not x[5], x[0] - x[1], x[4], -x[3], x[0])):
            at = bisect.bisect_left(chosen, (start,))
            if (not at or chosen[at - 1][1] <= start) and (at == len(chosen) or end <= chosen[at][0]):
                chosen.insert(at, (start, end, name, share, differing))
        return chosen


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, end, license, share, differences, exact) of each finding; places count code points."""
    kind = df.schema[id_col].dataType.simpleString()

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        names = ["id", "start", "end", "license", "share", "differences", "exact"]
        kinds = [None, pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.bool_()]
        for batch in batches:
            kinds[0] = batch.schema.field(0).type
            rows = [
                (key, start, end, name, share, differing, differing == 0)
                for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                for start, end, name, share, differing in scanner.findings(text)
            ]
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"id {kind}, start bigint, `end` bigint, license string, share double, differences bigint, exact boolean"
    # Texts without any hint don't leave the JVM.
    hinted = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.col("text").rlike(HINT))
    return hinted.mapInArrow(scan, schema).withColumnRenamed("id", id_col)
