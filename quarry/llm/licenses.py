"""License notices by conditional compression.

Candidates are the words of a text near a trigger word, across line breaks and
comment marks. For each template they are cut into blocks, each twice as long as its
longest span and overlapping the next by half, so that a notice lies whole in one. Each
block is compressed alone and with the template as a raw zstandard dictionary; if the
bytes taken off are ``REDUCTION`` of what the template costs alone, the template is an
option for the block. Options are taken by the bytes taken off, the most first, and
confirmed by the exact wording: the template must fit a span in or next to the block that holds a
trigger, with few differences (a word missing, added or replaced is one, and words
before the first and after the last fitting one do not count), and the span must not
overlap a notice confirmed before. Words are compared in
lower case without the marks around them, and the missing and added ones are
reported. What tells licenses apart must agree exactly: a span is no notice of a
license if it lacks one of the template's identifying words (its name, its version,
the third BSD clause) or adds one that names another license or denies it, nor if
the sentence denies it in the four words before the span.

Cases: a null or empty text, or one without a trigger word, gives no row; several
notices of a text give a row each, also on one line; very long lines are compared
in full; repeated rows give their rows again; a null id is kept; ties go to
the template that comes first; extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import deque
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
MIT_REST = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_REST = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
#: Notices as they are commonly worded (fixed values).
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy",
        MIT_GRANT,
        MIT_GRANT + " " + MIT_REST,
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        BSD_GRANT + " " + BSD_THIRD,
        BSD_GRANT + " " + BSD_THIRD + " " + BSD_REST,
    ),
    "BSD-2-Clause": (
        "Released under the BSD 2-Clause License.",
        BSD_GRANT,
        BSD_GRANT + " " + BSD_REST,
    ),
    "BSD": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "LGPL-2.1": ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",),
    "LGPL-3.0": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "AGPL-3.0": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "Apache-1.1": ("Licensed under the Apache License, Version 1.1.", "The Apache Software License, Version 1.1"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-3.0": ("Licensed under CC BY 3.0.", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
    "CC0-1.0": ("Released under CC0 1.0.", "Licensed under CC0 1.0 Universal."),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
}
#: Identifiers of the SPDX line, each with the license that it means (fixed values).
IDENTIFIERS = {
    "BSD-3-Clause": "BSD-3-Clause", "BSD-2-Clause": "BSD-2-Clause", "ISC": "ISC", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0",
    "CC-BY-4.0": "CC-BY-4.0", "CC-BY-3.0": "CC-BY-3.0", "CC-BY-SA-4.0": "CC-BY-SA-4.0", "CC-BY-NC-4.0": "CC-BY-NC-4.0", "Apache-1.1": "Apache-1.1",
    "GPL-2.0-only": "GPL-2.0", "GPL-2.0-or-later": "GPL-2.0", "GPL-3.0-only": "GPL-3.0", "LGPL-2.1-only": "LGPL-2.1", "LGPL-2.1-or-later": "LGPL-2.1",
    "LGPL-3.0-only": "LGPL-3.0", "LGPL-3.0-or-later": "LGPL-3.0", "AGPL-3.0-only": "AGPL-3.0", "AGPL-3.0-or-later": "AGPL-3.0",
}
for _identifier, _license in IDENTIFIERS.items():
    TEMPLATES[_license] += (f"SPDX-License-Identifier: {_identifier}",)
#: Words that name a license: a template's must be in the notice.
NAMES = {
    "MIT": {"mit"},
    "Apache-2.0": {"apache"},
    "Apache-1.1": {"apache"},
    "GPL-3.0": {"gnu"},
    "GPL-2.0": {"gnu"},
    "LGPL-2.1": {"gnu", "lesser"},
    "LGPL-3.0": {"gnu", "lesser"},
    "AGPL-3.0": {"gnu", "affero"},
    "CC-BY-NC-4.0": {"by-nc", "attribution-noncommercial"},
    "CC-BY-SA-4.0": {"by-sa", "attribution-sharealike"},
    "CC-BY-4.0": {"by", "attribution"},
    "CC-BY-3.0": {"by", "attribution"},
    "BSD-3-Clause": {"bsd", "neither", "endorse"},
    "BSD-2-Clause": {"bsd"},
    "ISC": {"isc"},
    "MPL-2.0": {"mozilla"},
}
#: Words that a notice cannot have beyond its template's: they deny it or name another license.
CONTRARY = {
    "not", "never", "neither", "lesser", "library", "affero", "gnu", "apache", "mozilla", "mit", "bsd", "isc", "unlicense",
    "by-nc", "by-sa", "by-nd", "by-nc-sa", "by-nc-nd", "noncommercial", "sharealike", "noderivatives",
    "attribution-noncommercial", "attribution-sharealike", "attribution-noderivatives", "attribution-noncommercial-sharealike",
}
DENIED = re.compile(r"(?i)\b(?:not|never|neither|nor)\b|n['\u2019]t\b")
#: Ends of a sentence or a paragraph.
STOP = re.compile(r"[.!?;:](?=\s)|\n\W*\n")
WORD = r"[^\W_]+(?:[-.'/][^\W_]+)*"
TRIGGER_WORD = "licen[cs]|permission|copyright|redistribut|spdx|cc0"
#: Texts that can hold a trigger; "free software" are two words.
TRIGGER = rf"(?i){TRIGGER_WORD}|free[\W_]+software"
#: Bytes that a template must take off a block, as a share of its own compressed bytes.
REDUCTION = 0.3
#: Most differing words, as a share of the template's words.
DIFFERENT = 0.2
#: Lower levels store few literals raw, which blurs the sizes of short blocks.
LEVEL = 12


def wording(text: str) -> list[str]:
    return [w.lower() for w in re.findall(WORD, text)]


def spans(text: str, reach: int):
    """Runs of words at most ``reach`` words from a trigger: the words, where each
    starts in the text, and the triggers' places in the run."""
    trigger = re.compile(TRIGGER_WORD)
    before: deque[tuple[str, int]] = deque(maxlen=reach)  # words not in a run yet
    run: list[tuple[str, int]] = []
    hits: list[int] = []
    last = ""
    for m in re.finditer(WORD, text):
        word = m[0].lower()
        if trigger.search(word) or (word.startswith("software") and last.endswith("free")):
            run += before
            before.clear()
            hits.append(len(run))
            run.append((word, m.start()))
        elif run and len(run) <= hits[-1] + reach:
            run.append((word, m.start()))
        else:
            if run and len(before) == reach:  # the next trigger's run cannot touch this one
                yield [w for w, _ in run], [a for _, a in run], hits
                run, hits = [], []
            before.append((word, m.start()))
        last = word
    if run:
        yield [w for w, _ in run], [a for _, a in run], hits


class Template:
    def __init__(self, license: str, text: str):
        self.license, self.words = license, wording(text)
        self.distinct = set(self.words)
        # numbers are versions, but for those of a list's items
        self.names = self.distinct & NAMES.get(license, set()) | {w for w in self.distinct if re.search(r"\d", w) and not ("redistributions" in self.distinct and w.isdigit())}
        self.most = int(DIFFERENT * len(self.words))
        data = zstandard.ZstdCompressionDict(" ".join(self.words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, dict_data=data)
        self.cost = len(zstandard.ZstdCompressor(level=LEVEL, write_content_size=False).compress(" ".join(self.words).encode()))
        self.places, self.reversed = _places(self.words), _places(self.words[::-1])

    @property
    def longest(self) -> int:
        """Words of the longest span that the template can fit."""
        return len(self.words) + self.most

    def found(self, words: list[str]):
        """(differences, first, end) of the spans of ``words`` that the template fits."""
        if len(self.distinct & set(words)) < len(self.distinct) - self.most:  # each difference loses one at most
            return
        size = len(self.words)
        apart = _differences(self.places, size, words, False)
        for j, d in enumerate(apart):
            # the first of equal smallest ones, so that the span ends with a fitting word
            if d > self.most or (j and apart[j - 1] <= d):
                continue
            if next((x for x in apart[j + 1 : j + size] if x != d), size) < d:
                continue
            back = _differences(self.reversed, size, words[max(0, j + 1 - self.longest) : j + 1][::-1], True)
            yield d, j - back.index(d), j + 1


def _places(words: list[str]) -> dict[str, int]:
    places: dict[str, int] = {}
    for i, w in enumerate(words):
        places[w] = places.get(w, 0) | 1 << i
    return places


def _differences(places: dict[str, int], size: int, words: list[str], whole: bool) -> list[int]:
    """For each word, the fewest differences of the template (``size`` words at
    ``places``) from any span that ends there, or from ``whole`` the words so far
    (Myers' bit vectors)."""
    every, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score, out = every, 0, size, []
    for w in words:
        eq = places.get(w, 0)
        x = eq | down
        y = (((eq & up) + up) ^ up) | eq
        more, less = down | (every & ~(y | up)), up & y
        score += bool(more & top) - bool(less & top)
        more, less = (more << 1 | whole) & every, (less << 1) & every
        up, down = less | (every & ~(x | more)), more & x
        out.append(score)
    return out


def changes(wanted: list[str], words: list[str]) -> tuple[list[str], list[str]]:
    """The words missing and added in an alignment with the fewest differences."""
    cost = [list(range(len(words) + 1))]
    for i, a in enumerate(wanted):
        row = [i + 1]
        for j, b in enumerate(words):
            row.append(min(cost[i][j] + (a != b), cost[i][j + 1] + 1, row[j] + 1))
        cost.append(row)
    missing, added, i, j = [], [], len(wanted), len(words)
    while i or j:
        if i and j and cost[i][j] == cost[i - 1][j - 1] + (wanted[i - 1] != words[j - 1]):
            i, j = i - 1, j - 1
            if wanted[i] != words[j]:
                missing.append(wanted[i])
                added.append(words[j])
        elif i and cost[i][j] == cost[i - 1][j] + 1:
            i -= 1
            missing.append(wanted[i])
        else:
            j -= 1
            added.append(words[j])
    return missing[::-1], added[::-1]


def _denied(text: str, start: int) -> bool:
    """Whether the sentence denies what follows at ``start`` within four words."""
    before = STOP.split(text[max(0, start - 80) : start])[-1]
    return bool(DENIED.search(" ".join(before.split()[-4:])))


class Matcher:
    def __init__(self, templates: dict[str, tuple[str, ...]]):
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.known = [Template(name, t) for name, texts in templates.items() for t in texts]
        self.reach = max((t.longest for t in self.known), default=0)

    def notices(self, text: str) -> list[dict]:
        """The notices of a text, in order; ``block`` is the line where one starts."""
        out, line, at = [], 0, 0
        for words, starts, hits in spans(text, self.reach):
            for one in self._of(words, hits):
                start = starts[one.pop("first")]
                if _denied(text, start):
                    continue
                line, at = line + text.count("\n", at, start), start
                out.append(one | {"block": line})
        return out

    def ranked(self, words: list[str], hits: list[int]) -> list[tuple[int, int, int, int]]:
        """(-bytes taken off, template, first, end) of the blocks that hold a hit and
        that a template makes smaller, the most first."""
        ends = list(accumulate(len(w.encode()) + 1 for w in words))
        data = " ".join(words).encode()
        options, alone = [], {}
        for i, t in enumerate(self.known):
            step = t.longest
            # a hit lies in the block of its own step and in the one before
            for k in sorted({k for hit in hits for k in (hit // step, hit // step - 1)}):
                a, b = max(k * step, 0), min((k + 2) * step, len(words))
                block = data[ends[a - 1] if a else 0 : ends[b - 1] - 1]
                if (a, b) not in alone:
                    alone[a, b] = len(self.plain.compress(block))
                off = alone[a, b] - len(t.packer.compress(block))
                if off >= REDUCTION * t.cost:
                    options.append((-off, i, a, b))
        return sorted(options)

    def _of(self, words: list[str], hits: list[int]) -> list[dict]:
        taken, out = bytearray(len(words)), []
        for _, i, low, high in self.ranked(words, hits):
            t = self.known[i]
            low, high = max(low - t.longest, 0), high + t.longest  # a notice that the block cuts, whole
            for apart, a, b in sorted(t.found(words[low:high])):
                a, b = low + a, low + b
                k = bisect_left(hits, a)
                if k == len(hits) or hits[k] >= b or any(taken[a:b]) or not t.names <= set(words[a:b]):
                    continue
                missing, added = changes(t.words, words[a:b]) if apart else ([], [])
                if t.names & set(missing) or CONTRARY & set(added):
                    continue
                taken[a:b] = b"\1" * (b - a)
                data = " ".join(words[a:b]).encode()
                alone = len(self.plain.compress(data))
                off = alone - len(t.packer.compress(data))
                out.append({"first": a, "license": t.license, "reduction": off / alone, "missing": missing, "added": added})
        return sorted(out, key=lambda x: x["first"])


def notices(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Per notice: ``doc_id``, the line ``block`` (from 0) where it starts, its
    ``license``, ``reduction`` (the share of its compressed bytes that the template
    takes off) and the words ``missing`` and ``added``."""
    templates = templates or TEMPLATES

    def run(batches):
        matcher = Matcher(templates)
        for batch in batches:
            ids, found = [], []
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                own = matcher.notices(text)
                ids += [i] * len(own)
                found += own
            column = lambda c, t: pa.array([x[c] for x in found], t)
            words = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), column("block", pa.int32()), column("license", pa.string()), column("reduction", pa.float64()), column("missing", words), column("added", words)],
                ["doc_id", "block", "license", "reduction", "missing", "added"],
            )

    schema = "doc_id long, block int, license string, reduction double, missing array<string>, added array<string>"
    return docs.select(F.col("doc_id").cast("long"), "text").where(F.col("text").rlike(TRIGGER)).mapInArrow(run, schema)
