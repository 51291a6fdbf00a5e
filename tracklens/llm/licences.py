"""Licence scan by a generalised suffix automaton (operator 2).

The automaton holds every run of words of every template. A text's words are streamed
through it; after each word the automaton knows the longest run ending there that some
template has (matching statistics). Maximal runs are chained per template, in order and
with small gaps, into spans, and a span that covers enough of a template carries its label.
A short phrase is a template too: it stands wherever its state is on the suffix path.
"""

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.llm.storage import encoded, text_batches

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # on UTF-8 bytes; upper case is lowered before
LONG = 4          # words of a run that counts for chains
GAP = 12          # words between chained runs, in the text
COVERED = 0.6     # share of a template's words that makes a label
SLICE = 4 << 20   # bytes split at once

# Phrases that are labels wherever they stand.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. ")
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. ")
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")


def _gnu(licence: str, version: str) -> str:
    """The notice that a work under one of the GNU licences carries."""
    return (f"This program is free software: you can redistribute it and/or modify it under the terms of the {licence} as "
            f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
            "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
            "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
            f"{licence} for more details. You should have received a copy of the {licence} along with this program.")


# Wording of public licences and notices, by label.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files (the \"Software\"), to deal in the Software without "
            "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files (the \"Software\"), to deal in the Software without "
            "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
            "is furnished to do so, subject to the following conditions: The above copyright notice and this "
            "permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS),
    ("mit", "Released under the MIT License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                 "except in compliance with the License. You may obtain a copy of the License at"),
    ("apache-2", "Unless required by applicable law or agreed to in writing, software distributed under the License "
                 "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
                 "implied. See the License for the specific language governing permissions and limitations under the License."),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("bsd-2", _BSD + _BSD_END),
    ("bsd-3", _BSD + _BSD_THIRD + _BSD_END),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
            "fee is hereby granted"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
            "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
            "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
            "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
            "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
            "PERFORMANCE OF THIS SOFTWARE."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
             "software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject "
             "to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that "
             "you wrote the original software. If you use this software in a product, an acknowledgment in the product "
             "documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, "
             "and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from "
             "any source distribution."),
    ("bsl-1", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
              "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, "
              "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties "
              "to whom the Software is furnished to do so, all subject to the following"),
    ("gpl-3", "Licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation"),
    ("gpl-2", _gnu("GNU General Public License", "2")),
    ("gpl-3", _gnu("GNU General Public License", "3")),
    ("lgpl-2.1", _gnu("GNU Lesser General Public License", "2.1")),
    ("lgpl-3", _gnu("GNU Lesser General Public License", "3")),
    ("agpl-3", _gnu("GNU Affero General Public License", "3")),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
              "distributed with this file, You can obtain one at"),
    ("epl-2", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
              "which is available at"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                  "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
                  "for any purpose, commercial or non-commercial, and by any means."),
]


def split(text: bytes):
    """Words of a text, slice by slice."""
    at = 0
    while at < len(text):
        end = at + SLICE
        if end < len(text):
            gap = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]").search(text, end)
            end = gap.start() if gap else len(text)
        yield WORD.findall(text[at:end].lower())
        at = end


def words(text: str) -> list[bytes]:
    return [w for part in split(text.encode()) for w in part]


@dataclass
class Automaton:
    """States as parallel lists; state 0 is the empty run."""

    step: list[dict] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    size: list[int] = field(default_factory=lambda: [0])
    ends: list[list] = field(default_factory=lambda: [[]])      # (template, place) of runs' last words
    phrases: list[list] = field(default_factory=lambda: [[]])   # phrases that end where the state's runs do

    def _state(self, size: int, link: int, step: dict) -> int:
        for column, value in ((self.step, step), (self.link, link), (self.size, size), (self.ends, []),
                              (self.phrases, [])):
            column.append(value)
        return len(self.size) - 1

    def _copy(self, state: int, at: int, word: bytes) -> int:
        """Split off the runs of ``state`` that are no longer than those of ``at`` and one word."""
        clone = self._state(self.size[at] + 1, self.link[state], dict(self.step[state]))
        self.link[state] = clone
        while at >= 0 and self.step[at].get(word) == state:
            self.step[at][word] = clone
            at = self.link[at]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        known = self.step[last].get(word)
        if known is not None:
            return known if self.size[known] == self.size[last] + 1 else self._copy(known, last, word)
        new, at = self._state(self.size[last] + 1, 0, {}), last
        while at >= 0 and word not in self.step[at]:
            self.step[at][word] = new
            at = self.link[at]
        if at >= 0:
            known = self.step[at][word]
            self.link[new] = known if self.size[known] == self.size[at] + 1 else self._copy(known, at, word)
        return new

    @classmethod
    def of(cls, templates: list[list[bytes]], phrases: list[list[bytes]]) -> "Automaton":
        self = cls()
        for one in [*templates, *phrases]:
            last = 0
            for word in one:
                last = self._extend(last, word)
        for number, one in enumerate(templates):
            state = 0
            for place, word in enumerate(one):
                state = self.step[state][word]
                self.ends[state].append((number, place))
        for number, one in enumerate(phrases):
            state = 0
            for word in one:
                state = self.step[state][word]
            self.phrases[state].append(number)
        by_size = sorted(range(1, len(self.size)), key=self.size.__getitem__)
        for state in reversed(by_size):          # longer runs end where their suffixes end
            self.ends[self.link[state]] += self.ends[state]
        for state in by_size:                    # and phrases that are suffixes end with them
            self.phrases[state] = self.phrases[self.link[state]] + self.phrases[state]
        return self

    def match(self, state: int, length: int, word: bytes) -> tuple[int, int]:
        """The longest run of the templates that ends with this word, from the one before it."""
        while state and word not in self.step[state]:
            state = self.link[state]
            length = self.size[state]
        after = self.step[state].get(word)
        return (0, 0) if after is None else (after, length + 1)


@dataclass
class Scanner:
    """Templates and phrases made ready for scanning."""

    templates: list[tuple[str, list[bytes]]]
    phrases: list[tuple[str, list[bytes]]]

    def __post_init__(self):
        self.automaton = Automaton.of([w for _, w in self.templates], [w for _, w in self.phrases])
        self.vocabulary = frozenset(self.automaton.step[0])

    def scan(self, text: bytes):
        """Number of words; places of phrases (phrase, start); maximal runs (end, length, state)."""
        auto, known = self.automaton, self.vocabulary
        state = length = n = 0
        found, runs = [], []
        for part in split(text):
            for place, word in enumerate(part, n):
                if word not in known:
                    if length >= LONG:
                        runs.append((place, length, state))
                    state = length = 0
                    continue
                after, more = auto.match(state, length, word)
                if length >= LONG and more <= length:
                    runs.append((place, length, state))
                state, length = after, more
                for phrase in auto.phrases[state]:
                    size = len(self.phrases[phrase][1])
                    if length >= size:
                        found.append((phrase, place - size + 1))
            n += len(part)
        if length >= LONG:
            runs.append((n, length, state))
        return n, found, runs

    def spans(self, runs) -> list[tuple[str, int, int, float]]:
        """Chains of runs per template: label, first word, last word, share of the template covered."""
        per = {}
        for end, length, state in runs:
            for template, place in self.automaton.ends[state]:
                per.setdefault(template, []).append((end - length, end, place + 1 - length, place + 1))
        out = []
        for template, pieces in per.items():
            label, whole = self.templates[template]
            chains = []
            for begin, end, low, high in sorted(pieces):
                best = None
                for chain in chains:
                    gap, order = begin - chain[1], low - chain[3]
                    if -LONG <= gap <= GAP and order >= -LONG and (best is None or chain[2] > best[2]):
                        best = chain
                if best is None:
                    chains.append([begin, end, high - low, high])
                else:
                    best[2] += max(0, high - max(low, best[3]))
                    best[1], best[3] = max(end, best[1]), max(high, best[3])
                chains = [c for c in chains if begin - c[1] <= GAP or not out.append(
                    (label, c[0], c[1] - 1, c[2] / len(whole)))]
            out += [(label, c[0], c[1] - 1, c[2] / len(whole)) for c in chains]
        return self._best(span for span in out if span[3] >= COVERED)

    @staticmethod
    def _best(spans) -> list[tuple[str, int, int, float]]:
        """Spans without those that lie inside one of another label that covers more of its template.

        Licences share much of their wording: a text of one covers most of its relatives too.
        """
        kept, around = [], []
        for span in sorted(spans, key=lambda x: (x[1], -x[2], -x[3])):
            around = [x for x in around if x[2] >= span[1]]
            around.append(span)
            if not any(x[1] <= span[1] and x[2] >= span[2] and x[0] != span[0] and x[3] > span[3] for x in around):
                kept.append(span)
        return sorted(kept)


def scanner(templates=TEMPLATES, phrases=PHRASES) -> Scanner:
    return Scanner([(label, words(text)) for label, text in templates],
                   [(label, words(text)) for text, label in phrases.items()])


def scan(docs: DataFrame, using: Scanner | None = None) -> DataFrame:
    """(doc_id, n_words, phrases, spans) for each row of ``docs`` (doc_id, text).

    Words are those of the pattern ``WORD`` after lowering A-Z; a null text has none.
    ``phrases``: label and first word of each place of a phrase, in order. ``spans``: label,
    first and last word, and share of the template that the span covers. Both are empty where
    nothing is found. Texts are streamed; other columns play no part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(using or scanner())
    phrase = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64())]))
    span = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()),
                               ("covered", pa.float64())]))

    def run(batches):
        own = shared.value
        labels = [label for label, _ in own.phrases]
        for batch in text_batches(batches):
            sizes, found, covered = [], [], []
            for text in encoded(batch):
                n, places, runs = own.scan(text)
                sizes.append(n)
                found.append([{"label": labels[p], "first": at} for p, at in places])
                covered.append([dict(zip(("label", "first", "last", "covered"), x, strict=True))
                                for x in own.spans(runs)] if runs else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(found, phrase),
                 pa.array(covered, span)], ["doc_id", "n_words", "phrases", "spans"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, n_words bigint, phrases array<struct<label:string,first:bigint>>, "
             "spans array<struct<label:string,first:bigint,last:bigint,covered:double>>")
