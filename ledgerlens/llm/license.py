"""Licence scans by sentence rules.

A sentence ends at a line end, or at one of . ! ? ; : before white space or the end
of the text.  Its words (runs of a-z with A-Z folded, 0-9 and characters beyond
ASCII) are its normal form.  Known sentences have identifiers; a rule is a sequence
of identifiers, and rules are tried in order at each known sentence.  Between two
sentences of a rule, ``GAP`` unknown ones may stand (names, years, addresses).

A known sentence may be wrapped over lines: it is also found as a run of sentences
with nothing but a line end between them (and comment markers without words, such as
``#``, ``*``, ``//``, ``;``); the longest run from a sentence counts.  Blank lines and
the punctuation above end a run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ledgerlens.llm import textwords as tw
from ledgerlens.llm.substring import stretch_hashes

GAP = 2

# Sentences of public licences and of common notices.
SENTENCES = {
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-1": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-2": "you may not use this file except in compliance with the License.",
    "apache-3": "You may obtain a copy of the License at",
    "apache-4": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-5": "See the License for the specific language governing permissions and limitations under the License.",
    "mit-notice": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-1": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
             "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
             "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
             "following conditions:",
    "mit-2": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-3": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
             "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-4": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
             "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "bsd-1": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-2": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-3": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
             "documentation and/or other materials provided with the distribution.",
    "bsd-4": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
             "software without specific prior written permission.",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-1": "This program is free software:",
    "gpl3-2": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
              "either version 3 of the License, or (at your option) any later version.",
    "gpl2-2": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;",
    "gpl2-3": "either version 2 of the License, or (at your option) any later version.",
    "ccbync4-notice": "Licensed under CC BY-NC 4.0.",
    "ccby4-notice": "Licensed under CC BY 4.0.",
    "ccbysa4-notice": "Licensed under CC BY-SA 4.0.",
    "gnu-library": "This library is free software;",
    "lgpl21-2": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation;",
    "lgpl21-3": "either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3-2": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, "
               "either version 3 of the License, or (at your option) any later version.",
    "lgpl3-3": "either version 3 of the License, or (at your option) any later version.",
    "agpl3-2": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, "
               "either version 3 of the License, or (at your option) any later version.",
    "mpl2-1": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",  # "2.0." is a sentence of its own; the address tells it
    "mpl2-2": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "mpl2-2-http": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "epl2-1": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
              "https://www.eclipse.org/legal/epl-2.0/",
    "isc-1": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
             "copyright notice and this permission notice appear in all copies.",
    "isc-1-and": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above "
                 "copyright notice and this permission notice appear in all copies.",
    "zlib-1": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-2": "In no event will the authors be held liable for any damages arising from the use of this software.",
    "zlib-3": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
              "subject to the following restrictions:",
    "bsl-notice": "Distributed under the Boost Software License, Version 1.0.",
    "bsl-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "unlicense-1": "This is free and unencumbered software released into the public domain.",
    "unlicense-2": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
                   "for any purpose, commercial or non-commercial, and by any means.",
    "cc0-title": "CC0 1.0 Universal",
    "apache-title": "Apache License Version 2.0, January 2004",
    "gpl2-title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "gpl3-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "lgpl21-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "lgpl3-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "agpl3-title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "mpl2-title": "Mozilla Public License Version 2.0",
    "epl2-title": "Eclipse Public License - v 2.0",
}

# Fixed values: (rule, licence, sentence identifiers), longer rules before the shorter ones they contain.
RULES = [
    ("apache-header", "Apache-2.0", ["apache-1", "apache-2", "apache-3", "apache-4", "apache-5"]),
    ("apache-short-header", "Apache-2.0", ["apache-1", "apache-2"]),
    ("apache-notice", "Apache-2.0", ["apache-notice"]),
    ("mit-text", "MIT", ["mit-1", "mit-2", "mit-3", "mit-4"]),
    ("mit-notice", "MIT", ["mit-notice"]),
    ("mit-licensed", "MIT", ["mit-licensed"]),
    ("bsd-3-clause", "BSD-3-Clause", ["bsd-1", "bsd-2", "bsd-3", "bsd-4"]),
    ("bsd-2-clause", "BSD-2-Clause", ["bsd-1", "bsd-2", "bsd-3"]),
    ("gpl-3-header", "GPL-3.0-or-later", ["gpl-1", "gpl3-2"]),
    ("gpl-2-header", "GPL-2.0-or-later", ["gpl-1", "gpl2-2", "gpl2-3"]),
    ("gpl-3-notice", "GPL-3.0", ["gpl3-notice"]),
    ("cc-by-nc-4", "CC-BY-NC-4.0", ["ccbync4-notice"]),
    ("cc-by-4", "CC-BY-4.0", ["ccby4-notice"]),
    ("cc-by-sa-4", "CC-BY-SA-4.0", ["ccbysa4-notice"]),
    ("lgpl-2.1-header", "LGPL-2.1-or-later", ["gnu-library", "lgpl21-2", "lgpl21-3"]),
    ("lgpl-3-library-header", "LGPL-3.0-or-later", ["gnu-library", "lgpl21-2", "lgpl3-3"]),
    ("lgpl-3-header", "LGPL-3.0-or-later", ["gpl-1", "lgpl3-2"]),
    ("agpl-3-header", "AGPL-3.0-or-later", ["gpl-1", "agpl3-2"]),
    ("mpl-2-header", "MPL-2.0", ["mpl2-1", "mpl2-2"]),
    ("mpl-2-header-http", "MPL-2.0", ["mpl2-1", "mpl2-2-http"]),
    ("epl-2-header", "EPL-2.0", ["epl2-1"]),
    ("isc-text", "ISC", ["isc-1"]),
    ("isc-text-and", "ISC", ["isc-1-and"]),
    ("zlib-text", "Zlib", ["zlib-1", "zlib-2", "zlib-3"]),
    ("bsl-notice", "BSL-1.0", ["bsl-notice"]),
    ("bsl-title", "BSL-1.0", ["bsl-title"]),
    ("unlicense-text", "Unlicense", ["unlicense-1", "unlicense-2"]),
    ("cc0-title", "CC0-1.0", ["cc0-title"]),
    ("apache-title", "Apache-2.0", ["apache-title"]),
    ("gpl-2-title", "GPL-2.0", ["gpl2-title"]),
    ("gpl-3-title", "GPL-3.0", ["gpl3-title"]),
    ("lgpl-2.1-title", "LGPL-2.1", ["lgpl21-title"]),
    ("lgpl-3-title", "LGPL-3.0", ["lgpl3-title"]),
    ("agpl-3-title", "AGPL-3.0", ["agpl3-title"]),
    ("mpl-2-title", "MPL-2.0", ["mpl2-title"]),
    ("epl-2-title", "EPL-2.0", ["epl2-title"]),
]

# The licence names of an SPDX line, as written; what follows WITH is an exception.
_SPDX = re.compile(rb"[ \t]*:[ \t]*(\(*[ \t]*[A-Za-z0-9][\w.+-]*[ \t)]*(?:(?:AND|OR|WITH|and|or|with)[ \t]+\(*[ \t]*[A-Za-z0-9][\w.+-]*[ \t)]*)*)")
_SPDX_NAME = re.compile(rb"(WITH[ \t]+|with[ \t]+)?([A-Za-z0-9][\w.+-]*)")

_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?;:"]] = True

FOUND = ArrayType(StructType([StructField("rule", StringType()), StructField("license", StringType()),
                              StructField("first", IntegerType()), StructField("last", IntegerType())]))
FOUND_ARROW = pa.list_(pa.struct([("rule", pa.string()), ("license", pa.string()), ("first", pa.int32()), ("last", pa.int32())]))


def normal(sentence: str) -> str:
    raw, off = tw.text_bytes(pa.array([sentence]))
    raw = tw.LOWER[raw]
    start, end = tw.find_words(raw, off, tw.ALPHANUMERIC)
    return " ".join(raw[s:e].tobytes().decode() for s, e in zip(start, end, strict=True))


class Sentences:
    """The sentences with words of some texts, hashed."""

    def __init__(self, texts: pa.Array):
        raw, off = tw.text_bytes(texts)
        words = self.words = tw.words_of(texts, tw.ALPHANUMERIC, tw.LOWER)
        blank_next = np.ones(len(raw), bool)
        if len(raw):
            blank_next[:-1] = ~tw.SPACE_SEPARATED[raw[1:]]
            blank_next[off[1:][off[1:] > 0] - 1] = True
        ends = np.flatnonzero((_ENDS[raw] & blank_next) | (raw == 10))
        text, after = words.text_of(), np.searchsorted(ends, words.start)
        opens = np.ones(len(text), bool)
        opens[1:] = (text[1:] != text[:-1]) | (after[1:] != after[:-1])
        self.first = np.flatnonzero(opens)
        self.text = text[self.first]
        self.count = np.bincount(self.text, minlength=len(texts))
        self.bound = np.append(opens, True)  # words that begin a sentence, and the end
        # a run goes on over a single line end after no punctuation
        lines, marks = np.flatnonzero(raw == 10), np.append(np.flatnonzero(_ENDS[raw] & blank_next), len(raw))
        before, here = words.end[self.first[1:] - 1], words.start[self.first[1:]]
        i = np.searchsorted(lines, before)
        single = (self.text[1:] == self.text[:-1]) & (np.searchsorted(lines, here) - i == 1)
        goes_on = np.zeros(len(self.first), bool)
        goes_on[1:][single] = marks[np.searchsorted(marks, before[single])] > lines[i[single]]
        ends = np.append(self.first[~goes_on][1:], len(text))
        self.run_end = ends[np.cumsum(~goes_on) - 1] if len(text) else ends[:0]

    def normal(self, i: int, length: int) -> str:
        """``length`` words from the beginning of sentence ``i``."""
        w, a = self.words, self.first[i]
        return " ".join(w.raw[s:e].tobytes().decode() for s, e in zip(w.start[a:a + length], w.end[a:a + length], strict=True))


def spdx_lines(texts: pa.Array, s: Sentences) -> Iterator[tuple[int, tuple[str, str, int, int]]]:
    """(text, match) for each licence named in a SPDX-License-Identifier line."""
    raw, off = tw.text_bytes(texts)
    w, base = s.words, np.cumsum(s.count) - s.count
    for i in np.flatnonzero(w.hash == tw.words_of(pa.array(["spdx"]), tw.ALPHANUMERIC).hash[0]).tolist():
        t = int(np.searchsorted(w.first, i, "right") - 1)
        if i + 2 >= w.first[t + 1] or w.raw[w.start[i]:w.end[i + 2]].tobytes() != b"spdx-license-identifier":
            continue
        at, end = int(w.end[i + 2]), int(off[t + 1])
        found = _SPDX.match(raw[at:min(end, at + 4096)].tobytes().split(b"\n")[0])
        if found is None:
            continue
        first = int(np.searchsorted(s.first, i, "right") - 1 - base[t])
        for exception, name in _SPDX_NAME.findall(found[1]):
            if not exception and name not in (b"AND", b"OR", b"and", b"or"):
                stop = np.searchsorted(w.start, at + found.end(1), "left") - 1
                yield t, ("spdx", name.decode(errors="replace").rstrip("."), first, int(np.searchsorted(s.first, stop, "right") - 1 - base[t]))


class Scanner:
    def __init__(self, sentences: dict[str, str] = SENTENCES, rules: list[tuple[str, str, list[str]]] = RULES, gap: int = GAP):
        self.names = {normal(s): name for name, s in sentences.items()}
        words = tw.words_of(pa.array(list(self.names), pa.string()), tw.ALPHANUMERIC, tw.LOWER)
        first, length = words.first[:-1], words.counts()
        first, length = first[length > 0], length[length > 0]
        self.openers = np.unique(words.hash[first])
        hashes = stretch_hashes(words.hash, first, length)
        self.known = {int(n): np.unique(hashes[length == n]) for n in np.unique(length)[::-1]}
        self.rules, self.gap = rules, gap

    def match(self, found: list[tuple[int, int, str]]) -> list[tuple[str, str, int, int]]:
        """Rules over (first and last sentence number, identifier) in order; a matched sentence is used once."""
        out, i = [], 0
        while i < len(found):
            for rule, name, wanted in self.rules:
                at = found[i:i + len(wanted)]
                if [n for _, _, n in at] == wanted and all(b[0] - a[1] <= self.gap + 1 for a, b in zip(at, at[1:], strict=False)):
                    out.append((rule, name, at[0][0], at[-1][1]))
                    i += len(wanted)
                    break
            else:
                i += 1
        return out

    def identified(self, s: Sentences) -> list[tuple[int, int, str]]:
        """(first sentence, last sentence, identifier) of the known sentences, longest first where several begin."""
        opening = np.flatnonzero(np.isin(s.words.hash[s.first], self.openers))
        out = []
        for length, known in self.known.items():
            end = s.first[opening] + length
            at = opening[end <= s.run_end[opening]]
            at = at[s.bound[s.first[at] + length]]
            at = at[np.isin(stretch_hashes(s.words.hash, s.first[at], np.full(len(at), length)), known)]
            last = np.searchsorted(s.first, s.first[at] + length) - 1
            out += [(i, -length, j, name) for i, j in zip(at.tolist(), last.tolist(), strict=True)
                    if (name := self.names.get(s.normal(i, length))) is not None]
        kept, free = [], 0
        for i, _, j, name in sorted(out):
            if i >= free:
                kept.append((i, j, name))
                free = j + 1
        return kept

    def scan(self, texts: pa.Array) -> tuple[np.ndarray, list[list[tuple[str, str, int, int]]]]:
        """(sentences of each text, matches of each text)."""
        s = Sentences(texts)
        by_text: dict[int, list[tuple[int, int, str]]] = {}
        base = np.cumsum(s.count) - s.count
        for i, j, name in self.identified(s):
            t = int(s.text[i])
            by_text.setdefault(t, []).append((i - int(base[t]), j - int(base[t]), name))
        out = [self.match(by_text[t]) if t in by_text else [] for t in range(len(texts))]
        for t, match in spdx_lines(texts, s):
            out[t] = sorted([*out[t], match], key=lambda m: m[2])
        return s.count, out


def license_scan(docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules: list[tuple[str, str, list[str]]] = RULES, gap: int = GAP) -> DataFrame:
    """``docs`` with ``n_sentences`` and ``matches``: rule, license, first and last sentence
    (numbered from 0 among those with words) of each match in the whole text.

    Null, empty and wordless texts have no sentences.  All rows and other columns stay;
    input columns of those names are replaced."""
    keep = docs.drop("n_sentences", "matches")
    schema = StructType([*keep.schema.fields, StructField("n_sentences", LongType()), StructField("matches", FOUND)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(sentences, rules, gap)
        for batch in tw.small_batches(batches, "text"):
            count, found = scanner.scan(batch.column("text"))
            rows = [[dict(zip(("rule", "license", "first", "last"), m, strict=True)) for m in ms] for ms in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(count, pa.int64()), pa.array(rows, FOUND_ARROW)], [*batch.schema.names, "n_sentences", "matches"])

    return keep.mapInArrow(run, schema)
