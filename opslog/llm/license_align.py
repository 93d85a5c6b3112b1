"""License texts and notices in documents by patience alignment.

Words that occur once in a template and once in a stretch of text are anchors; the longest
increasing subsequence of their places aligns the two, and the gaps between anchors are aligned
the same way, where further words have become unique.  Coverage is the share of the template's words
that find their place, and the words that name a license and its version must be among them.  Stretches
are found by the template's own key words, anywhere in the text: as many as the coverage cannot spare, within
1.3 times the template's length and a few words.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import CACHE_WORDS, strings

COVERAGE = 0.8
SLACK = 8
EDGE = "\"'`.,;:!?()[]{}<>*#$|~_/\\=«»“”„-&%"

# The wording of public licenses and of the notices that name them.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS
IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
MIT_END = """IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN
ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""
ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT,
OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_NAMES = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""
UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at"""
GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by
the Free Software Foundation, either version {version} of the License, or (at your option) any later version."""
GNU_NAMES = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License", "AGPL": "GNU Affero General Public License"}
GNU_VERSIONS = {"GPL": ("2", "3"), "LGPL": ("2.1", "3"), "AGPL": ("3",)}
CC_KINDS = ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
# How the whole license texts open, where they are too long to be kept here.
GNU_HEAD = """{name} Version {version}, {date} Everyone is permitted to copy and distribute verbatim copies of this license
document, but changing it is not allowed."""
GNU_DATES = {"GPL-2": "June 1991", "GPL-3": "29 June 2007", "LGPL-2.1": "February 1999", "LGPL-3": "29 June 2007", "AGPL-3": "19 November 2007"}
APACHE_HEAD = """Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE,
REPRODUCTION, AND DISTRIBUTION"""
MPL_HEAD = """Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each individual or legal entity that
creates, contributes to the creation of, or owns Covered Software."""
EPL_HEAD = """Eclipse Public License - v {version} THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC
LICENSE ("AGREEMENT"). ANY USE, REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS
AGREEMENT."""
# Words of a name that say nothing about which license it is.
PLAIN = "the a license version public international".split()
VERBS = ("Licensed under", "Released under", "Distributed under", "This work is licensed under")


def named_templates() -> list[tuple[str, str, str]]:
    """(license, wording, name that must be matched) of all templates; notices are built from names by rule."""
    out = [("MIT", MIT, ""), ("MIT", f"{MIT} {MIT_END}", ""), ("ISC", ISC, ""), ("ISC", f"{ISC} {ISC_END}", "")]
    out += [("BSD-2-Clause", BSD, ""), ("BSD-3-Clause", f"{BSD} {BSD_NAMES}", "")]
    out += [("BSD-2-Clause", f"{BSD} {BSD_END}", ""), ("BSD-3-Clause", f"{BSD} {BSD_NAMES} {BSD_END}", "")]
    out += [("Unlicense", UNLICENSE, ""), ("MPL-2.0", MPL_HEAD, "Mozilla 2.0"), ("Apache-2.0", APACHE, "Apache 2.0")]
    out.append(("Apache-2.0", APACHE_HEAD, "Apache 2.0"))
    named = {"MIT": ["the MIT License"], "ISC": ["the ISC License"], "Apache-2.0": ["the Apache License, Version 2.0"]}
    named |= {f"BSD-{n}-Clause": [f"the BSD {n}-Clause License"] for n in (2, 3, 4)}
    named |= {"MPL-2.0": ["the Mozilla Public License, Version 2.0"], "Unlicense": ["the Unlicense"], "CC0-1.0": ["CC0 1.0"]}
    for version in ("1.0", "2.0"):
        out.append((f"EPL-{version}", EPL_HEAD.format(version=version), f"Eclipse {version}"))
        named[f"EPL-{version}"] = [f"the Eclipse Public License, Version {version}"]
    for short, name in GNU_NAMES.items():
        for version in GNU_VERSIONS[short]:
            key = f"{short}-{version}"
            out.append((key, GNU.format(name=name, version=version), f"{name} {version}"))
            out.append((key, GNU_HEAD.format(name=name, version=version, date=GNU_DATES[key]), f"{name} {version}"))
            named[key] = [f"the {name}, version {version}"]
    for kind in CC_KINDS:
        for version in CC_VERSIONS:
            named[f"CC-{kind}-{version}"] = [f"CC {kind} {version}", f"a Creative Commons {kind} {version} International License"]
    return out + [(key, f"{verb} {name}.", name) for key, names in named.items() for name in names for verb in VERBS]


def templates() -> list[tuple[str, str]]:
    """(license, wording) of all templates."""
    return [(key, wording) for key, wording, _ in named_templates()]


def normal(word: str) -> str:
    return word.lower().strip(EDGE)


def _longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs that rises in both places; ``pairs`` come in order of the first."""
    tails: list[int] = []
    held: list[int] = []
    back: list[int] = []
    for k, (_, b) in enumerate(pairs):
        at = bisect_left(tails, b)
        back.append(held[at - 1] if at else -1)
        if at == len(tails):
            tails.append(b)
            held.append(k)
        else:
            tails[at], held[at] = b, k
    out, k = [], held[-1] if held else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Patience alignment of two word lists (0 matches nothing): pairs of places, rising in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0] != 0:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1] != 0:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_a, once_b = _once(a, a0, a1), _once(b, b0, b1)
        anchors = _longest_increasing([(i, once_b[w]) for w, i in once_a.items() if w in once_b])
        last = (a0, b0)
        for i, j in anchors:
            out.append((i, j))
            todo.append((last[0], i, last[1], j))
            last = (i + 1, j + 1)
        if anchors:
            todo.append((last[0], a1, last[1], b1))
    return sorted(out)


def _once(words: list[int], lo: int, hi: int) -> dict[int, int]:
    """Words that occur once in a range, with their place, in order of places."""
    seen: dict[int, int] = {}
    for i in range(lo, hi):
        seen[words[i]] = -1 if words[i] in seen else i
    return {w: i for w, i in seen.items() if i >= 0 and w}


class Templates(dict):
    """Raw word to number; words of no template are 0.

    A template is (license, wording) or (license, wording, name); the telling words of its name must be matched.
    """

    def __init__(self, texts: list[tuple[str, ...]]):
        super().__init__()
        self.numbers: dict[str, int] = {}
        self.texts = [(t[0], [self.number(w) for w in t[1].split() if normal(w)]) for t in texts]
        names = [{normal(w) for w in t[2].split()} - set(PLAIN) if len(t) > 2 else set() for t in texts]
        self.required = [{self.number(w) for w in name} for name in names]
        words = {n: w for w, n in self.numbers.items()}
        common = set("the of and or to in is a an any for with that this be by as at it you may not its are on from all".split())
        self.keys = [{w for w in t if words[w] not in common} | must for (_, t), must in zip(self.texts, self.required)]
        self.owners: dict[int, list[int]] = {}
        for k, keys in enumerate(self.keys):
            for w in keys:
                self.owners.setdefault(w, []).append(k)
        self.is_key = np.zeros(len(self.numbers) + 1, bool)
        self.is_key[list(self.owners)] = True

    def number(self, word: str) -> int:
        return self.numbers.setdefault(normal(word), len(self.numbers) + 1)

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = self.numbers.get(normal(word), 0)
        return value

    def find(self, text: str | None, coverage: float) -> list[tuple[str, int, int, int, int]]:
        """(license, matched words, template words, first word, word after the last), best ones, apart from each other."""
        words = text.split() if text else []
        numbers = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        hits = np.flatnonzero(self.is_key[numbers])
        if not len(hits):
            return []
        places_of: dict[int, list[int]] = {}
        for at in hits.tolist():
            places_of.setdefault(int(numbers[at]), []).append(at)
        likely = {k for w in places_of for k in self.owners[w] if all(r in places_of for r in self.required[k])}
        found = []
        for k in sorted(likely):
            keys, must, (key, template) = self.keys[k], self.required[k], self.texts[k]
            # Every key word that is missing costs a word of the coverage.
            need = max(1, len(keys) - (len(template) - ceil(coverage * len(template) - 1e-9)))
            if sum(w in places_of for w in keys) < need:
                continue
            places = sorted(p for w in keys for p in places_of.get(w, ()))
            reach = int(1.3 * len(template)) + SLACK
            i = 0
            while i < len(places):
                near = {int(numbers[p]) for p in places[i : bisect_left(places, places[i] + reach)]}
                if len(near) < need or not must <= near:
                    i += 1
                    continue
                lo, hi = max(0, places[i] - SLACK), min(len(words), places[i] + reach)
                pairs = align(template, numbers[lo:hi].tolist())
                if len(pairs) >= coverage * len(template) and must <= {template[p] for p, _ in pairs}:
                    first, end = lo + pairs[0][1], lo + pairs[-1][1] + 1
                    found.append((len(pairs) / len(template), len(pairs), key, len(template), first, end))
                    i = bisect_left(places, end)
                else:
                    i += 1
        out: list[tuple[str, int, int, int, int]] = []
        for _, matched, key, size, first, end in sorted(found, key=lambda f: (-f[1] * f[0], f[2], f[4])):
            if all(end <= o[3] or first >= o[4] for o in out):
                out.append((key, matched, size, first, end))
        return sorted(out, key=lambda o: o[3])


RESULT = "doc_id bigint, license string, matched int, template_words int, coverage double, first_word int, end_word int"


def _scan(texts: list[tuple[str, ...]], coverage: float):
    def run(batches):
        known = Templates(texts)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), strings(batch, "text")):
                rows += [(doc, k, m, n, m / n, a, b) for k, m, n, a, b in known.find(text, coverage)]
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32()]
            names = [c.split()[0] for c in RESULT.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

    return run


def licenses(documents: DataFrame, texts: list[tuple[str, ...]] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """Licenses and notices in documents, a row for each place.

    Where stretches of several templates overlap, the one with most words at the best coverage
    counts (ties: by name, then place).  Null and empty texts have no rows; repeated rows are
    scanned each; further columns are not read.
    """
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_scan(texts or named_templates(), coverage), RESULT)
