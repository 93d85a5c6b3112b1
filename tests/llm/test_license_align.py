"""Alignment against a longest common subsequence, notices at planted places."""

from __future__ import annotations

import random

from opslog.llm import license_align as lic
from tests.llm.common import documents, odd_cases, prose


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for j, y in enumerate(b, 1):
            now.append(row[j - 1] + 1 if x == y else max(row[j], now[-1]))
        row = now
    return row[-1]


def test_alignment_rises_and_matches():
    rnd = random.Random(1)
    for _ in range(400):
        a = [rnd.randint(1, 30) for _ in range(rnd.randint(0, 25))]
        b = [x for x in a if rnd.random() > 0.15] + [rnd.randint(1, 30) for _ in range(3)]
        pairs = lic.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x < y and u < v for (x, u), (y, v) in zip(pairs, pairs[1:]))
        assert len(pairs) <= lcs(a, b)
        whole = lic.align(a, a)
        assert whole == [(i, i) for i in range(len(a))]
    distinct = list(range(1, 40))
    moved = distinct[:10] + distinct[12:30] + [99] + distinct[30:]
    assert len(lic.align(distinct, moved)) == lcs(distinct, moved)


def test_licenses_are_found_where_they_are(spark):
    rnd = random.Random(2)
    texts, want = [], set()
    for i, (key, wording) in enumerate(lic.templates()):
        words = wording.split()
        if len(words) > 30:
            words[rnd.randrange(len(words))] = "changed"
        before = prose(rnd, 6)
        texts.append(f"{before}\n{' '.join(words).upper() if i % 2 else ' '.join(words)}\n{prose(rnd, 6)}")
        want.add((i, key, len(before.split())))
    rows = lic.licenses(documents(spark, texts)).collect()
    got = {(r["doc_id"], r["license"], r["first_word"]) for r in rows}
    assert len(got & want) >= 0.97 * len(want)
    assert len(rows) <= 1.05 * len(want)
    assert all(r["coverage"] == r["matched"] / r["template_words"] >= lic.COVERAGE for r in rows)


def test_several_places_and_clean_texts(spark):
    rnd = random.Random(3)
    notice = "Licensed under the Apache License, Version 2.0."
    texts = [f"{notice} {prose(rnd, 4)} {notice}", prose(rnd, 50), "This work is licensed under CC BY-NC 4.0."]
    rows = lic.licenses(documents(spark, texts)).collect()
    assert sorted((r["doc_id"], r["license"]) for r in rows) == [(0, "Apache-2.0"), (0, "Apache-2.0"), (2, "CC-BY-NC-4.0")]


def test_odd_rows_and_empty_table(spark):
    df = odd_cases(spark)
    assert lic.licenses(df).count() == 0
    assert lic.licenses(df.limit(0)).count() == 0


def test_other_names_and_versions_are_no_match(spark):
    texts = [
        "Licensed under the Foobar License.", "Distributed under the Eclipse License.", "Licensed under CC BY-NC 6.0.",
        "Released under the GNU General Public License, version 1.", "Released under the BSD 4-Clause License.",
        "Licensed under CC BY-NC 2.0.", "Licensed under the Mozilla Public License, Version 2.0.",
    ]
    rows = lic.licenses(documents(spark, texts)).collect()
    assert sorted((r["doc_id"], r["license"]) for r in rows) == [(4, "BSD-4-Clause"), (5, "CC-BY-NC-2.0"), (6, "MPL-2.0")]


def test_places_equal_brute_force():
    """Every window of every length, aligned in full, finds no license that the key words miss."""
    rnd = random.Random(4)
    known = lic.Templates(lic.named_templates())
    notices = [(k, t) for k, (_, t) in enumerate(known.texts) if len(t) <= 10]
    words = {n: w for w, n in known.numbers.items()}
    for _ in range(60):
        k, template = rnd.choice(notices)
        text = [words[w] for w in template]
        for _ in range(rnd.randint(0, 2)):
            text[rnd.randrange(len(text))] = rnd.choice(["other", "the", "3.0"])
        text = prose(rnd, 1).split() + text + prose(rnd, 1).split()
        numbers = [known[w] for w in text]
        want = set()
        for key, t in known.texts:
            j = next(i for i, (_, x) in enumerate(known.texts) if x is t)
            if len(t) > len(text):
                continue
            pairs = lic.align(t, numbers)
            if len(pairs) >= lic.COVERAGE * len(t) and known.required[j] <= {t[p] for p, _ in pairs}:
                want.add(key)
        got = {f[0] for f in known.find(" ".join(text), lic.COVERAGE)}
        assert got <= want
        assert bool(got) == bool(want)
