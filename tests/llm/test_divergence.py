import random
import re
from collections import Counter, defaultdict

import pyarrow as pa

from opslog.llm import divergence as dv
from tests.conftest import rows
from tests.llm.common import SCHEMA, odd_cases, prose

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs):
    """The contract in whole numbers, over every kept term of every pair."""
    groups, df = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        terms = TERM.findall((text or "").translate(LOWER))
        groups[lang or "", source or ""].update(terms)
        df[lang or ""].update(set(terms))
    out = []
    for lang in df:
        kept = [t for t, n in df[lang].items() if n >= 3]
        mine = {s: {t: c[t] for t in kept} for (g, s), c in groups.items() if g == lang}
        whole = {t: sum(c[t] for c in mine.values()) for t in kept}

        def shares(c):
            total = sum(c.values()) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        p, q = {s: shares(c) for s, c in mine.items()}, shares(whole)
        for s in mine:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in mine if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if mine[s][t] and p[s][t] > q[t]]
            for part, found, top in (("pair", pairs, None), ("term", terms, dv.TOP_TERMS)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(found[:top])]
    return sorted(out, key=str)


def table(spark, docs):
    return spark.createDataFrame([(i, t, lang, s, 0) for i, (t, lang, s) in enumerate(docs)], SCHEMA)


def test_equals_all_pairs_of_all_terms(spark):
    rnd = random.Random(5)
    docs = [(prose(rnd, rnd.randint(0, 6)), rnd.choice(["en", "de", None]), rnd.choice(["a", "b", "c", "", None])) for _ in range(120)]
    docs += [docs[0]] * 40 + [("Öl öl ÖL Straße", "de", "a")] * 3 + [(None, "fr", "x"), ("", "fr", "y"), ("once", "xx", "z")]
    assert rows(dv.divergence(table(spark, docs))) == plain(docs)


def test_odd_rows_and_the_empty_table(spark):
    df = odd_cases(spark)
    docs = [(r["text"], r["lang"], r["source"]) for r in df.collect()]
    assert rows(dv.divergence(df)) == plain(docs)
    assert dv.divergence(df.limit(0)).count() == 0


def test_copies_are_tokenized_once_and_count_as_often_as_they_occur(spark, monkeypatch):
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 5, "source": list("aabba"), "text": ["x y"] * 5})
    (merged,) = dv._merge_copies(iter([batch]))
    assert sorted(merged.to_pydict()["copies"]) == [2, 3]
    calls = []
    own = dv.terms_of
    monkeypatch.setattr(dv, "terms_of", lambda text: calls.append(text) or own(text))
    part = dv._Slice()
    part.add("en", "x y x", [{"source": "a", "copies": 3}, {"source": "b", "copies": 2}])
    (out,) = part.counts()
    found = {(r["source"], r["term"]): (r["n"], r["docs"]) for r in out.to_pylist()}
    assert found == {("a", "x"): (6, 3), ("a", "y"): (3, 3), ("b", "x"): (4, 2), ("b", "y"): (2, 2)}
    assert calls == ["x y x"]


def test_long_texts_in_pieces_and_counts_in_blocks(monkeypatch):
    monkeypatch.setattr(dv, "PIECE", 7)
    monkeypatch.setattr(dv, "BLOCK", 5)
    text = "One two, three-four one; Überlänge TWO " * 9
    assert [t.decode() for p in dv.terms_of(text) for t in p] == TERM.findall(text.translate(LOWER))
    part = dv._Slice()
    for source in "abc":
        part.add("en", text, [{"source": source, "copies": 1}, {"source": "d", "copies": 2}])
    total = Counter()
    for b in part.counts():
        for r in b.to_pylist():
            total[r["source"], r["term"]] += r["n"]
    want = Counter(TERM.findall(text.translate(LOWER)))
    assert total == {(s, t): n * (6 if s == "d" else 1) for s in "abcd" for t, n in want.items()}


def test_long_lists_of_groups_are_joined_by_a_shuffle(spark, monkeypatch):
    docs = [("x y z", "en", f"s{i % 7}") for i in range(30)]
    want = rows(dv.divergence(table(spark, docs)))
    monkeypatch.setattr(dv, "LOOKUP_ROWS", 2)
    assert rows(dv.divergence(table(spark, docs))) == want == plain(docs)
