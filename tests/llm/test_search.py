"""Block-max WAND against the score of every document."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np

from opslog.llm import search
from opslog.llm.common import WordHash
from tests.llm.common import documents, odd_cases, prose


def brute(texts, asked, k, terms):
    words = WordHash()
    bags = [Counter(search.terms_of(t, words).tolist()) for t in texts]
    df = Counter(t for b in bags for t in b)
    n, average = len(texts), sum(sum(b.values()) for b in bags) / len(texts)
    out = {}
    for q in asked:
        rated = []
        for t, tf in bags[q].items():
            if df[t] > 1:
                idf = math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5))
                rated.append((-idf * tf / (tf + search.K1), int(np.uint64(t).astype(np.int64)), t, idf))
        chosen = sorted(rated)[:terms]
        scored = []
        for d, b in enumerate(bags):
            size = sum(b.values())
            parts = [w * b[t] * (search.K1 + 1) / (b[t] + search.K1 * (1 - search.B + search.B * size / average)) for _, _, t, w in chosen if b[t]]
            if parts:
                scored.append((-sum(parts), d))
        out[q] = [(d, -s) for s, d in sorted(scored, key=lambda x: (round(x[0], 9), x[1]))[:k]]
    return out


def test_equals_all_scores(spark):
    rnd = random.Random(3)
    texts = [prose(rnd, rnd.randint(1, 12)) for _ in range(300)]
    texts += texts[:20] + ["", None]
    df = documents(spark, texts)
    asked = [0, 5, 100, 200, 305, 320]
    queries = df.filter(df.doc_id.isin(asked)).selectExpr("doc_id AS query_id", "text")
    got = {}
    for r in search.search(df, queries, k=7, terms=6, segment_words=900).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["doc_id"], r["score"]))
    want = {q: v for q, v in brute(texts, asked, 7, 6).items() if v}
    assert set(got) == set(want)
    for q, rows in want.items():
        assert [round(s, 6) for _, s in got[q]] == [round(s, 6) for _, s in rows]
        assert [d for d, _ in got[q]] == [d for d, _ in rows]


def test_pruning_is_exact_in_one_segment():
    rnd = np.random.default_rng(3)
    for _ in range(25):
        n = int(rnd.integers(1, 700))
        texts = [rnd.zipf(1.3, rnd.integers(0, 60)).astype(np.uint64) % np.uint64(50) for _ in range(n)]
        ids = rnd.permutation(n * 3)[:n].tolist()
        segment = search.Segment(search._segment(ids, texts), float(np.mean([len(t) for t in texts])))
        terms = [(int(t), float(w)) for t, w in zip(sorted(rnd.choice(52, 6, replace=False)), rnd.random(6) * 3)]
        got = sorted(segment.best(terms, 10), key=lambda x: (-x[0], x[1]))
        want = []
        for i, t in zip(ids, texts):
            parts = [w * segment.part(np.int32((t == term).sum()), np.int32(len(t))) for term, w in terms if (t == term).any()]
            if parts:
                want.append((float(sum(parts)), i))
        want = sorted(want, key=lambda x: (-x[0], x[1]))[:10]
        assert [i for _, i in got] == [i for _, i in want]


def test_odd_rows_and_empty_tables(spark):
    df = odd_cases(spark)
    queries = df.selectExpr("doc_id AS query_id", "text")
    got = search.search(df, queries).collect()
    # "a b c" is there three times, under the ids 4, 5 and 5.
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 4] == [4, 5, 5]
    assert search.search(df.limit(0), queries).count() == 0
    assert search.search(df, queries.limit(0)).count() == 0


def whole(texts, query, k):
    """BM25 of every document for all words of a text."""
    words = WordHash()
    bags = [Counter(search.terms_of(t, words).tolist()) for t in texts]
    df = Counter(t for b in bags for t in b)
    n, average = len(texts), sum(sum(b.values()) for b in bags) / len(texts)
    scored = []
    for d, b in enumerate(bags):
        size = sum(b.values())
        parts = [
            math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * b[t] * (search.K1 + 1) / (b[t] + search.K1 * (1 - search.B + search.B * size / average))
            for t in set(search.terms_of(query, words).tolist()) if b[t]
        ]
        if parts:
            scored.append((-sum(parts), d))
    return [(d, -s) for s, d in sorted(scored, key=lambda x: (round(x[0], 9), x[1]))[:k]]


def test_all_words_of_a_text_are_its_query(spark):
    rnd = random.Random(8)
    texts = [prose(rnd, rnd.choice([1, 2, 8, 60])) for _ in range(250)]
    texts[7] += " onlyhere"
    texts += texts[:15] + ["", None]
    asked = {1000: texts[3], 1001: texts[40], 1002: "unheard onlyhere unknown", 1003: "nothing known", 1004: texts[11] + " " + texts[12], 1005: prose(rnd, 200)}
    queries = spark.createDataFrame(list(asked.items()), "query_id bigint, text string")
    got = {}
    for r in search.search(documents(spark, texts), queries, segment_words=1500).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["doc_id"], r["score"]))
    assert got[1002][0][0] == 7
    assert 1003 not in got
    for q, rows in got.items():
        want = whole(texts, asked[q], 10)
        assert [d for d, _ in rows] == [d for d, _ in want]
        assert [round(s, 6) for _, s in rows] == [round(s, 6) for _, s in want]


def test_counts_of_segments_are_summed_before_the_join(spark, monkeypatch):
    """A term is joined to the queries once, not once for every segment that has it."""
    plans, kept = [], search.saved

    def saved(df, label):
        if label == "queries":
            plans.append(df._jdf.queryExecution().analyzed().toString())
        return kept(df, label)

    monkeypatch.setattr(search, "saved", saved)
    rnd = random.Random(8)
    rows = [(i, " ".join(rnd.choice(["often", "again", f"w{rnd.randrange(50)}"]) for _ in range(30))) for i in range(200)]
    docs = documents(spark, rows)
    asked = docs.filter("doc_id % 20 = 0").withColumnRenamed("doc_id", "query_id")
    assert search.search(docs, asked, 3, segment_words=200).count() == 30
    assert len(plans) == 1
    assert "LeftSemi" not in plans[0]
    below = plans[0][plans[0].index("Join Inner") :]
    assert below.index("Aggregate") < below.index("MapInArrow")


def scored(texts, queries, weights, average, k, bars=1):
    """What one task finds for queries of hashed words, and the Python calls it takes."""
    import sys

    import pyarrow as pa

    size = -(-len(texts) // bars)
    rows = [search._segment(list(range(lo, min(len(texts), lo + size))), texts[lo : lo + size]) for lo in range(0, len(texts), size)]
    batch = pa.RecordBatch.from_pylist(rows, schema=pa.schema([(n, pa.binary()) for n in search.NAMES]))
    asked = [(n, q, np.array([weights[int(t)] for t in q])) for n, q in enumerate(queries)]
    calls, found = [0], {}

    def count(frame, event, arg):
        calls[0] += event in ("call", "c_call")

    run = search._run(asked, average, k)([batch])
    sys.setprofile(count)
    try:
        parts = list(run)
    finally:
        sys.setprofile(None)
    for part in parts:
        for row in part.to_pylist():
            found.setdefault(row["query_id"], []).append((-row["score"], row["doc_id"]))
    return {q: [(d, -s) for s, d in sorted(v)[:k]] for q, v in found.items()}, calls[0]


def test_long_queries_are_exact_whatever_the_segments():
    """Frequent and rare words, copies, short and very long texts, one and many segments: the scores of all documents."""
    rnd = np.random.default_rng(11)
    for bars, n in ((1, 3), (1, 500), (7, 500), (40, 700), (1, 2000)):
        texts = [(rnd.zipf(1.25, int(rnd.choice([0, 1, 30, 200, 900], p=[0.05, 0.1, 0.5, 0.3, 0.05]))) % 5000).astype(np.uint64) for _ in range(n)]
        texts += [texts[i] for i in rnd.integers(0, n, n // 4)]
        average = sum(map(len, texts)) / len(texts)
        df = Counter(int(t) for x in texts for t in np.unique(x))
        weights = {t: math.log(1 + (len(texts) - df[t] + 0.5) / (df[t] + 0.5)) for t in range(5000)}
        queries = [np.unique(texts[i]) for i in rnd.integers(0, len(texts), 25)]
        got, _ = scored(texts, queries, weights, average, 10, bars)
        bags = [dict(zip(*np.unique(x, return_counts=True))) for x in texts]
        for q, terms in enumerate(queries):
            want = []
            for d, bag in enumerate(bags):
                long = search.K1 * (1 - search.B + search.B * len(texts[d]) / average)
                parts = [weights[int(t)] * bag[t] * (search.K1 + 1) / (bag[t] + long) for t in terms if t in bag]
                if parts:
                    want.append((-math.fsum(parts), d))
            want = sorted(want, key=lambda x: (round(x[0], 9), x[1]))[:10]
            assert [d for d, _ in got.get(q, [])] == [d for _, d in want]
            assert all(abs(s + t) < 1e-9 for (_, s), (t, _) in zip(got.get(q, []), want))


def test_the_steps_of_a_long_query_dont_grow_with_its_terms():
    rnd = np.random.default_rng(5)
    texts = [rnd.choice(3000, 600, replace=False).astype(np.uint64) for _ in range(300)]
    weights = dict.fromkeys(range(3000), 1.5)
    _, some = scored(texts, [np.sort(t[:60]) for t in texts[:100]], weights, 600.0, 5)
    _, many = scored(texts, [np.sort(t) for t in texts[:100]], weights, 600.0, 5)
    assert many < 1.5 * some


def test_many_short_queries_are_scored_together():
    """A short query of many costs a few calls a segment, not a walk along its lists."""
    rnd = np.random.default_rng(6)
    texts = [rnd.choice(400, 80, replace=False).astype(np.uint64) for _ in range(600)]
    texts += [rnd.choice(400, 8, replace=False).astype(np.uint64) for _ in range(200)]
    average = sum(map(len, texts)) / len(texts)
    weights = {t: 1.0 + t / 400 for t in range(400)}
    queries = [np.sort(t) for t in texts[-200:]]
    got, calls = scored(texts, queries, weights, average, 3)
    assert calls < 300 * len(queries)
    for q, terms in enumerate(queries):
        own = sum(weights[int(t)] * (search.K1 + 1) / (1 + search.K1 * (1 - search.B + search.B * 8 / average)) for t in terms)
        best = []
        for d, text in enumerate(texts):
            part = (search.K1 + 1) / (1 + search.K1 * (1 - search.B + search.B * len(text) / average))
            best.append((-round(sum(weights[int(t)] * part for t in np.intersect1d(text, terms)), 9), d))
        assert [d for d, _ in got[q]] == [d for _, d in sorted(best)[:3]]
        assert abs(got[q][0][1] - own) < 1e-9


def test_scores_of_the_first_segments_are_the_bar_of_the_others(spark, monkeypatch):
    """What cannot be among the best isn't handed on: not ten rows a segment for every query."""
    kept, handed = search.saved, []

    def saved(df, label):
        out = kept(df, label)
        if label == "found":
            handed.append(out.count())
        return out

    monkeypatch.setattr(search, "saved", saved)
    rnd = random.Random(9)
    same = [" ".join(f"common{j}" for j in rnd.sample(range(60), 25)) for _ in range(30)]
    # Every segment of any partition has the same thirty texts and many that share a few words with them.
    texts = [t for _ in range(24) for t in same + [" ".join(f"w{rnd.randrange(400)}" for _ in range(30)) + f" common{rnd.randrange(60)}" for _ in range(30)]]
    df = documents(spark, texts).coalesce(1)
    queries = spark.createDataFrame(list(enumerate(same)), "query_id bigint, text string")
    got = search.search(df, queries, 5, segment_words=1600).orderBy("query_id", "rank").collect()
    assert [r["doc_id"] for r in got if r["query_id"] == 3] == [3 + 60 * i for i in range(5)]
    assert sum(handed) <= 2 * 5 * len(same)


def test_scores_are_exact_however_terms_are_parted(monkeypatch):
    """All terms by postings, all by the matrix, one query or many at once: the same documents."""
    rnd = np.random.default_rng(12)
    texts = [(rnd.zipf(1.3, int(rnd.choice([3, 40, 300]))) % 900).astype(np.uint64) for _ in range(300)]
    texts += texts[:40]
    average = sum(map(len, texts)) / len(texts)
    weights = {t: 1.0 + (t * 7919 % 900) / 300 for t in range(900)}
    queries = [np.unique(t) for t in texts[::5]]
    want, _ = scored(texts, queries, weights, average, 10, 3)
    assert want[3][0][0] in (15, 315)
    for name, value in (("CELLS", 1), ("OFTEN", 0), ("OFTEN", 1 << 40), ("QUERIES_AT_ONCE", 1), ("POSTINGS", 1), ("LIKE", 1), ("DOCS_BLOCK", 1)):
        with monkeypatch.context() as m:
            m.setattr(search, name, value)
            assert scored(texts, queries, weights, average, 10, 3)[0] == want


def test_segments_hold_any_counts_in_few_bytes():
    """Frequencies over 65,535, many documents, hashes that crowd: postings as counted one by one."""
    rnd = np.random.default_rng(2)
    crowd = np.arange(300, dtype=np.uint64)
    wide = rnd.integers(0, 2**63, 500, dtype=np.uint64)
    texts = [np.repeat(crowd[:1], 70_000), *(rnd.choice(np.concatenate([crowd, wide]), 6) for _ in range(300)), crowd[:0]]
    row = search._segment(list(range(len(texts))), texts)
    segment = search.Segment(row, 10.0)
    found = {}
    for term, a, b in zip(segment.terms.tolist(), segment.starts[:-1], segment.starts[1:]):
        for doc, tf in zip(segment.post_doc[a:b], segment.post_tf[a:b]):
            found[(int(segment.docs[doc]), term)] = int(tf)
    assert found == {(d, int(t)): n for d, text in enumerate(texts) for t, n in Counter(text.tolist()).items()}
    assert [int(segment.lengths[np.flatnonzero(segment.docs == d)[0]]) for d in range(len(texts))] == [len(t) for t in texts]
    small = search._segment(list(range(300)), texts[1:301])
    assert len(small["post_tf"]) * 2 == len(small["post_doc"])
