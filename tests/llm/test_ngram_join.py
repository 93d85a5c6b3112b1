"""The similarity join against all pairs."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pyarrow as pa

from opslog.llm import ngram_join, queries
from opslog.llm.components import components
from tests.llm.common import documents, odd_cases, prose, word


def shingle_set(text):
    words = text.encode().lower().split() if text else []
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """doc_id to (set size, smallest id reachable), by comparing all pairs."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    comp = {i: i for i, _ in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for a, x in sets:
        for b, y in sets:
            if a < b and x and y and 100 * len(x & y) >= 75 * len(x | y):
                comp[max(root(a), root(b))] = min(root(a), root(b))
    return {i: (len(s), root(i)) for i, s in sets}


def edited(rnd, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rnd.randrange(len(words))] = word(rnd)
    return " ".join(words)


def corpus(seed, groups=14):
    rnd = random.Random(seed)
    shared = prose(rnd, 6)
    out = []
    for _ in range(groups):
        base = prose(rnd, rnd.randint(2, 25))
        out += [edited(rnd, base, rnd.randint(0, 4)) for _ in range(rnd.randint(1, 12))]
        out.append(f"{prose(rnd, 2)} {shared} {prose(rnd, 2)}")
    rnd.shuffle(out)
    return out


def test_equals_all_pairs(spark):
    for seed in (1, 2):
        texts = corpus(seed) + ["", None, "a b", "A B", "a  b", "a b c d e", "a b c d f"]
        got = ngram_join.similar_documents(documents(spark, texts)).collect()
        want = brute(list(enumerate(texts)))
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_links_are_all_similar_pairs(spark):
    texts = corpus(5, 6)
    sets = ngram_join.SimilarSets(documents(spark, texts))
    first = {}
    for r in sets.members.orderBy("doc_id").collect():
        first.setdefault(r["cls"], r["doc_id"])
    got = {tuple(sorted((first[r["a"]], first[r["b"]]))) for r in sets.links().collect()}
    known = {i: shingle_set(t) for i, t in enumerate(texts)}
    want = {
        (a, b)
        for a in set(first.values())
        for b in set(first.values())
        if a < b and 100 * len(known[a] & known[b]) >= 75 * len(known[a] | known[b])
    }
    assert got == want


def test_large_groups_and_hot_tokens(spark):
    """Copies of one text by the hundred, plain and edited, and a passage in every text."""
    rnd = random.Random(8)
    base, shared = prose(rnd, 20), prose(rnd, 8)
    texts = [base] * 150 + [edited(rnd, base, 3) for _ in range(150)] + [f"{prose(rnd, 8)} {shared}" for _ in range(150)]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.similar_documents(documents(spark, texts)).collect()}
    want = brute(list(enumerate(texts)))
    assert got == {i: c for i, (_, c) in want.items()}


def test_odd_rows_and_empty_table(spark):
    df = odd_cases(spark)
    got = ngram_join.similar_documents(df).collect()
    assert len(got) == df.count()
    assert sorted(r["component_id"] for r in got if r["doc_id"] in (4, 5)) == [4, 4, 4]
    assert all(r["component_id"] == r["doc_id"] for r in got if r["n_shingles"] == 0)
    assert ngram_join.similar_documents(df.limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}}


def test_query_equals_sql(spark, data):
    df = queries.QUERIES["op1_ngram_jaccard_join"](spark, data)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    want = con.execute(queries.SQL["op1_ngram_jaccard_join"]).fetchall()
    assert sorted(tuple(r) for r in df.collect()) == sorted(want)


def test_counts_beside_classes_are_narrow():
    """With many buckets a class has few tokens in each: the count beside it must not weigh as much as they do."""
    rnd = np.random.default_rng(5)
    texts = [" ".join(map(str, rnd.integers(0, 10**6, n))) for n in (70_000, 400, 300, 6, 3)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(5)), "text": texts})
    rows = [r for out in ngram_join._packed_sets(5, 256)([batch]) for r in out.to_pylist()]
    tokens = [r for r in rows if r["kind"] == ngram_join.TOKENS]
    assert sum(len(r["cnt"]) for r in tokens) <= 2 * sum(len(r["cls"]) // 8 for r in tokens)
    assert sum(int(ngram_join._counted(r)[1].sum()) for r in tokens) == sum(len(r["tok"]) // 7 for r in tokens) == 69_996 + 396 + 296 + 2 + 1
    members = [r for r in rows if r["kind"] == ngram_join.MEMBERS]
    assert ngram_join._counted(members[0])[1].tolist() == [69_996, 396, 296, 2, 1]
