"""The pipeline over planted documents: what has to go goes, what is clean stays."""

from __future__ import annotations

import random
import zlib

import pytest

import corpus_pipeline
from opslog.llm import packing, tokens, toxicity
from opslog.llm.tokens import Encoder, encoder
from tests.llm.common import documents, prose
from tests.llm.test_decontaminate import bench
from tests.llm.test_ngram_join import brute, edited
from tests.llm.test_packing import check
from tests.llm.test_toxicity import rude


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rnd, folder = random.Random(21), str(tmp_path_factory.mktemp("corpus"))
    items = [prose(rnd, 4) for _ in range(5)]
    kinds, texts = [], []

    def add(kind, text):
        kinds.append(kind)
        texts.append(text)

    for _ in range(260):
        add("clean", prose(rnd, rnd.randint(4, 25)))
    for _ in range(110):
        add("toxic", rude(rnd, prose(rnd, rnd.randint(4, 25))))
    for i in rnd.sample(range(260), 20):
        add("copy", texts[i])
    for i in rnd.sample(range(260), 20):
        words = texts[i].split(" ")
        step = max(1, len(words) // max(1, len(words) // 40))
        for at in range(step // 2, len(words), step):  # edits so close that no long passage stays
            words[at] = "edited"
        add("near", " ".join(words))
    for k in range(15):
        host = prose(rnd, 8)
        add("leak", f"{host}\n{items[k % 5]}\n{prose(rnd, 3)}")
    documents(spark, texts).write.parquet(f"{folder}/documents.parquet")
    bench(spark, items).write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, 1, int(k == "toxic")) for i, k in enumerate(kinds)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, kinds, texts


def test_stages(spark, planted):
    folder, kinds, texts = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    of = lambda kind: {i for i, k in enumerate(kinds) if k == kind}
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        seen[name] = (docs, out := out.cache())
        if name != "best-fit packing":
            assert out.columns == docs.columns
        docs = out
    kept = ids(seen["toxicity"][1])
    held = {i for i in range(len(kinds)) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert len(of("toxic") & held & kept) <= 0.1 * len(of("toxic") & held)
    assert len((set(range(len(kinds))) - of("toxic")) - kept) <= 5

    before, after = seen["line dedup"]
    assert len(of("copy") & ids(after)) <= sum(len(texts[i].split()) < 50 for i in of("copy"))
    clean = {r["doc_id"]: r["text"] for r in after.collect()}
    assert all(clean[i] == texts[i] for i in of("clean") & ids(before))
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())

    before, after = seen["n-gram jaccard join"]
    want = brute(sorted((r["doc_id"], r["text"]) for r in before.collect()))
    assert ids(after) == {i for i, (_, c) in want.items() if i == c}

    before, after = seen["benchmark decontamination"]
    assert not of("leak") & ids(after)
    assert ids(before) - of("leak") == ids(after)

    before, after = seen["best-fit packing"]
    rows = after.collect()
    check(rows, 2048)
    model = encoder("byte_bpe_50k.json", True)
    total = sum(len(model.encode(r["text"])) + 1 for r in before.collect())
    assert sum(r["length"] for r in rows) == total
    assert len({r["sequence_id"] for r in rows}) <= total // 2048 + 2


def test_odd_and_empty_documents(spark, planted, monkeypatch):
    from tests.llm.common import odd_cases

    folder, _, _ = planted
    monkeypatch.setattr(toxicity, "train", lambda *a, **k: None)
    for docs in (odd_cases(spark), odd_cases(spark).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, folder)
            if name != "best-fit packing":
                assert out.columns == docs.columns
            docs = out
        docs.count()


def test_workers_keep_little(spark, planted, monkeypatch):
    """Batches and the packing stage's memory are bounded below what the operators take by themselves."""
    folder, _, _ = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = sorted(map(tuple, packing.pack(docs).select("doc_id", "piece", "start", "length", "ids_crc32").collect()))
    given = []
    pack = packing.pack
    monkeypatch.setattr(packing, "pack", lambda docs, **more: given.append(more) or pack(docs, **more))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = dict(corpus_pipeline.STAGES)["best-fit packing"](spark, docs, folder)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 2500
    assert given and given[0]["remembered"] < tokens.CACHE_PIECES // 2
    assert sorted(map(tuple, found.select("doc_id", "piece", "start", "length", "ids_crc32").collect())) == want


def test_encoder_keeps_no_more_than_it_is_told():
    rnd = random.Random(8)
    texts = [prose(rnd, 20) + f" {k} " + " ".join(f"{rnd.random():.9f}" for _ in range(50)) for k in range(60)]
    small, large = Encoder("byte_bpe_50k.json", True, 400), Encoder("byte_bpe_50k.json", True)
    assert [x.tolist() for x in small.encode_all(texts)] == [x.tolist() for x in large.encode_all(texts)]
    assert len(large.known) > 2000
    assert len(small.known) < len(large.known) / 2


def test_edited_helper_changes_words():
    rnd = random.Random(1)
    text = prose(rnd, 5)
    assert edited(rnd, text, 2) != text
