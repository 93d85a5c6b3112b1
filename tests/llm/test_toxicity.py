"""The network: gradients by differences, held-out accuracy on planted words."""

from __future__ import annotations

import random
import zlib

import numpy as np

from opslog.llm import toxicity as tox
from tests.llm.common import documents, odd_cases, prose

RUDE = ["grotbag", "zwiebert", "snarkle", "mopfuzz"]


def rude(rnd, text):
    words = text.split(" ")
    for _ in range(max(2, len(words) // 30)):
        words.insert(rnd.randrange(len(words)), rnd.choice(RUDE) + rnd.choice(["", "s", ",", "!"]))
    return " ".join(words)


def corpus(seed, n):
    rnd = random.Random(seed)
    labels = [int(rnd.random() < 0.3) for _ in range(n)]
    return [rude(rnd, prose(rnd, rnd.randint(2, 40))) if y else prose(rnd, rnd.randint(2, 40)) for y in labels], labels


def test_gradients():
    net, rnd = tox.Network.fresh(), np.random.default_rng(0)
    for k in net.w:
        net.w[k] = net.w[k].astype(np.float64)
    x = rnd.normal(size=(7, tox.WIDTH))
    index, length = rnd.integers(0, 7, (tox.WINDOW, 3)), np.array([32, 5, 17])
    target, weight = np.array([1.0, 0, 1]), np.ones(3)
    gates = x @ net.w["in"] + net.w["in_b"]
    _, grad, d_gates = net.gradients(gates, index, length, target, weight)

    def slope(array, at, step=1e-2):
        old, values = array[at], []
        for s in (step, -step):
            array[at] = old + s
            values.append(net.gradients(gates, index, length, target, weight)[0])
        array[at] = old
        return (values[0] - values[1]) / (2 * step)

    for name in ("rec", "att", "att_v", "out"):
        for _ in range(3):
            at = tuple(int(rnd.integers(0, s)) for s in net.w[name].shape)
            assert abs(slope(net.w[name], at) - grad[name][at]) < 1e-4 + 0.02 * abs(grad[name][at])
    at = (1, int(index[3, 0]), 5)
    assert abs(slope(gates, at) - d_gates[at]) < 1e-4


def test_held_out_accuracy():
    model = tox.train(*corpus(1, 400), share=0.3)
    texts, labels = corpus(2, 200)
    scores = model.scores(texts)
    assert ((scores >= tox.THRESHOLD) == np.array(labels)).mean() > 0.95
    assert scores[np.array(labels) == 1].mean() > scores[np.array(labels) == 0].mean() + 0.5
    # A place anywhere in a long text is seen: windows cover the whole of it.
    long = prose(random.Random(3), 600)
    assert model.scores([long])[0] < tox.THRESHOLD <= model.scores([f"{long} grotbag zwiebert mopfuzz {long}"])[0]
    assert model.scores([None, "", " "]).tolist() == [0, 0, 0]


def test_windows_cover_every_word():
    for n in (0, 1, 16, 17, 32, 33, 48, 49, 1000):
        seen = {i for a in tox.windows(n) for i in range(a, min(n, a + tox.WINDOW))}
        assert seen == set(range(n))


def test_training_rows_are_not_held_out(spark):
    docs = documents(spark, [f"text {i}" for i in range(60)])
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(60)] + [(None, 1, 1), (3, 1, None)], "doc_id bigint, quality int, toxic int")
    texts, y, share = tox.labelled(docs, labels)
    want = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert texts == [f"text {i}" for i in want]
    assert y == [int(i % 3 == 0) for i in want]
    assert abs(share - sum(y) / len(y)) < 1e-9
    assert len(tox.labelled(docs, labels, 4, 5)[0]) == 9


def test_rows(spark):
    df = odd_cases(spark)
    model = tox.Model(tox.Network.fresh())
    for m in (None, model):
        got = tox.score(df, m).collect()
        assert len(got) == df.count()
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
        assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert tox.score(df.limit(0), model).count() == 0
    assert tox.without_toxic(df, model).columns == df.columns
    assert tox.train(["a", "b"], [0, 0]) is None
    assert tox.train([], []) is None
