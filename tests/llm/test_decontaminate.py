"""Benchmark items in documents: the exact check against a table, recall against brute force."""

from __future__ import annotations

import random

import numpy as np

from opslog.llm import decontaminate as dec
from tests.llm.common import documents, odd_cases, prose, word


def plain_distance(a, b):
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return min(row)


def test_edit_distance_is_exact():
    rnd = random.Random(0)
    for _ in range(1500):
        a = [rnd.randint(1, 4) for _ in range(rnd.randint(1, 12))]
        b = [rnd.randint(1, 4) for _ in range(rnd.randint(0, 15))]
        assert dec.edit_distance(np.array(a, np.uint64), np.array(b, np.uint64))[0] == plain_distance(a, b)


def edited(rnd, words, edits):
    words = list(words)
    for _ in range(edits):
        i, kind = rnd.randrange(len(words)), rnd.random()
        if kind < 0.6:
            words[i] = word(rnd) + "x"
        elif kind < 0.8:
            words.insert(i, word(rnd) + "y")
        elif len(words) > 4:
            del words[i]
    return words


def bench(spark, items):
    return spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")


def test_exact_items_are_all_found_and_edited_ones_to_the_recall(spark):
    rnd = random.Random(12)
    items = [" ".join(word(rnd) for _ in range(rnd.choice([4, 5, 7, 9, 11, 15, 20, 34, 50, 90]))) for _ in range(60)]
    texts, planted = [], {}
    for k in range(240):
        host, item = prose(rnd, 12).split(), k % len(items)
        words = items[item].split()
        # A tenth of the words may change; the verdict is by brute force below.
        edits = 0 if k < 120 else int(rnd.random() * 0.12 * len(words))
        at = rnd.randrange(len(host))
        words = edited(rnd, words, edits)
        texts.append(" ".join(host[:at] + [w.upper() + "," for w in words] + host[at:]))
        planted[k] = (item, edits)
    found = {(r["doc_id"], r["item_id"]): r["edits"] for r in dec.contaminated(documents(spark, texts), bench(spark, items)).collect()}
    known = dec.Words()
    for k in range(120):
        assert found.get((k, planted[k][0])) == 0
    truth = set()
    for k, text in enumerate(texts):
        for i, item in enumerate(items):
            a, b = known.of(item), known.of(text)
            edits = plain_distance(a.tolist(), b.tolist()) if k % 6 == 0 or planted[k][0] == i else len(a)
            if edits <= dec.RATE * len(a):
                truth.add((k, i))
                if (k, i) in found:
                    assert found[k, i] == edits
    assert len(truth & set(found)) >= 0.95 * len(truth)
    checked = {f for f in found if f[0] % 6 == 0}
    assert checked <= truth


def test_clean_rows_stay_and_odd_rows(spark):
    rnd = random.Random(5)
    items = bench(spark, [" ".join(word(rnd) for _ in range(30)), None, "", "a b"])
    df = odd_cases(spark)
    assert dec.contaminated(df, items).count() == 0
    assert dec.without_contaminated(df, items).count() == df.count()
    assert dec.contaminated(df.limit(0), items).count() == 0
    assert dec.contaminated(df, items.limit(0)).count() == 0
    leak = items.first()["text"]
    both = documents(spark, [f"so it goes {leak} and on", "clean", None])
    assert sorted(r["doc_id"] for r in dec.without_contaminated(both, items).collect()) == [1, 2]


def test_blocks_change_nothing(spark, monkeypatch):
    rnd = random.Random(6)
    items = [" ".join(word(rnd) for _ in range(20)) for _ in range(7)]
    docs = documents(spark, [f"{prose(rnd, 3)} {x} {prose(rnd, 3)}" for x in items])
    whole = sorted(dec.contaminated(docs, bench(spark, items)).collect())
    monkeypatch.setattr(dec, "BLOCK_ITEMS", 3)
    assert sorted(dec.contaminated(docs, bench(spark, items)).collect()) == whole
    assert len(whole) == 7


def test_recall_at_every_length_and_share_of_edits(spark):
    """Borders of classes above all: items a word longer than a window have edits in most of their windows."""
    rnd = random.Random(21)
    lengths, shares, each = [5, 8, 10, 11, 12, 18, 19, 20, 22, 35, 37, 40, 60, 100], [0.1, 0.15, 0.2], 20
    items, texts, cells = [], [], []
    for n in lengths:
        for share in shares:
            for _ in range(each):
                words = [word(rnd) + word(rnd) for _ in range(n)]
                host = prose(rnd, 8).split()
                at = rnd.randrange(len(host))
                texts.append(" ".join(host[:at] + edited(rnd, words, int(share * n + 1e-9)) + host[at:]))
                items.append(" ".join(words))
                cells.append((n, share))
    found = {(r["doc_id"], r["item_id"]) for r in dec.contaminated(documents(spark, texts), bench(spark, items)).collect()}
    for cell in set(cells):
        hits = [(k, k) in found for k, c in enumerate(cells) if c == cell]
        assert sum(hits) >= 0.9 * len(hits), cell


def test_one_piece_more_than_edits():
    for n in range(4, 200):
        pieces = dec.pieces_of(n, dec.RATE)
        assert len(pieces) == int(dec.RATE * n) + 1
        assert all(size >= 2 and a + size <= b for (a, size), (b, _) in zip(pieces, [*pieces[1:], (n, 0)]))
