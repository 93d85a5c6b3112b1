"""Repeated passages against a search for all repeated runs of lines."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from opslog.llm import line_chunks
from tests.llm.common import documents, odd_cases, prose, sentence, word


def run(spark, texts):
    return {r["doc_id"]: r for r in line_chunks.dedup_lines(documents(spark, texts)).collect()}


def test_passages_are_kept_once_and_clean_texts_stay(spark):
    rnd = random.Random(4)
    passages = [" ".join(sentence(rnd, 8) for _ in range(10)) for _ in range(12)]
    clean = [prose(rnd, 12) for _ in range(40)]
    texts = list(clean)
    for k, p in enumerate(passages):
        for at in rnd.sample(range(40), 3):
            lines = texts[at].split("\n")
            lines.insert(rnd.randrange(len(lines) + 1), p if k % 2 else f"{sentence(rnd, 5)} {p} {sentence(rnd, 4)}")
            texts[at] = "\n".join(lines)
    got = run(spark, texts)
    caught = sum(sum(p in got[i]["text"] for i in range(40)) == 1 for p in passages)
    assert caught == 12
    assert all(any(p in got[i]["text"] for i in range(40)) for p in passages)
    for i, text in enumerate(clean):
        for line in text.split("\n"):
            assert line in got[i]["text"]


def test_short_and_single_lines_stay(spark):
    line = "All of it is ours."
    texts = [f"{line}\nAnd more of this kind.\n{prose(random.Random(k), 3)}" for k in range(5)]
    assert [run(spark, texts)[i]["text"] for i in range(5)] == texts


def test_an_exact_copy_loses_its_text(spark):
    text = prose(random.Random(9), 20)
    got = run(spark, [text, text, prose(random.Random(10), 20)])
    assert got[0]["text"] == text
    assert got[1]["text"] == ""
    assert got[2]["n_removed"] == 0


def test_lines_join_to_the_text():
    rnd = random.Random(7)
    for _ in range(2000):
        text = "".join(rnd.choice("ab. !?\n\t\0") for _ in range(rnd.randint(0, 12)))
        assert "".join(line_chunks.lines_of(text)) == text


def test_odd_rows_and_empty_table(spark):
    df = odd_cases(spark)
    out = line_chunks.dedup_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_removed_"]
    assert sorted(map(str, out.select("doc_id", "text").collect())) == sorted(map(str, df.select("doc_id", "text").collect()))
    assert line_chunks.dedup_lines(df.limit(0)).count() == 0


def test_every_passage_over_fifty_words_is_kept_once(spark):
    """Of any make: one long sentence, many short ones, in the middle of a host's sentence; 51 words and more."""
    rnd = random.Random(14)
    hosts, passages = [prose(rnd, 14).split(" ") for _ in range(60)], []
    for k in range(60):
        n = rnd.choice([51, 52, 55, 60, 90, 200, 900])
        words = [word(rnd) for _ in range(n)]
        if k % 3:
            words = [w + "." if rnd.random() < 0.15 / (k % 3) else w for w in words]
        passages.append(" ".join(words))
        for at in rnd.sample(range(60), 3):
            hosts[at].insert(rnd.randrange(len(hosts[at]) + 1), passages[-1])  # never inside another one
    got = run(spark, [" ".join(host) for host in hosts])
    grams = {}
    for i in range(60):
        w = got[i]["text"].split()
        for j in range(len(w) - 50):
            grams.setdefault(tuple(w[j : j + 51]), []).append(i)
    assert not [v for v in grams.values() if len(v) > 1]
    assert all(any(p in got[i]["text"] for i in range(60)) for p in passages)


def test_equal_words_go_as_far_as_they_are_equal():
    words = [f"w{i}" for i in range(4000)]
    mine, other = " ".join(words), " ".join(["a", "b", *words[:3000], "other", *words[3001:]])
    seg = {"words": other, "first": 0, "matches": [{"shift": -2, "starts": [1500]}]}
    cuts, _, _ = line_chunks.removed_words(mine, [seg], 2, 50)
    assert cuts == [(0, mine.index("w3000"))]


def test_an_earlier_part_of_a_passage_hides_none(spark):
    """Passages of 55 words in two documents each, 40 to 49 words of which an earlier document has."""
    rnd = random.Random(21)
    first, second, third, passages = [], [], [], []
    for k in range(60):
        words = [word(rnd) + str(k) for _ in range(55)]
        passages.append(" ".join(words))
        n = 40 + k % 10
        at = rnd.randrange(55 - n + 1)
        first.append(" ".join([prose(rnd, 4), *words[at : at + n], prose(rnd, 4)]))
        second.append(" ".join([prose(rnd, 4), passages[-1], prose(rnd, 4)]))
        third.append(" ".join([prose(rnd, 4), passages[-1], prose(rnd, 4)]))
    got = run(spark, first + second + third)
    assert [got[i]["text"] for i in range(60)] == first
    assert all(p in got[60 + k]["text"] for k, p in enumerate(passages))
    assert sum(p in got[120 + k]["text"] for k, p in enumerate(passages)) == 0
    assert all(got[120 + k]["text"].startswith(third[k].split(passages[k])[0].strip()[:-12]) for k in range(60))


def test_words_are_hashed_as_split_parts_them():
    rnd = random.Random(3)
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = [None, "", "a" * 300_000 + " b", *("".join(rnd.choice([*spaces, *"abé€​⁰" * 4]) for _ in range(30)) for _ in range(300))]
    hashes, counts = line_chunks.word_hashes(pa.array(texts, pa.string()).slice(1))
    words = [(t or "").split() for t in texts[1:]]
    assert counts.tolist() == [len(w) for w in words]
    known = {}
    assert all(known.setdefault(w, h) == h for w, h in zip((w for ws in words for w in ws), hashes.tolist()))
    assert len(set(known.values())) == len(known)


def test_few_fingerprints_hold_every_stretch():
    texts = [np.random.default_rng(k).integers(0, 2**63, n).astype(np.uint64) for k, n in enumerate((20_000, 49, 50, 51, 3000))]
    text, start, *_ = line_chunks.prints_of(texts)
    for k, words in enumerate(texts):
        places = np.sort(start[text == k])
        assert len(places) <= 0.11 * len(words) + 1  # two in twelve words before
        ends = np.concatenate([[-1], places, [max(-1, len(words) - 30 + 1)]])
        assert np.diff(ends).max() <= 21 or len(words) < 50
    assert not (text == 1).any() and (text == 2).sum() == 1


def test_a_match_without_starts_counts_from_end_to_end():
    words = [f"w{i}" for i in range(400)]
    other = [*words[:150], "other", *words[151:340], "other", *words[341:]]
    seg = {"words": " ".join(other), "first": 0, "matches": [{"shift": 0}]}
    cuts, _, _ = line_chunks.removed_words(" ".join(words), [seg], 2, 50)
    text = " ".join(words)
    assert cuts == [(0, text.index("w150")), (text.index("w151"), text.index("w340")), (text.index("w341"), len(text))]
