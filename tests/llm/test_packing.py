"""Packing: every piece once, nothing overlaps, few sequences."""

from __future__ import annotations

import zlib
from itertools import combinations_with_replacement

import numpy as np
import pytest

from opslog.llm import packing, tokens
from opslog.llm.tokens import encoder
from tests.llm.common import documents, odd_cases, prose


def check(rows, size):
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(places)


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece(seed):
    rnd = np.random.default_rng(seed)
    lengths = [rnd.integers(1, 65, 400), np.clip(rnd.lognormal(2.5, 1, 900).astype(int), 1, 64), rnd.integers(2, 9, 300), rnd.integers(30, 50, 200)][seed]
    histogram = np.bincount(lengths, minlength=65)
    used = np.zeros(65, int)
    for parts, times in packing.plan(histogram, 64):
        assert sum(parts) <= 64
        assert times > 0
        for p in parts:
            used[p] += times
    assert (used == histogram).all()
    count = sum(t for _, t in packing.plan(histogram, 64))
    # First fit decreasing, by hand.
    gaps = []
    for x in sorted(lengths.tolist(), reverse=True):
        fit = next((i for i, g in enumerate(gaps) if g >= x), None)
        if fit is None:
            gaps.append(64 - x)
        else:
            gaps[fit] -= x
    assert count <= len(gaps) + 1


def test_complements_are_found_where_they_exist():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        left = rnd.integers(0, 3, 12)
        left[0] = 0
        gap = int(rnd.integers(1, 12))
        have = [k for k in range(1, 12) if left[k]]
        exists = any(
            sum(c) == gap and all(c.count(x) <= left[x] for x in c) for n in (1, 2, 3) for c in combinations_with_replacement(have, n)
        )
        found = packing._complement(gap, left)
        assert bool(found) == exists
        if found:
            assert sum(found) == gap
            assert all(found.count(x) <= left[x] for x in found)


def test_pieces_hold_the_documents_ids(spark):
    import random

    rnd = random.Random(2)
    texts = [prose(rnd, rnd.randint(1, 60)) for _ in range(80)] + [None, "", " "]
    rows = packing.pack(documents(spark, texts), size=64, with_ids=True).collect()
    check(rows, 64)
    model = encoder("byte_bpe_50k.json", True)
    for doc, text in enumerate(texts):
        ids = np.append(model.encode(text), 0).astype("<u4")
        mine = sorted((r for r in rows if r["doc_id"] == doc), key=lambda r: r["piece"])
        assert b"".join(bytes(r["ids"]) for r in mine) == ids.tobytes()
        assert [r["start"] for r in mine] == np.cumsum([0, *(r["length"] for r in mine)])[:-1].tolist()
        assert all(r["length"] == 64 for r in mine[1:])
        assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in mine)


def test_odd_rows_and_empty_table(spark):
    df = odd_cases(spark)
    rows = packing.pack(df).collect()
    check(rows, packing.SIZE)
    assert sum(r["piece"] == 0 for r in rows) == df.count()
    assert packing.pack(df.limit(0)).count() == 0


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_frequent_pieces_are_encoded_once(name, spaced, monkeypatch):
    """A small memory keeps what comes again and again, whatever comes once; new pieces go to the tokenizer together."""
    monkeypatch.setattr(tokens, "CACHE_PIECES", 300)
    own, rnd, given = tokens.Encoder(name, spaced), np.random.default_rng(3), []

    class Recorder:
        def __init__(self, model):
            self.model = model

        def __getattr__(self, key):
            return getattr(self.model, key)

        def encode_batch_fast(self, texts, **options):
            given.append(list(texts))
            return self.model.encode_batch_fast(texts, **options)

    own.model = Recorder(own.model)
    letters = list("abdeéß.,'S1²<é")
    texts = []
    for _ in range(60):
        rare = ["".join(rnd.choice(letters, 9)) for _ in range(20)]
        texts.append("start " + " ".join([*rare, "often", "again."]) + "\n next it's\t \x1c x")
    for text in texts:
        assert own.encode(text).tolist() == own.model.model.encode(text, add_special_tokens=False).ids
    words = " ".join(t for call in given for t in call).split()
    assert [words.count(w) for w in ("often", "again.", "next")] == [1, 1, 1]
    assert sum(len(call) for call in given) < sum(len(set(t.split())) for t in texts) // 2


class _Counted:
    """A tokenizer that says which texts it got."""

    def __init__(self, model):
        self.own, self.given = model, []

    def __getattr__(self, key):
        return getattr(self.own, key)

    def encode_batch_fast(self, texts, **options):
        self.given += texts
        return self.own.encode_batch_fast(texts, **options)


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_known_words_under_new_endings_need_no_tokenizer(name, spaced):
    own = tokens.Encoder(name, spaced)
    own.model = _Counted(own.model)
    own.encode(" bandorest éléanti, it's! 12- Überan")
    own.model.given.clear()
    for text in (" bandorest, éléanti! it's", " bandorest! it's, 12!", " éléanti- bandorest- Überan,", *([] if spaced else [" BANDOREST, überan! IT'S-"])):
        assert own.encode(text).tolist() == own.model.own.encode(text, add_special_tokens=False).ids
    assert not own.model.given


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_proven_merges_give_the_tokenizers_ids(name, spaced, monkeypatch):
    """New words of letters need no tokenizer once the merges alone had its ids; where they hadn't, all go to it."""
    monkeypatch.setattr(tokens, "PROOF", 50)
    rnd = np.random.default_rng(7)
    letters, ends = list("abdeéßÀÿsztrnßZE"), ["", "", ",", ".", "'s", "'", ")!", "-x", "́", "ñ9", "İ", "Σ", "×"]
    texts = [" ".join("".join(rnd.choice(letters, rnd.integers(1, 9))) + rnd.choice(ends) for _ in range(40)) for _ in range(120)]
    plain = ["".join(rnd.choice(letters, 12)) for _ in range(300)]
    for broken in (False, True):
        own = tokens.Encoder(name, spaced)
        if broken:
            merges = own.merges
            monkeypatch.setattr(own, "merges", lambda word, merges=merges: merges(word)[:-1])
        own.model = _Counted(own.model)
        for text, ids in zip(texts, own.encode_all(texts)):
            assert ids.tolist() == own.model.own.encode(text, add_special_tokens=False).ids
        own.model.given.clear()
        text = " " + " ".join(plain)
        assert own.encode(text).tolist() == own.model.own.encode(text, add_special_tokens=False).ids
        assert bool(own.model.given) == broken


def test_half_a_million_pieces_are_still_the_younger_ones():
    own = tokens.Encoder("byte_bpe_50k.json", True)
    own.known = dict.fromkeys(map(str, range(500_000)), b"")
    assert own.encode("Some new words.").tolist() == own.model.encode("Some new words.", add_special_tokens=False).ids
    assert "7" in own.known and not own.older


def test_marks_after_a_letter_or_digit_are_parted():
    own = tokens.Encoder("word_bpe_49k.json", False)
    parted = {"Word.": ("word", "."), "É9...": ("é9", "..."), "a.b!": ("a.b", "!"), "...": ("...", ""), "×.": ("×.", ""), "ж.": ("ж.", ""), "a": ("a", "")}
    assert {p: own._word(p) for p in parted} == parted
