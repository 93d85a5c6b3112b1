import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from opslog.llm import pieces
from opslog.llm.common import tokenizer_path
from tests.llm.common import odd_cases, prose

PATH = tokenizer_path(pieces.MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return pieces.model()


def same(own, library, text):
    ids = own.encode(text).tolist()
    assert ids == library.encode(text), repr(text)
    assert own.decode(ids) == library.decode(ids), repr(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("abethnrs  \n\t▁é日本😀𝕏.,!'\"()0123\x00　ﬁ"), max_size=40))
def test_equals_the_library_on_odd_text(own, library, text):
    same(own, library, text)


def test_equals_the_library_on_pieces_runs_of_spaces_and_prose(own, library):
    rnd = random.Random(2)
    for _ in range(2000):
        same(own, library, "".join(own.pieces[rnd.randrange(259, 32000)] for _ in range(4)).replace("▁", " "))
    for n in range(80):
        same(own, library, " " * n + "a" + " " * n)
        same(own, library, "a" * n + "\n" * n)
    same(own, library, prose(rnd, 400))
    same(own, library, "x" * 100_000)


def test_every_prefix_has_the_last_piece_of_its_own_encoding(own):
    text = "▁unbelievably"
    table = own.prefix_table(text)
    for end in range(1, len(text) + 1):
        assert own._known_ids(text[:end])[-1] == table[end]


def test_decoding_of_any_ids_equals_the_library(own, library):
    rnd = random.Random(3)
    for _ in range(3000):
        ids = [rnd.choice([rnd.randrange(3, 259), rnd.randrange(259, 32000), 28705]) for _ in range(rnd.randint(0, 6))]
        assert own.decode(ids) == library.decode(ids), ids


def test_cuts_into_pieces_of_text_and_full_caches_change_nothing(library, monkeypatch):
    monkeypatch.setattr(pieces, "PIECE", 16)
    small = pieces.Pieces.load(PATH)
    small.pairs.limit, small.stretches.limit = 50, 2000
    monkeypatch.setattr(pieces, "GROUP", 50)
    text = prose(random.Random(4), 60)
    same(small, library, text)
    texts = [text, None, "", "x" * 500 + " 😀 y", text[:99]]
    assert [a.tolist() for a in small.encode_all(texts)] == [library.encode(t or "") for t in texts]
    assert len(small.pairs) <= 50


def test_rows_keep_their_columns_and_odd_rows_have_results(spark, library):
    df = odd_cases(spark).withColumnRenamed("part", "ids").withColumnRenamed("cls", "decoded")
    both = pieces.decode(pieces.encode(df), "ids_")
    assert both.columns == [*df.columns, "ids_", "decoded_"]
    for r in both.collect():
        assert r["ids_"] == library.encode(r["text"] or "") and r["decoded_"] == (r["text"] or "")
    assert pieces.decode(pieces.encode(df.limit(0)), "ids_").count() == 0
    nulls = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r["decoded"] for r in pieces.decode(nulls).collect()] == ["", ""]
