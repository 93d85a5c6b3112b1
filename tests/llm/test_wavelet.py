"""Wavelet shards: every access against the plain list, and the query against the tokenizer."""

from __future__ import annotations

import io
import zlib

import numpy as np
import pytest

from opslog.llm import wavelet
from opslog.llm.common import tokenizer_path
from opslog.llm.tokens import Encoder, encoder
from tests.llm.common import odd_cases


@pytest.mark.parametrize(("n", "top"), [(0, 1), (1, 1), (700, 9), (5000, 49_408), (600_000, 300)])
def test_file_answers_like_the_list(n, top):
    rnd = np.random.default_rng(n)
    ids = (rnd.zipf(1.4, n) % top).astype("<u4")
    file = wavelet.WaveletFile(io.BytesIO(wavelet.build(ids, [None, 7], np.array([n // 2, n - n // 2]))))
    assert np.array_equal(file.tokens(), ids)
    docs, ends = file.documents()
    assert docs == [None, 7]
    assert ends.tolist() == [n // 2, n]
    for i in rnd.integers(0, n, 25) if n else ():
        assert file.access(int(i)) == ids[i]
        places = np.flatnonzero(ids == ids[i])
        assert file.count(int(ids[i])) == len(places)
        assert file.count(int(ids[i]), n // 3, 2 * n // 3) == ((places >= n // 3) & (places < 2 * n // 3)).sum()
        k = int(rnd.integers(0, len(places)))
        assert file.occurrence(int(ids[i]), k) == places[k]
    assert file.count(top + 70_000) == 0


@pytest.mark.parametrize(("name", "spaced"), [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_pieces_give_the_tokenizers_own_ids(name, spaced):
    own, rnd = Encoder(name, spaced), np.random.default_rng(4)
    letters = list("ab Zé's\t\n \x1c  'll 12½.,!?İß語한​") + ["<|endoftext|>", "  ", " ", "é"]
    for _ in range(3000):
        text = "".join(rnd.choice(letters, rnd.integers(0, 14)))
        assert own.encode(text).tolist() == own.model.encode(text, add_special_tokens=False).ids


def test_round_trip_of_odd_rows(spark):
    df = odd_cases(spark)
    got = wavelet.read_shards(wavelet.write_shards(df, wavelet.shard_folder(spark), shard_tokens=50)).orderBy("start").collect()
    model = encoder("word_bpe_49k.json", False)
    want = sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert sorted((r["doc_id"] or -1) for r in got) == sorted((d or -1) for d, _ in want)
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    crcs = {(d, zlib.crc32(np.append(model.encode(t), 2).astype("<u4").tobytes())) for d, t in want}
    assert {(r["doc_id"], r["ids_crc32"]) for r in got} == crcs
    assert wavelet.read_shards(wavelet.write_shards(df.limit(0), wavelet.shard_folder(spark))).count() == 0
    assert tokenizer_path("word_bpe_49k.json").endswith(".json")
