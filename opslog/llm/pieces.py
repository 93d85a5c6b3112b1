"""SentencePiece byte-pair encoding by a prefix table, and decoding.

A byte-pair encoding is the one sequence of pieces whose neighbours are all compatible: two pieces
are compatible if encoding their joined text gives just these two.  So the last piece of every prefix
of a text is settled on its own: of the pieces that an automaton finds ending there, it is the one
that is compatible with the last piece of the prefix before it.  One pass fills the table of last
pieces, then the ids are read off from its end backwards.

Encoding starts anew where a space mark follows another character, where punctuation follows a letter, and
at characters that the vocabulary lacks (they become byte pieces), since no piece reaches across these
places; this is checked when the model is loaded.  So the stretches in between are encoded once per worker
and remembered.

Null is the empty text; an empty text has no ids and decodes to ''; repeated rows are encoded alike; a
very long text is taken in pieces of ``PIECE`` characters (a stretch without any white space stays whole:
eight bytes of table per character); an empty table gives no rows; clashing column names get underscores.
"""

from __future__ import annotations

import re
import string
from array import array
from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from opslog.llm.common import free_names, tokenizer_path

MODEL = "piece_bpe_32k.model"
MARK = "▁"  # fixed: stands for a space in pieces
CACHE_BYTES = 56 << 20  # of remembered stretches in one generation, two of which are kept
CACHE_PAIRS = 50_000  # of pairs in long stretches
SLOT_BITS = 21  # of the table of pairs met before, nine bytes a slot
GROUP = 16_000  # new stretches that are encoded side by side
SHORT = 64  # characters of a stretch that is encoded so; longer ones go one by one
PIECE = 1 << 20  # characters of a text that are encoded at once
BATCH_BYTES = 4 << 20  # of text in one outgoing batch
BATCH_ROWS = 500
LETTER = re.compile(r"[^\W\d_]")
LAST = float("-inf")  # no merge is left


class Recent(dict):
    """Computed values in two generations: the older one goes when the younger one is full."""

    def __init__(self, compute, limit: int, weight):
        super().__init__()
        self.compute, self.limit, self.weight = compute, limit, weight
        self.size, self.older = 0, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        self.size += self.weight(key, value)
        if self.size > self.limit:
            self.older, self.size = dict(self), 0
            self.clear()
        self[key] = value

    def put_all(self, keys: list, values: list, weight: int) -> None:
        if self.size + weight > self.limit:
            self.older, self.size = dict(self), 0
            self.clear()
        self.update(zip(keys, values))
        self.size += weight


class Pieces:
    """A vocabulary with its scores, and the encoding that follows from them."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: dict[int, int], unknown: int, normal: list[int]):
        import ahocorasick

        self.pieces, self.byte_ids, self.unknown = pieces, byte_ids, unknown
        self.ids = {pieces[i]: i for i in normal}
        self.score = {pieces[i]: scores[i] for i in normal}
        self.known = {c for p in self.ids for c in p}
        if any(MARK in p.lstrip(MARK) for p in self.ids) or any(c not in self.ids for c in self.known):
            raise ValueError("a piece has a space mark inside, or a character that is no piece")
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if len(piece) > 1:
                self.automaton.add_word(piece, i)
        self.single = np.full(0x110000, -1, np.int32)
        self.single[[ord(c) for c in self.known]] = [self.ids[c] for c in self.known]
        self.automaton.make_automaton()
        self.lengths = [len(p) for p in pieces]
        self.steps = {i: self._steps(p) for p, i in self.ids.items()}
        self.alone = {i: steps is not None for i, steps in self.steps.items()}
        self.pairs = Recent(self._compatible, CACHE_PAIRS, lambda key, value: 1)
        self.slots, self.slot_fits = np.full(1 << SLOT_BITS, -1, np.int64), np.zeros(1 << SLOT_BITS, bool)
        self.part = next(c for c in map(chr, range(0x110000)) if c not in self.known)
        self.length_of = np.array(self.lengths, np.int32)
        self.is_alone = np.array([self.alone.get(i, False) for i in range(len(pieces))])
        self.stretches = Recent(self._stretch, CACHE_BYTES, lambda text, ids: 150 + len(ids) + 2 * len(text))
        after_letter = {b for p in self.ids for a, b in zip(p, p[1:]) if LETTER.match(a)}
        cuts = "".join(re.escape(c) for c in string.punctuation if c not in after_letter)
        ahead = f"{MARK}*{LETTER.pattern}+(?=[{cuts}])|" if cuts else ""
        plain_unknown = "".join(re.escape(c) for c in map(chr, range(128)) if c not in self.known)
        unknown = f"|[{plain_unknown}]+" if plain_unknown else ""
        self.parts = re.compile(f"{ahead}{MARK}+[^{MARK}{plain_unknown}]*|[^{MARK}{plain_unknown}]+{unknown}")
        self.bytes_of = {i: b for b, i in byte_ids.items()}
        self.raw = [bytes([self.bytes_of[i]]) if i in self.bytes_of else p.encode() if p in self.ids else b"" for i, p in enumerate(pieces)]

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        byte_ids = {int(model.id_to_piece(i)[1:-1], 16): i for i in every if model.is_byte(i)}
        normal = [i for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        return cls([model.id_to_piece(i) for i in every], [model.get_score(i) for i in every], byte_ids, model.unk_id(), normal)

    def _steps(self, piece: str) -> tuple[list[float], list[str], list[str]] | None:
        """How a piece comes about: the score of each merge, and its first and last part before each of them.

        The best pair is merged, the left one of equals.  None if the piece's text ends as other pieces.
        """
        parts, score = [*piece], self.score
        scores, firsts, lasts = [], [parts[0]], [parts[-1]]
        while len(parts) > 1:
            found = [(score[x], -k) for k in range(len(parts) - 1) if (x := parts[k] + parts[k + 1]) in score]
            if not found:
                return None
            best, k = max(found)
            parts[-k : 2 - k] = [parts[-k] + parts[1 - k]]
            scores.append(best)
            firsts.append(parts[0])
            lasts.append(parts[-1])
        return [*scores, LAST], firsts, lasts

    def _compatible(self, pair: int) -> bool:
        """Whether the joined text of two pieces is encoded as these two.

        The merges inside both are done in turn, the better one first.  They are all done unless, at some
        time, the pair over the border is better than the next of the left piece (which goes first among
        equals) and no worse than the next of the right piece.
        """
        left, right = divmod(pair, len(self.pieces))
        (mine, _, lasts), (theirs, firsts, _) = self.steps[left], self.steps[right]
        i = j = 0
        while True:
            a, b = mine[i], theirs[j]
            across = self.score.get(lasts[i] + firsts[j])
            if across is not None and across > a and across >= b:
                return False
            if a == b == LAST:
                return True
            if a >= b:
                i += 1
            else:
                j += 1

    def prefix_table(self, text: str) -> list[int]:
        """For each end in a text of known characters, the last piece of the encoding up to there.

        Where no longer piece is compatible, it is the single character.
        """
        table, filled = [-1] * (len(text) + 1), 0
        alone, pairs, lengths, ids, count = self.alone, self.pairs, self.lengths, self.ids, len(self.pieces)
        for end, piece in self.automaton.iter(text):  # in order of their ends
            while filled < end:
                filled += 1
                if table[filled] < 0:
                    table[filled] = ids[text[filled - 1]]
            end += 1
            if table[end] < 0:
                n = lengths[piece]
                if alone[piece] if end == n else pairs[table[end - n] * count + piece]:
                    table[end] = piece
        for end in range(filled + 1, len(text) + 1):
            if table[end] < 0:
                table[end] = ids[text[end - 1]]
        return table

    def _known_ids(self, text: str) -> list[int]:
        table, lengths, ids, at = self.prefix_table(text), self.lengths, [], len(text)
        while at:
            piece = table[at]
            ids.append(piece)
            at -= lengths[piece]
        ids.reverse()
        return ids

    def _stretch(self, text: str) -> bytes:
        """Ids of a stretch; its unknown characters are bytes, or the unknown id in a model without bytes."""
        if self.known.issuperset(text):
            return array("i", self._known_ids(text)).tobytes()
        ids, start = [], 0
        for k, c in enumerate(text):
            if c not in self.known:
                ids += self._known_ids(text[start:k]) if k > start else []
                ids += [self.byte_ids[b] for b in c.encode()] if self.byte_ids else [self.unknown]
                start = k + 1
        ids += self._known_ids(text[start:]) if start < len(text) else []
        return array("i", ids).tobytes()

    def _fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``_compatible`` of many pairs: a table of fixed size answers those met before."""
        keys = left.astype(np.int64) * len(self.pieces) + right
        slot = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)
        fits, new = self.slot_fits[slot], np.flatnonzero(self.slots[slot] != keys)
        if len(new):
            pairs, back = np.unique(keys[new], return_inverse=True)
            fits[new] = np.fromiter(map(self._compatible, pairs.tolist()), bool, len(pairs))[back]
            self.slots[slot[new]], self.slot_fits[slot[new]] = keys[new], fits[new]
        return fits

    def _encoded(self, texts: list[str]) -> list[bytes]:
        """Ids of many short stretches of known characters, their prefix tables filled side by side."""
        joined = self.part.join(texts)
        single = self.single[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
        lengths = np.fromiter(map(len, texts), np.int32, len(texts))
        begin = np.cumsum(lengths + 1, dtype=np.int32) - lengths - 1
        found = np.fromiter(chain.from_iterable(self.automaton.iter(joined)), np.int32)
        end, piece = found[::2] + 1, found[1::2]
        first = np.repeat(begin, lengths + 1)[end - 1]
        rank = (end - first).astype(np.int16)
        order = np.argsort(rank, kind="stable")
        bounds = np.searchsorted(rank[order], np.arange(1, lengths.max() + 2))
        table = np.full(len(joined) + 1, -1, np.int32)
        word = np.arange(len(texts))
        for k, (lo, hi) in enumerate(zip(bounds, bounds[1:])):  # all prefixes of one length at a time
            now = order[lo:hi]
            p, e = piece[now], end[now]
            start = e - self.length_of[p]
            fits = self.is_alone[p]
            inner = np.flatnonzero(start > first[now])
            fits[inner] = self._fit(table[start[inner]], p[inner])
            table[e[fits]] = p[fits]
            word = word[lengths[word] > k]
            e = begin[word] + k + 1
            e = e[table[e] < 0]
            table[e] = single[e - 1]
        at, word, words, ids = begin + lengths, np.arange(len(texts)), [], []
        while len(word):  # backwards, a piece of every stretch at a time
            p = table[at]
            words.append(word)
            ids.append(p)
            at = at - self.length_of[p]
            more = at > begin[word]
            at, word = at[more], word[more]
        of = np.concatenate(words)
        order = np.lexsort((-np.repeat(np.arange(len(words)), list(map(len, words))), of))
        raw = np.concatenate(ids)[order].astype(np.int32).tobytes()
        ends = 4 * np.cumsum(np.bincount(of, minlength=len(texts)))
        return [raw[lo:hi] for lo, hi in zip([0, *ends.tolist()], ends.tolist())]

    def _learn(self, stretches: set[str]) -> None:
        """Encodes new stretches some at a time; long ones and those with unknown characters are left to ``_stretch``."""
        known, older, normal = self.stretches, self.stretches.older, self.known.issuperset
        new = [x for x in stretches if x not in known and x not in older]
        new = [x for x in new if len(x) <= SHORT and normal(x)]
        for lo in range(0, len(new), GROUP):
            group = new[lo : lo + GROUP]
            ids = self._encoded(group)
            known.put_all(group, ids, sum(map(known.weight, group, ids)))

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of texts as 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        held, size = [], 0
        for k, text in enumerate(texts):
            for part in marked(text or ""):
                held.append((k, self.parts.findall(part)))
                size += len(part)
                if size >= PIECE:
                    self._settle(held, out)
                    held, size = [], 0
        self._settle(held, out)
        return [np.frombuffer(b"".join(parts), np.int32) for parts in out]

    def _settle(self, held: list[tuple[int, list[str]]], out: list[list[bytes]]) -> None:
        self._learn(set().union(*(found for _, found in held)))
        for k, found in held:
            out[k].append(b"".join(map(self.stretches.__getitem__, found)))

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids) -> str:
        """Text of ids: marks are spaces, the first of which was added; bytes that are no character become U+FFFD."""
        try:
            text = b"".join(map(self.raw.__getitem__, ids)).decode()
        except UnicodeDecodeError:
            text = self._decode_broken(ids)
        text = text.replace(MARK, " ")
        return text[1:] if text.startswith(" ") and ids[0] not in self.bytes_of else text

    def _decode_broken(self, ids) -> str:
        out = []
        for of_bytes, run in groupby(ids, self.bytes_of.__contains__):
            raw = b"".join(map(self.raw.__getitem__, run))
            out.append(_characters(raw) if of_bytes else raw)
        return b"".join(out).decode()


def marked(text: str) -> Iterator[str]:
    """The text as the model sees it, a mark before it and for every space, cut before marks that follow other characters."""
    if not text:
        return
    text = MARK + text.replace(" ", MARK)
    at, size = 0, len(text)
    while at < size:
        end = at + PIECE
        while end < size and not (text[end] == MARK and text[end - 1] != MARK):
            end = text.find(MARK, end + 1)
            end = size if end < 0 else end
        yield text[at:end]
        at = end


def _characters(raw: bytes) -> bytes:
    """Bytes as UTF-8, each byte that belongs to no character replaced on its own."""
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + n].decode().encode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�".encode())
            at += 1
    return b"".join(out)


_MODELS: dict[str, Pieces] = {}


def model(path: str | None = None) -> Pieces:
    """The worker's vocabulary; what it remembers is bounded in bytes."""
    path = path or tokenizer_path(MODEL)
    if path not in _MODELS:
        _MODELS[path] = Pieces.load(path)
    return _MODELS[path]


def _groups(batch: pa.RecordBatch, sizes) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch, bounded in rows and in bytes."""
    lo, taken = 0, 0
    for hi in range(batch.num_rows):
        if hi > lo and (taken >= BATCH_BYTES or hi - lo >= BATCH_ROWS):
            yield lo, hi
            lo, taken = hi, 0
        taken += sizes[hi] or 0
    if lo < batch.num_rows:
        yield lo, batch.num_rows


def encode(df: DataFrame, column: str = "text", into: str = "ids", path: str | None = None) -> DataFrame:
    """``df`` with the ids of a text column as an array of ints."""
    (name,) = free_names(df.columns, into)

    def run(batches):
        pieces = model(path)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(column))
            for lo, hi in _groups(batch, pa.compute.binary_length(texts).to_pylist()):
                ids = pieces.encode_all(texts.slice(lo, hi - lo).to_pylist())
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                values = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
                part = batch.slice(lo, hi - lo)
                yield part.append_column(pa.field(name, pa.list_(pa.int32())), pa.ListArray.from_arrays(pa.array(ends), values))

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, column: str = "ids", into: str = "decoded", path: str | None = None) -> DataFrame:
    """``df`` with the text of an array of ids; null and empty arrays give ''."""
    (name,) = free_names(df.columns, into)

    def run(batches):
        pieces = model(path)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(column))
            for lo, hi in _groups(batch, pa.compute.list_value_length(ids).to_pylist()):
                texts = [pieces.decode(ids[i].values.to_pylist() if ids[i].is_valid else []) for i in range(lo, hi)]
                yield batch.slice(lo, hi - lo).append_column(name, pa.array(texts, pa.string()))

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.StringType())]))
