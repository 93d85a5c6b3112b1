"""Public tokenizers over many texts: every distinct piece of text is encoded once per task.

Both tokenizers cut a text at places that depend on nearby characters only, before they merge
anything inside a cut.  Cutting at white space (for ``byte`` with the space before a word) keeps
all of those places, so the ids of a text are the ids of its pieces in order.

For the same reason the new pieces of a text are encoded as one text, which costs the tokenizer half
of what as many short ones do.  Every token stands for a known number of bytes, so the bytes of the
pieces say which ids are whose; where they don't add up, each piece is encoded by itself.

Most words that are met once as pieces are met before under another ending: marks after a letter
or digit begin a new cut, and the word tokenizer takes no notice of case.  So a piece's word without
them is remembered too, and a piece made of a known word and known marks needs no tokenizer.

A new word of letters alone is one cut, so that the tokenizer's own merges (``Tokenizer.model``) give its
ids for half the time, without normalizing and searching for cuts.  They are used once ``PROOF`` such
words had the tokenizer's ids; with a file for which one hasn't, never.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np

from opslog.llm.common import held, tokenizer_path

CACHE_PIECES = 1_400_000  # in two generations: pieces met in the younger one's time outlive the older one

# Fixed: the white space of Unicode, without the four separators that Python adds to it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = re.compile(f"[^{SPACE}]+")
PIECES = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")
ODD = ("\x1c", "\x1d", "\x1e", "\x1f")
# Pieces whose normal form has the bytes of their lower case.
PLAIN = re.compile(r"[!-~\xc0-\xff]+")
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# What a word may end in before the marks after it.
ENDS = frozenset(c for c in map(chr, range(256)) if re.fullmatch(r"[A-Za-z0-9\xc0-\xd6\xd8-\xf6\xf8-\xff]", c))
LETTERS = re.compile(r" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
PROOF = 2000
# The tokenizers' characters for the bytes of those.
_MOVED = {b: chr(256 + k) for k, b in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])}
BYTES = {c: "".join(_MOVED.get(b, chr(b)) for b in c.encode()) for c in map(chr, range(256)) if LETTERS.fullmatch(c + "a")}
TOGETHER = 8000  # characters of texts whose new pieces go to the tokenizer at once


class Encoder:
    """``encode(text)`` gives little-endian 32-bit ids as an array; null is the empty text.

    ``remembered`` pieces at most are kept (``CACHE_PIECES`` if not given); the ids don't depend on it.
    """

    def __init__(self, name: str, spaced: bool, remembered: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(tokenizer_path(name))
        self.spaced = spaced
        self.remembered = remembered or CACHE_PIECES
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.proven = 0  # words of letters whose merges were the tokenizer's ids; below 0: not all
        self.merges = self.model.model.tokenize
        vocabulary, ending = self.model.get_vocab(), self.model.model.end_of_word_suffix or ""
        self.packed = {i: struct.pack("<I", i) for i in vocabulary.values()}
        self.widths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.widths[i] = len(token.removesuffix(ending))

    def pieces(self, text: str) -> list[str]:
        if self.spaced:
            return PIECES.findall(text)
        return WORDS.findall(text) if any(c in text for c in ODD) else text.split()

    def encode(self, text: str | None) -> np.ndarray:
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """``encode`` of each text."""
        group: list[str | None] = []
        size = 0
        for text in texts:
            group.append(text)
            size += len(text or "")
            if size >= TOGETHER:
                yield from self._encode_group(group)
                group, size = [], 0
        yield from self._encode_group(group)

    def _encode_group(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        # The tokenizer cuts out special ones first.
        cut = [None if any(s in text for s in self.special) else self.pieces(text) for text in (t or "" for t in texts)]
        met = set().union(*(pieces for pieces in cut if pieces))
        new = met.difference(self.known)
        if new:
            if len(self.known) + len(new) > self.remembered // 2:
                self.known, self.older = {}, self.known
                new = met
            old = [p for p in new if p in self.older]
            self.known.update((p, self.older[p]) for p in old)
            if len(old) < len(new):
                self._learn(list(new.difference(old)))
        for text, pieces in zip(texts, cut):
            if pieces is None:
                yield np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4")
            else:
                yield np.frombuffer(b"".join(map(self.known.__getitem__, pieces)), "<u4")

    def _word(self, piece: str) -> tuple[str, str]:
        """A piece's word, by which it is remembered, and the marks after it."""
        word, marks = piece, ""
        if piece[-1] in MARKS:
            end = len(piece.rstrip(MARKS))
            if end and piece[end - 1] in ENDS:
                word, marks = piece[:end], piece[end:]
        return (word.lower() if not self.spaced and PLAIN.fullmatch(word) else word), marks

    def _learn(self, new: list[str]) -> None:
        """Ids of pieces that are not known yet."""
        known, older = self.known, self.older
        asked: list[tuple[str, str, str]] = []
        coming: set[str] = set()  # words and marks of the pieces that the tokenizer gets
        rest: list[tuple[str, str, str]] = []
        proven = self.proven >= PROOF
        for p in new:
            if proven and self.spaced and LETTERS.fullmatch(p):
                known[p] = self._merged(p)
                continue
            word, marks = (p, "") if self.spaced and p[-1] not in MARKS else self._word(p)
            ids = None if word == p else known.get(word) or older.get(word)
            if ids is None and proven and LETTERS.fullmatch(word):
                ids = self._merged(word)
            if ids is not None:
                known[word] = ids
            tail = known.get(marks) or older.get(marks) if marks else b""
            if ids is not None and tail is not None:
                known[p] = ids + tail
            elif (ids is not None or word in coming) and (tail is not None or marks in coming):
                rest.append((p, word, marks))
            else:
                asked.append((p, word, marks))
                coming.update((word, marks) if marks else (word,))
        if asked:
            self._ask(asked)
            if 0 <= self.proven < PROOF:
                words = {word for _, word, _ in asked if LETTERS.fullmatch(word)}
                self.proven = self.proven + len(words) if all(self._merged(w) == known[w] for w in words) else -1
        for p, word, marks in rest:
            known[p] = known[word] + (known.get(marks) or older[marks]) if marks else known[word]

    def _merged(self, word: str) -> bytes:
        """Ids of a word of letters by the merges alone."""
        if not word.isascii():
            word = "".join([BYTES[c] for c in word])
        elif word[0] == " ":
            word = BYTES[" "] + word[1:]
        return b"".join([self.packed[t.id] for t in self.merges(word)])

    def _ask(self, asked: list[tuple[str, str, str]]) -> None:
        """Ids of pieces, of their words and of the marks after them, by the tokenizer."""
        if self.spaced:
            together = [a for a in asked if not a[0].isspace()]
            marked = [p if p[0] == " " else "\n" + p for p, _, _ in together]
            text, plain = "".join(marked), marked
        else:
            together = [a for a in asked if PLAIN.fullmatch(a[0])]
            marked = [p for p, _, _ in together]
            text, plain = " ".join(marked), [word + marks for _, word, marks in together]
        sizes = [len(p) if p.isascii() else len(p.encode("utf-8", "replace")) for p in plain]
        if together and self._cut(together, text, sizes):
            asked = [a for a in asked if a[0] not in self.known]
        for (p, word, marks), e in zip(asked, self.model.encode_batch_fast([p for p, _, _ in asked], add_special_tokens=False) if asked else ()):
            self.known[p] = np.array(e.ids, "<u4").tobytes()
            for part in (word, marks):
                if part and part not in self.known:
                    self.known[part] = np.array(self.model.encode(part, add_special_tokens=False).ids, "<u4").tobytes()

    def _cut(self, asked: list[tuple[str, str, str]], text: str, sizes: list[int]) -> bool:
        """Ids of the pieces that ``text`` is made of; false if the bytes of its tokens don't end where the pieces do."""
        ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends, places = np.cumsum(sizes), np.cumsum(self.widths[ids])
        words = ends - np.array([len(marks) for _, _, marks in asked])
        last, middle = np.searchsorted(places, ends), np.searchsorted(places, words)
        if not len(ids) or places[-1] != ends[-1] or not np.array_equal(places[last], ends) or not np.array_equal(places[middle], words):
            return False
        data, lo, known = ids.tobytes(), 0, self.known
        for (p, word, marks), mid, hi in zip(asked, (4 * middle + 4).tolist(), (4 * last + 4).tolist()):
            lo += 4 * (self.spaced and p[0] != " ")
            known[p] = data[lo:hi]
            if marks:
                known[word], known[marks] = data[lo:mid], data[mid:hi]
            elif word != p:
                known[word] = known[p]
            lo = hi
        return True


def encoder(name: str, spaced: bool, remembered: int | None = None) -> Encoder:
    """The worker process's encoder: its pieces are kept from task to task."""
    return held(("encoder", name, spaced, remembered), lambda: Encoder(name, spaced, remembered))
