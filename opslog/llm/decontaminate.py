"""Benchmark items in documents: CGK embedding, bit-sampling LSH over windows, exact edit check.

The CGK random walk (Chakraborty, Goldenberg, Koucky) reads a word, writes it, and moves on or
stays by a random bit of (step, word).  Two windows that differ by a few inserted, deleted or changed words
soon walk in step again, so edit distance becomes Hamming distance, and sampling a few steps of
the walk is a locality-sensitive hash of the edit distance.

Windows have the size of the item, rounded down to a class; a walk of as many steps never leaves
the window.  Documents are hashed at every ``STRIDE``-th word (for the shortest items at every word), items at every offset of that
stride and at several places, so one of them meets the grid.  Several walks with several samples
each find most; an item with edits all over may have no sample without one, near the border of a class above all.
Beside them the item is cut into one piece more than the edits it may have: whatever they are, one
piece stands in the document unchanged, and its hash, at every word, finds the place.  Every candidate is checked by the exact edit distance of the whole item to
the best stretch of the document around it (Myers' bit vectors over words).

Items are few against documents: they are taken in blocks of bounded size, each block meets all
documents, nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import CACHE_WORDS, keep_rows, mix, strings

CLASSES = (4, 8, 16, 32)  # window sizes in words
SAMPLES = {4: 4, 8: 5, 16: 6, 32: 6}  # steps in a sample
WALKS, BANDS = 3, 3
STRIDE = 4
PLACES = 8
PIECE = 6  # words of a piece that are hashed, at most
PIECES = -1  # stands for a walk where tables of pieces are meant
RATE = 0.2  # edits a word of the item
BLOCK_ITEMS, BLOCK_BYTES = 4_000, 16_000_000
EDGE = "\"'`.,;:!?()[]{}<>*#%&$|~-_/\\«»“”„…"
SPAN = 1 << 17  # words hashed at once: what a walk touches stays in the processor's cache

RESULT = "doc_id bigint, item_id bigint, n_words int, edits int, start_word int"


class Words(dict):
    """Hash of a word without its case and the marks at its ends; 0 for marks alone."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        plain = word.lower().strip(EDGE)
        value = self[word] = (xxhash.xxh3_64_intdigest(plain.encode("utf-8", "replace")) | 1) if plain else 0
        return value

    def of(self, text: str | None) -> np.ndarray:
        words = text.split() if text else []
        x = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        return x[x != 0]


def _plans(seed: int) -> list[list[tuple[int, list[int]]]]:
    """For each walk the samples: (class, steps), one step from every equal part of the walk."""
    rnd = np.random.default_rng(seed)

    def steps(size: int) -> list[int]:
        cuts = np.linspace(0, size, SAMPLES[size] + 1).astype(int)
        return [int(rnd.integers(a, b)) for a, b in zip(cuts, cuts[1:])]

    return [[(c, steps(c)) for c in CLASSES for _ in range(BANDS)] for _ in range(WALKS)]


PLANS = _plans(7)


def keys(words: np.ndarray, starts: np.ndarray, walk: int, classes: set[int]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(sample number, class, key of every start) of one walk; ``words`` holds a window after each start."""
    symbols = mix(words + np.uint64((walk + 1) * 0x9E3779B97F4A7C15 % 2**64))
    # A word holds the walk for two steps at most: else one frequent word could be the whole sample.
    moves = symbols | (~symbols << np.uint64(1) & ~symbols << np.uint64(2))
    wanted = [(b, c, steps) for b, (c, steps) in enumerate(PLANS[walk]) if c in classes]
    held = [np.full(len(starts), np.uint64(b + 1)) for b, _, _ in wanted]
    at = starts.copy()
    for step in range(max(classes)):
        now = symbols[at]
        for key, (_, _, steps) in zip(held, wanted):
            if step in steps:
                key *= np.uint64(0xD6E8FEB86659FD93)
                key ^= now
                key ^= key >> np.uint64(29)
        at += ((moves[at] >> np.uint64(step)) & np.uint64(1)).astype(at.dtype)
    for key, (b, c, _) in zip(held, wanted):
        yield b, c, key


def _class_of(n: int) -> int:
    """Largest class of which ``STRIDE`` windows in a row fit; the smallest is hashed at every word and needs one."""
    return max((c for c in CLASSES if c + (STRIDE - 1) * (c > CLASSES[0]) <= n), default=0)


def pieces_of(n: int, rate: float) -> list[tuple[int, int]]:
    """(first word, words) of one piece more than an item of ``n`` words may have edits; one of them has none."""
    cuts = np.linspace(0, n, min(n, int(rate * n) + 1) + 1).astype(int).tolist()
    return [(a, min(PIECE, b - a)) for a, b in zip(cuts, cuts[1:])]


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Key of the ``size`` words from every word on."""
    many = max(0, len(words) - size + 1)
    key = np.full(many, np.uint64(size))
    for k in range(size):
        key *= np.uint64(0xD6E8FEB86659FD93)
        key += words[k : k + many]
    return mix(key)


class ItemIndex:
    """Keys of a block of items, by walk and sample and by length of pieces; small enough to travel with the task."""

    def __init__(self, items: list[tuple[int, str | None]], rate: float = RATE):
        words = Words()
        self.items = [(i, w) for i, w in ((i, words.of(t)) for i, t in items) if len(w) >= CLASSES[0]]
        self.classes = {_class_of(len(w)) for _, w in self.items}
        entries: dict[tuple[int, int], list[np.ndarray]] = {}
        for n, (_, w) in enumerate(self.items):
            c = _class_of(len(w))
            last = len(w) - c
            offsets = sorted({min(last, int(p) + k) for p in np.linspace(0, max(0, last - STRIDE + 1), PLACES) for k in range(STRIDE)})
            padded = np.concatenate([w, np.zeros(max(CLASSES), np.uint64)])
            starts = np.array(offsets, np.int32)
            for walk in range(WALKS):
                for b, kind, key in keys(padded, starts, walk, {c}):
                    entries.setdefault((walk, b), []).append(np.stack([key, np.full(len(key), n, np.uint64), starts.astype(np.uint64)]))
            for first, size in pieces_of(len(w), rate):
                key = grams(w[first : first + size], size)
                entries.setdefault((PIECES, size), []).append(np.stack([key, np.array([n], np.uint64), np.array([first], np.uint64)]))
        self.sizes = sorted(size for walk, size in entries if walk == PIECES)
        self.tables = {}
        for where, parts in entries.items():
            self.tables[where] = np.unique(np.concatenate(parts, axis=1), axis=1)

    def maps(self) -> dict:
        """For each table how far to shift a key, and which shifted keys it has: one in 32 at most."""
        out = {}
        for where, table in self.tables.items():
            shift = np.uint64(64 - min(24, max(16, table.shape[1].bit_length() + 5)))
            bits = np.zeros(1 << (64 - int(shift)), bool)
            bits[table[0] >> shift] = True
            out[where] = shift, bits
        return out


def edit_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edits that turn the item into a stretch of the text, and where that stretch ends."""
    n = len(item)
    places: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        places[w] = places.get(w, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score, best = full, 0, n, (n, 0)
    for j, w in enumerate(text.tolist()):
        eq = places.get(w, 0)
        d0 = (((eq & plus) + plus) ^ plus) | eq | minus
        hp, hn = minus | (full & ~(d0 | plus)), d0 & plus
        score += bool(hp & top) - bool(hn & top)
        hp, hn = (hp << 1) & full, (hn << 1) & full
        plus, minus = hn | (full & ~(d0 | hp)), d0 & hp
        if score < best[0]:
            best = (score, j + 1)
    return best


def _scan(index: ItemIndex, rate: float):
    def run(batches):
        words, maps = Words(), index.maps()
        pad = np.zeros(max(index.classes), np.uint64)

        def matches(docs: list, parts: list[np.ndarray]):
            text = np.concatenate([x for w in parts for x in (w, pad)])
            begin = np.cumsum([0, *(len(w) + len(pad) for w in parts)])
            found: set[tuple[int, int, int]] = set()

            def look(walk: int, b: int, key: np.ndarray, starts: np.ndarray | None) -> None:
                table = index.tables.get((walk, b))
                if table is None:
                    return
                shift, bits = maps[walk, b]
                some = np.flatnonzero(bits[key >> shift])
                lo, hi = (np.searchsorted(table[0], key[some], side=s) for s in ("left", "right"))
                places = some[hi > lo] if starts is None else starts[some[hi > lo]]
                for at, x, y in zip(places.tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                    doc = int(np.searchsorted(begin, at, side="right")) - 1
                    for n, offset in table[1:, x:y].T.tolist():
                        found.add((doc, n, (at - int(begin[doc]) - offset) // STRIDE))

            small, large = index.classes & {CLASSES[0]}, index.classes - {CLASSES[0]}
            for walk, classes in [(walk, c) for walk in range(WALKS) for c in (small, large) if c]:
                stride = 1 if classes is small else STRIDE
                starts = np.concatenate([np.arange(b, b + len(w), stride, dtype=np.int32) for b, w in zip(begin, parts)])
                for b, _, key in keys(text, starts, walk, classes):
                    look(walk, b, key, starts)
            for size in index.sizes:
                look(PIECES, size, grams(text, size), None)
            best: dict[tuple[int, int], tuple[int, int]] = {}
            for doc, n, at in sorted(found):
                item = index.items[n][1]
                slack = int(rate * len(item)) + STRIDE
                lo = max(0, at * STRIDE - slack)
                edits, end = edit_distance(item, parts[doc][lo : at * STRIDE + len(item) + slack + STRIDE])
                if edits <= rate * len(item):
                    best[doc, n] = min(best.get((doc, n), (edits, lo + end)), (edits, lo + end))
            rows = [(docs[d], index.items[n][0], len(index.items[n][1]), e, max(0, end - len(index.items[n][1]))) for (d, n), (e, end) in best.items()]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            names = [c.split()[0] for c in RESULT.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

        for batch in batches:
            docs, parts, held = [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), strings(batch, "text")):
                w = words.of(text)
                if len(w) >= CLASSES[0]:
                    docs.append(doc)
                    parts.append(w)
                    held += len(w) + len(pad)
                if held >= SPAN:
                    yield matches(docs, parts)
                    docs, parts, held = [], [], 0
            if docs:
                yield matches(docs, parts)

    return run


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, str | None]]]:
    block, held = [], 0
    for row in items.toLocalIterator():
        block.append((row["item_id"], row["text"]))
        held += len(row["text"] or "")
        if len(block) >= BLOCK_ITEMS or held >= BLOCK_BYTES:
            yield block
            block, held = [], 0
    if block:
        yield block


def contaminated(documents: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """Items found in documents: doc_id, item_id, n_words (of the item), edits, start_word.

    A row says that the item is at most ``rate`` edits a word (words inserted, deleted or changed;
    case and marks at word ends don't count) from a stretch of the document; the best stretch of
    each document and item counts.  Items under four words prove nothing and are left out; null or
    empty texts have no rows; repeated items and documents have a row each.
    """
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    parts = []
    for block in _blocks(items):
        index = ItemIndex(block, rate)
        if index.items:
            parts.append(docs.mapInArrow(_scan(index, rate), RESULT))
    return reduce(DataFrame.unionAll, parts) if parts else documents.sparkSession.createDataFrame([], RESULT)


def _clean(index: ItemIndex, rate: float):
    def choose():
        scan = _scan(index, rate)

        def clean(texts: list[str | None]) -> np.ndarray:
            rows = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
            keep = np.ones(len(texts), bool)
            for found in scan([rows]):
                keep[found.column(0).to_numpy()] = False
            return keep

        return clean

    return choose


def without_contaminated(documents: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """``documents`` without the rows that hold an item; no row moves."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    for block in _blocks(items):
        index = ItemIndex(block, rate)
        if index.items:
            documents = keep_rows(documents, _clean(index, rate))
    return documents
