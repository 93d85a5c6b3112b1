"""Exact BM25 top-k by block-max WAND over index segments.

Each task turns its rows into segments (one row each): sorted terms, postings in document order, and for every
block of postings the largest frequency and the shortest document.  Document counts and the average
length are sums over all segments, so that every segment scores with the statistics of the whole table and
the best of each segment merge into the exact best of all.  A query walks its lists in document order
and skips a document, or all documents up to the next block border, where the sum of the
bounds cannot reach the k-th best score.  Queries of over ``SHORT`` terms, as whole texts are, are taken many at a
time, like ones together: the postings of rare terms are added up, and a block of documents whose best sum, with the bounds of
the block for the frequent terms, cannot reach the k-th best score of any of these queries is done with.  For the other
blocks the frequent terms are added by one product of matrices in single precision, and what may be among the best
within its error is scored again exactly.  Documents of a segment are in order of likeness and length, so that blocks
have tight bounds.  One segment in ``LEADS`` is searched first, and the k-th best scores found there are where all the
others start; the k-th best score of the segments a task has done is where its next one starts.
"""

from __future__ import annotations

import heapq
import itertools
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opslog.llm.common import WordHash, give_back, saved, strings, tidy

K, K1, B = 10, 1.2, 0.75
SHORT, WALKING = 12, 16  # terms and queries up to which queries walk their lists
OFTEN = 400  # adding a posting takes the time of so many cells of a product of matrices
CELLS = 5_000_000  # terms times documents, or queries times documents, held at once
POSTINGS, SUMS = 16_384, 8  # postings added up at once, and queries
DOCS_BLOCK = 64
QUERIES_AT_ONCE = 256
LIKE, LIKE_TERMS, LIKE_ROUNDS = 16, 128, 5  # kinds of like texts, told apart by so many frequent terms
LEADS = 16  # of so many segments one is searched first
ROUNDING = 2.0**-22  # a term: twice what two single-precision sums can differ by
POSTINGS_BLOCK = 64
SEGMENT_WORDS = 4_000_000
QUERY_BLOCK, BLOCK_TERMS = 16_384, 2_500_000
NO_ID = -(2**63)
MARKS = rb"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""
PLAIN = bytes(32 if i in MARKS else i for i in range(256)).lower()

INDEX = "docs binary, lengths binary, terms binary, starts binary, post_doc binary, post_tf binary, block_tf binary, block_len binary"
NAMES = [c.split()[0] for c in INDEX.split(", ")]
FOUND = "query_id bigint, doc_id bigint, score double"


def terms_of(text: str | None, words: WordHash) -> np.ndarray:
    """Hashed words; case of A-Z and ASCII marks don't count."""
    return words.array(text.encode("utf-8", "replace").translate(PLAIN).split()) if text else np.zeros(0, np.uint64)


def _kinds(owner: np.ndarray, term: np.ndarray, size: int) -> np.ndarray:
    """A number for each of ``size`` texts, the same for texts that share frequent terms: rounds of k-means on their directions."""
    many = np.bincount(term)
    top = np.argsort(-many, kind="stable")[:LIKE_TERMS]
    column = np.full(len(many), -1, np.int32)
    column[top] = np.arange(len(top))
    held = np.zeros((size, len(top)), np.float32)
    column = column[term]
    known = np.flatnonzero(column >= 0)
    held[owner[known], column[known]] = 1
    held /= np.sqrt(np.maximum(1, held.sum(axis=1, keepdims=True)))
    middles = held[np.arange(LIKE) * size // LIKE]
    for _ in range(LIKE_ROUNDS):
        kind = np.argmax(held @ middles.T, axis=1)
        middles = np.stack([held[kind == i].sum(axis=0) for i in range(LIKE)])
        middles /= np.maximum(1e-9, np.sqrt((middles**2).sum(axis=1, keepdims=True)))
    return kind


def _numbered(term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different hashes in order, and the place of each given one among them: near where its first bits say."""
    known = np.sort(term)
    known = known[np.append(True, known[1:] != known[:-1])[: len(known)]]
    shift = np.uint64(64 - max(1, len(known).bit_length()))
    many = np.bincount((known >> shift).astype(np.intp), minlength=2 << int(63 - shift))
    if many.max() > 64:
        return known, np.searchsorted(known, term).astype(np.int32)
    place = (np.cumsum(many) - many).astype(np.int32)[(term >> shift).astype(np.intp)]
    off = np.flatnonzero(known[place] != term)
    while len(off):
        place[off] += 1
        off = off[known[place[off]] != term[off]]
    return known, place


def _narrow(values: np.ndarray) -> np.ndarray:
    """The values in as few bytes as they all fit in."""
    most = int(values.max(initial=0))
    return values.astype(next(kind for kind in (np.uint8, np.uint16, np.int32) if most <= np.iinfo(kind).max))


def _segment(ids: list[int | None], texts: list[np.ndarray]) -> dict:
    lengths = np.array([len(t) for t in texts], np.int32)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    terms, number = _numbered(np.concatenate([np.zeros(0, np.uint64), *texts]))
    if len(terms):
        # Like documents side by side, short ones before long ones.
        line = np.lexsort((lengths, _kinds(doc, number, len(texts))))
        place = np.empty(len(line), np.int32)
        place[line] = np.arange(len(line), dtype=np.int32)
        ids, lengths, doc = [ids[i] for i in line], lengths[line], place[doc]
    bits = len(texts).bit_length()
    post = np.sort((number.astype(np.uint64) << np.uint64(bits)) | doc.astype(np.uint64))
    at = np.flatnonzero(np.append(True, post[1:] != post[:-1])[: len(post)])
    tf = np.diff(np.append(at, len(post))).astype(np.int32)
    post = post[at]
    doc = (post & np.uint64((1 << bits) - 1)).astype(np.int32)
    starts = np.append(0, np.cumsum(np.bincount((post >> np.uint64(bits)).astype(np.intp), minlength=len(terms)))).astype(np.int64)
    # A block never holds postings of two terms.
    blocks = -(-np.diff(starts) // POSTINGS_BLOCK)
    first = np.cumsum(blocks) - blocks
    cuts = np.repeat(starts[:-1], blocks) + POSTINGS_BLOCK * (np.arange(int(blocks.sum())) - np.repeat(first, blocks))
    rows = {
        "docs": np.array([NO_ID if i is None else i for i in ids], np.int64), "lengths": lengths, "terms": terms, "starts": starts,
        "post_doc": _narrow(doc), "post_tf": _narrow(tf), "block_tf": _narrow(np.maximum.reduceat(tf, cuts) if len(cuts) else tf),
        "block_len": _narrow(np.minimum.reduceat(lengths[doc], cuts) if len(cuts) else tf),
    }
    return {k: v.tobytes() for k, v in rows.items()}


def _build(segment_words: int):
    def run(batches):
        words, ids, texts, held = WordHash(), [], [], 0
        number = itertools.count(TaskContext.get().partitionId())

        def close():
            row = _segment(ids, texts) | {"lead": next(number) % LEADS == 0}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([*((n, pa.binary()) for n in NAMES), ("lead", pa.bool_())]))

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), strings(batch, "text")):
                t = terms_of(text, words)
                ids.append(doc)
                texts.append(t)
                held += len(t)
                if held >= segment_words:
                    yield close()
                    ids, texts, held = [], [], 0
        if ids:
            yield close()

    return tidy(run)


class Segment:
    """One row of the index with the statistics of the whole table."""

    KINDS = dict(zip(NAMES[:4], (np.int64, np.int32, np.uint64, np.int64)))
    NARROW = {1: np.uint8, 2: np.uint16, 4: np.int32}

    def __init__(self, row: dict, average: float):
        for name, kind in self.KINDS.items():
            setattr(self, name, np.require(np.frombuffer(row[name], kind), requirements="A"))
        self.average = average or 1.0
        self.block_at = np.append(0, np.cumsum(-(-np.diff(self.starts) // POSTINGS_BLOCK)))
        for name in NAMES[4:]:
            many = self.starts[-1] if name.startswith("post") else self.block_at[-1]
            kind = self.NARROW[len(row[name]) // many if many else 4]
            setattr(self, name, np.require(np.frombuffer(row[name], kind), requirements="A"))

    def part(self, tf, length):
        """Share of a term's weight that a frequency in a document of some length earns."""
        return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / self.average))

    def best(self, terms: list[tuple[int, float]], k: int, bar: float = 0.0) -> list[tuple[float, int]]:
        """(score, doc_id) of the best documents of the segment, of those that reach the bar: block-max WAND."""
        lists = []
        for order, (term, weight) in enumerate(terms):
            i = int(np.searchsorted(self.terms, np.uint64(term)))
            if i == len(self.terms) or self.terms[i] != term:
                continue
            a, b = self.starts[i], self.starts[i + 1]
            docs = self.post_doc[a:b].tolist()
            p, q = self.block_at[i], self.block_at[i + 1]
            bounds = (weight * self.part(self.block_tf[p:q], self.block_len[p:q])).tolist()
            lists.append([docs[0], 0, docs, (weight * self.part(self.post_tf[a:b], self.lengths[self.post_doc[a:b]])).tolist(), bounds, max(bounds), order])
        heap: list[tuple[float, int, int]] = []  # the worst of the best is on top: low score, then high id
        done = 1 << 60
        slack = 1 + 1e-12  # sums of bounds and sums of scores round apart

        def go(entry, to: int) -> None:
            entry[1] = bisect_left(entry[2], to, entry[1])
            entry[0] = entry[2][entry[1]] if entry[1] < len(entry[2]) else done

        while lists:
            lists.sort(key=lambda e: e[0])
            while lists and lists[-1][0] == done:
                lists.pop()
            least = max(bar, heap[0][0]) if len(heap) == k else bar or -1.0
            total, pivot = 0.0, -1
            for j, e in enumerate(lists):
                total += e[5]
                if total * slack >= least:
                    pivot = j
                    break
            if pivot < 0:
                break
            doc = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == doc:
                pivot += 1
            total, border = 0.0, done
            for e in lists[: pivot + 1]:
                at = bisect_left(e[2], doc, e[1])
                if at < len(e[2]):
                    block = at // POSTINGS_BLOCK
                    total += e[4][block]
                    border = min(border, e[2][min(len(e[2]), (block + 1) * POSTINGS_BLOCK) - 1] + 1)
            if total * slack < least:
                # No document up to the first block's end can do: go on there, or at the next list.
                to = min(border, lists[pivot + 1][0] if pivot + 1 < len(lists) else done)
                for e in lists[: pivot + 1]:
                    go(e, max(to, doc + 1))
                continue
            if lists[0][0] == doc:
                here = [e for e in lists[: pivot + 1] if e[0] == doc]
                score = 0.0
                for e in sorted(here, key=lambda e: e[6]):
                    score += e[3][e[1]]
                item = (score, -int(self.docs[doc]), doc)
                if len(heap) < k:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)
                for e in here:
                    go(e, doc + 1)
            else:
                for e in lists[:pivot]:
                    if e[0] < doc:
                        go(e, doc)
        return [(s, -d) for s, d, _ in heap]

    def prepare(self, asked: Asked) -> None:
        """What many queries need: every posting's share of a score, in order of terms and of documents."""
        self.times, self.many = np.diff(self.starts), len(self.docs)
        place = np.minimum(np.searchsorted(self.terms, asked.terms), len(self.terms) - 1)
        here = self.terms[place] == asked.terms
        self.place = np.where(here, place, -1)
        self.weight = np.zeros(len(self.terms))
        self.weight[place[here]] = asked.weights[here]
        # A document and its share side by side, so that one look finds both.
        post_term = np.repeat(np.arange(len(self.terms), dtype=np.int32), self.times)
        pairs = np.empty((len(post_term), 2), np.int32)
        pairs[:, 0] = self.post_doc
        self.pairs, self.cell, self.share = pairs.view(np.int64)[:, 0], pairs[:, 0], pairs[:, 1].view(np.float32)
        for lo in range(0, len(pairs), POSTINGS):
            some = slice(lo, lo + POSTINGS)
            self.share[some] = self.weight[post_term[some]] * self.part(self.post_tf[some], self.lengths[self.post_doc[some]])
        order = np.argsort(self.post_doc, kind="stable")
        self.own_term, self.own_tf = post_term[order], self.post_tf[order]
        self.own_at = np.append(0, np.cumsum(np.bincount(self.post_doc, minlength=self.many)))
        self.asked = np.zeros(len(self.terms), np.int8)

    def best_of_many(self, asked: Asked, k: int, bars: np.ndarray) -> Iterator[tuple[int, list[tuple[float, int]]]]:
        """As ``best`` for each query of ``asked.places`` whose bar any document may reach, with the query's number."""
        if not len(self.terms):
            return
        self.prepare(asked)
        step = max(1, min(QUERIES_AT_ONCE, CELLS // self.many))
        for lo, hi in asked.kinds:
            for first in range(lo, hi, step):
                yield from self._best_of_some(asked, first, min(hi, first + step), k, bars)

    def _best_of_some(self, asked: Asked, lo: int, hi: int, k: int, bars: np.ndarray) -> Iterator[tuple[int, list[tuple[float, int]]]]:
        size = hi - lo
        term = self.place[asked.places[asked.at[lo] : asked.at[hi]]]
        owner = np.repeat(np.arange(size), np.diff(asked.at[lo : hi + 1]))
        term, owner = term[term >= 0], owner[term >= 0]
        ends = np.append(0, np.cumsum(np.bincount(owner, minlength=size)))
        # Frequent terms: those whose postings would take longer, for all these queries, than a row of a matrix.
        shared = np.bincount(term, minlength=len(self.terms)) * self.times
        often = np.flatnonzero(shared * OFTEN >= size * self.many)
        if len(often) * self.many > CELLS:
            often = np.sort(often[np.argsort(-shared[often], kind="stable")[: CELLS // self.many]])
        row = np.full(len(self.terms), -1)
        row[often] = np.arange(len(often))
        row = row[term]
        wanted = np.bincount(owner[row >= 0] * len(often) + row[row >= 0], minlength=size * len(often)).reshape(size, -1).astype(np.float32)
        dense = np.zeros((len(often), self.many), np.float32)
        for line, a, b in zip(dense, self.starts[often].tolist(), self.starts[often + 1].tolist()):
            line[self.cell[a:b]] = self.share[a:b]
        # With the block bounds of the frequent terms, blocks that reach no query's bar are done with.
        scores = self._rare(term[row < 0], owner[row < 0], size)
        slack = 1 + ROUNDING * (np.diff(ends) + 16)
        least = np.nextafter((bars[lo:hi] / slack).astype(np.float32), np.float32(0))
        blocks = np.arange(0, self.many, DOCS_BLOCK)
        bounds = np.maximum.reduceat(scores, blocks, axis=1) + wanted @ np.maximum.reduceat(dense, blocks, axis=1)
        may = bounds * slack[:, None] >= least[:, None]
        for a, b in _runs(may.any(axis=0)):
            a, b = a * DOCS_BLOCK, min(self.many, b * DOCS_BLOCK)
            scores[:, a:b] += wanted @ dense[:, a:b]
        for q in np.flatnonzero(may.any(axis=1)).tolist():
            mine = scores[q]
            some = np.flatnonzero(mine >= max(least[q], np.float32(1e-30)))
            if len(some) > k:
                near = mine[some]
                some = some[near * slack[q] >= np.partition(near, -k)[-k] / slack[q]]
            if len(some):
                yield lo + q, self._exact(some, term[ends[q] : ends[q + 1]], k)

    def _rare(self, term: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
        """Sums of the terms' postings for each query and document, a few queries at a time."""
        scores = np.zeros((size, self.many), np.float32)
        ends = np.append(0, np.cumsum(np.bincount(owner, minlength=size)))
        times = self.times[term]
        done = np.append(0, np.cumsum(times))
        shift, steps = self.starts[term] - done[:-1], done[ends]
        q = 0
        while q < size:
            to = min(max(q + 1, int(np.searchsorted(steps, steps[q] + POSTINGS, side="right")) - 1), q + SUMS)
            if steps[to] > steps[q]:
                mine = slice(ends[q], ends[to])
                at = np.repeat(shift[mine], times[mine])
                at += np.arange(steps[q], steps[to])
                pairs = self.pairs.take(at)
                if to > q + 1:
                    pairs += np.repeat((owner[mine] - q) * self.many, times[mine])
                pairs = pairs.view(np.int32)
                scores[q:to] = np.bincount(pairs[::2], pairs[1::2].view(np.float32), (to - q) * self.many).reshape(to - q, self.many)
            q = to
        return scores

    def _exact(self, some: np.ndarray, terms: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The best of some documents; each sum is in order of terms in every segment, so that equal texts have equal scores."""
        at, times = _ranges(self.own_at[some], self.own_at[some + 1])
        np.add.at(self.asked, terms, 1)
        known = self.asked[self.own_term[at]]
        self.asked[terms] = 0
        doc, at = np.repeat(np.arange(len(some)), times)[known > 0], at[known > 0]
        shares = self.weight[self.own_term[at]] * self.part(self.own_tf[at], self.lengths[some[doc]])
        total = np.bincount(doc, shares * known[known > 0], len(some))
        ids = self.docs[some]
        return [(float(total[j]), int(ids[j])) for j in np.lexsort((ids, -total))[:k] if total[j] > 0]


class Asked:
    """Queries as they go to the tasks: in order of likeness and length, with places in one list of terms.

    A few short ones alone are left to walk their lists, which takes no preparation.  A word that a short query
    names twice, as where its row is repeated, counts twice.
    """

    def __init__(self, queries: list[tuple[int, np.ndarray, np.ndarray]]):
        """``queries``: id, hashed terms and weights; a term has one weight in all of them."""
        walking = len(queries) <= WALKING and all(len(q[1]) <= SHORT for q in queries)
        self.walking, queries = (queries, []) if walking else ([], queries)
        empty = np.zeros(0)
        self.terms, first, places = np.unique(np.concatenate([empty.astype(np.uint64), *(q[1] for q in queries)]), return_index=True, return_inverse=True)
        self.weights = np.concatenate([empty, *(q[2] for q in queries)])[first]
        sizes = np.array([len(q[1]) for q in queries], int)
        owner = np.repeat(np.arange(len(queries)), sizes)
        order = np.lexsort((places, owner))
        places = places[order]
        fresh = np.append(True, (owner[1:] != owner[:-1]) | (places[1:] != places[:-1]))[: len(owner)] | (sizes[owner] <= SHORT)
        owner, places = owner[fresh], places[fresh]
        sizes = np.bincount(owner, minlength=len(queries))
        kind = _kinds(owner, places, len(queries)) if len(places) else np.zeros(len(queries), int)
        line = np.lexsort((sizes, kind))
        starts = np.cumsum(sizes) - sizes
        self.places = places[_ranges(starts[line], (starts + sizes)[line])[0]].astype(np.int32)
        self.at = np.append(0, np.cumsum(sizes[line]))
        self.ids = [queries[i][0] for i in line] + [q[0] for q in self.walking]
        cuts = np.flatnonzero(np.append(True, np.diff(kind[line]) != 0))[: len(line)].tolist()
        self.kinds = [*zip(cuts, [*cuts[1:], len(line)])]


def _runs(wanted: np.ndarray) -> list[tuple[int, int]]:
    """First and end of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], wanted, [False]])))
    return [*zip(edges[::2].tolist(), edges[1::2].tolist())]


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places from each start to its end, and how many each range has."""
    times = ends - starts
    before = np.cumsum(times) - times
    return np.arange(int(times.sum())) + np.repeat(starts - before, times), times


def _run(queries: list[tuple[int, np.ndarray, np.ndarray]], average: float, k: int, bars: dict[int, float] | None = None):
    asked = Asked(queries)
    start = np.array([(bars or {}).get(q, 0.0) for q in asked.ids])

    def run(batches):
        bars = start.copy()  # what the best of a query must reach
        heaps: list[list[tuple[float, int]]] = [[] for _ in asked.ids]  # the k best of the task's segments
        for batch in batches:
            for i in range(batch.num_rows):
                segment = Segment({name: batch.column(name)[i].as_buffer() for name in NAMES}, average)
                walked = ((n, segment.best(list(zip(*(x.tolist() for x in q[1:]))), k, bars[n])) for n, q in enumerate(asked.walking))
                for n, best in walked if asked.walking else segment.best_of_many(asked, k, bars):
                    heap = heaps[n]
                    for s, d in best:
                        (heapq.heappush if len(heap) < k else heapq.heappushpop)(heap, (s, -d))
                    if len(heap) == k:
                        bars[n] = max(bars[n], heap[0][0])
                del segment, walked
                give_back()
        found = [(q, -d, s) for q, heap in zip(asked.ids, heaps) for s, d in heap]
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        names = ["query_id", "doc_id", "score"]
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(kinds)], names=names)

    return tidy(run)


def _query_terms(batches):
    words = WordHash()
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), strings(batch, "text")):
            term, tf = np.unique(terms_of(text, words), return_counts=True)
            yield pa.RecordBatch.from_pydict({"query_id": pa.array([doc] * len(term), pa.int64()), "term": term.view(np.int64), "tf": tf})


def _frequencies(batches):
    for batch in batches:
        for row in batch.select(["terms", "starts"]).to_pylist():
            terms, df = np.frombuffer(row["terms"], np.int64), np.diff(np.frombuffer(row["starts"], np.int64))
            yield pa.RecordBatch.from_pydict({"term": terms, "df": df})


def _sizes(batches):
    for batch in batches:
        for row in batch.select(["lengths"]).to_pylist():
            lengths = np.frombuffer(row["lengths"], np.int32)
            yield pa.RecordBatch.from_pydict({"docs": [len(lengths)], "words": [int(lengths.sum())]})


def _packed(batches):
    for batch in batches:
        for query, terms in zip(batch.column(0).to_pylist(), batch.column(1)):
            term, weight = (x.to_numpy(zero_copy_only=False) for x in terms.values.flatten())
            yield pa.RecordBatch.from_pydict({"query_id": pa.array([query], pa.int64()), "terms": [term.tobytes()], "weights": [weight.tobytes()]})


def _blocks(weighted: DataFrame) -> Iterator[list[tuple[int, np.ndarray, np.ndarray]]]:
    block: list[tuple[int, np.ndarray, np.ndarray]] = []
    held = 0
    for row in weighted.mapInArrow(_packed, "query_id bigint, terms binary, weights binary").toLocalIterator():
        terms = np.frombuffer(row["terms"], np.uint64)
        block.append((row["query_id"], terms, np.frombuffer(row["weights"], np.float64)))
        held += len(terms)
        if len(block) == QUERY_BLOCK or held >= BLOCK_TERMS:
            yield block
            block, held = [], 0
    if block:
        yield block


def search(documents: DataFrame, queries: DataFrame, k: int = K, terms: int | None = None, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The best ``k`` documents of every query: query_id, rank (from 1), doc_id, score.

    ``queries`` has ``query_id`` and ``text``; all different words of the text make the query.  Only if ``terms``
    is given, the so many words of highest weight (frequency in the text, saturated, times idf; ties by hash)
    that at least two documents hold make it.  Equal scores are in order of doc_id, a null id first.  Null and empty texts match nothing; repeated rows are
    documents of their own; queries without any known word have no rows; null query ids are left out.
    """
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = queries.select(F.col("query_id").cast("bigint").alias("query_id"), F.col("text").cast("string").alias("text"))
    index = saved(docs.mapInArrow(_build(segment_words), f"{INDEX}, lead boolean"), "index")
    total = index.mapInArrow(_sizes, "docs bigint, words bigint").agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).first()
    many, average = total["docs"] or 0, (total["words"] or 0) / max(1, total["docs"] or 0)
    wanted = saved(asked.filter("query_id IS NOT NULL").mapInArrow(tidy(_query_terms), "query_id bigint, term bigint, tf bigint"), "terms")
    df = index.mapInArrow(_frequencies, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    idf = F.log(1 + (F.lit(float(many)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    chosen = wanted.join(df, "term").select("query_id", "term", "df", idf.alias("weight"), (idf * F.col("tf") / (F.col("tf") + K1)).alias("rate"))
    if terms is not None:
        first = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("rate"), "term"))
        chosen = chosen.filter("df > 1").withColumn("place", first).filter(F.col("place") <= terms)
    weighted = saved(chosen.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("terms")), "queries")
    found = None
    for block in _blocks(weighted):
        first = saved(index.filter("lead").mapInArrow(_run(block, average, k), FOUND), "found")
        bars = first.groupBy("query_id").agg(F.get(F.sort_array(F.collect_list("score"), False), k - 1).alias("bar")).filter("bar IS NOT NULL")
        rest = saved(index.filter("NOT lead").mapInArrow(_run(block, average, k, dict(map(tuple, bars.collect()))), FOUND), "found")
        part = first.unionAll(rest)
        found = part if found is None else found.unionAll(part)
    if found is None:
        return documents.sparkSession.createDataFrame([], "query_id bigint, rank int, doc_id bigint, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    best = found.withColumn("rank", place).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score")
