"""Set-similarity self-join on word shingles with prefix filters under several global token orders.

Under any total order of all tokens, two sets of Jaccard similarity ``t`` or more share a
token among the first ``n - ceil(t n) + 1`` of each.  Here every order puts rare tokens
first (document frequency over the whole table) and breaks ties by its own hash, so the
orders differ inside each frequency.  Tokens of one text alone come first in each order and
can match nothing: a text with that many of them is finished without any comparison.

Passes:

1. Each text becomes its set of 56-bit shingle hashes and a 64-bit class (hash of the set and
   its size: equal sets are one class).  Sets travel packed, by hash bucket of the token.
2. A bucket counts its tokens and returns those of two or more classes, packed by class bucket.
   Tokens that many texts of one batch share never meet in a bucket: their counts do, the
   texts themselves pass through spread evenly, and the token gets the last rank everywhere.
3. A class bucket orders its tokens and keeps classes whose prefix is not all unshared.
4. Candidates share a token of order 1, pass the length and the position filter, and share one
   in the prefixes of all other orders; then the shared tokens are counted.  Star rounds compare each class with one
   hub first; a token all of whose classes are connected by then needs no more pairs, so large
   groups of copies cost one comparison a text.  The last round compares *every* pair that is
   still unconnected: no link between components is lost and nothing is capped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import WordHash, mix, parts_for, pieces_of, saved, strings, text_bytes, tidy, tidy_group, words_of
from opslog.llm.components import components

SHINGLE = 5
NUM, DEN = 3, 4  # similarity of 0.75
ORDERS = 3
TOKEN_BYTES = 7
HOT_RANK = 255
TOKENS, HOT_COUNTS, PASSED, SIZES, MEMBERS = 0, 1, 2, 3, 4
PART_BYTES = 12_000_000  # text behind one bucket: some two million tokens
STAR_ROUNDS = 1
SEEN = 200_000  # sets of a task that it doesn't send twice
ROWS_AT_ONCE = 64

PACKED = "part int, kind tinyint, cls binary, cnt binary, tok binary, rank binary, ids array<bigint>"
PACKED_ARROW = pa.schema(
    [
        ("part", pa.int32()), ("kind", pa.int8()), ("cls", pa.binary()), ("cnt", pa.binary()),
        ("tok", pa.binary()), ("rank", pa.binary()), ("ids", pa.list_(pa.int64())),
    ]
)
CLASS = "kind tinyint, doc_id bigint, cls bigint, n int, centre float, " + ", ".join(
    f"pre{k} array<bigint>" for k in range(1, ORDERS + 1)
) + ", tokens array<bigint>"
CLASS_ARROW = pa.schema(
    [("kind", pa.int8()), ("doc_id", pa.int64()), ("cls", pa.int64()), ("n", pa.int32()), ("centre", pa.float32())]
    + [(f"pre{k}", pa.list_(pa.int64())) for k in range(1, ORDERS + 1)]
    + [("tokens", pa.list_(pa.int64()))]
)


def shingles(text: str | None, words: WordHash, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 56-bit hashes of the shingles; a shorter text is one shingle, no word none."""
    w = words.array(words_of(text))
    if not len(w):
        return w
    width = min(size, len(w))
    h = np.full(len(w) - width + 1, np.uint64(width), np.uint64)
    for j in range(width):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[j : len(w) - width + 1 + j]
    return np.unique(mix(h) >> np.uint64(8))


def _pack(tokens: np.ndarray) -> bytes:
    return np.ascontiguousarray(tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES]).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, TOKEN_BYTES)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :TOKEN_BYTES] = raw
    return wide.view("<u8").ravel()


def _runs(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of the runs of equal neighbours."""
    starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else np.zeros(0, int)
    return owner[starts], np.diff(np.append(starts, len(owner)))


def _narrow(counts) -> bytes:
    """Counts in as few bytes each as the largest needs: one stands beside every class of every bucket."""
    counts = np.asarray(counts, np.int64)
    top = int(counts.max(initial=0))
    return counts.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4").tobytes()


def _counted(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Classes of a packed row and their counts."""
    cls = np.frombuffer(row["cls"], np.uint64)
    return cls, np.frombuffer(row["cnt"], f"<u{len(row['cnt']) // len(cls) if len(cls) else 1}").astype(np.int32)


def _row(part: int, kind: int, cls=(), cnt=(), tok: bytes = b"", rank=(), ids=None) -> dict:
    return {
        "part": part, "kind": kind, "cls": np.asarray(cls, np.uint64).tobytes(),
        "cnt": _narrow(cnt), "tok": tok, "rank": np.asarray(rank, np.uint8).tobytes(), "ids": ids,
    }


def _packed_sets(size: int, parts: int):
    shift = np.uint64(56 - (parts.bit_length() - 1))

    def run(batches):
        words, seen = WordHash(), set()
        for batch in (part for whole in batches for part in pieces_of(whole)):
            sets, classes, ns, fresh = [], [], [], []
            for text in strings(batch, "text"):
                s = shingles(text, words, size)
                c = xxhash.xxh3_64_intdigest(s.tobytes(), seed=len(s))
                classes.append(c)
                ns.append(len(s))
                if len(s) and (c, len(s)) not in seen:
                    if len(seen) > SEEN:
                        seen.clear()
                    seen.add((c, len(s)))
                    sets.append(s)
                    fresh.append(c)
            ids = batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64()).to_pylist()
            out = [_row(classes[0] % parts if ids else 0, MEMBERS, cls=classes, cnt=ns, ids=ids)]
            if sets:
                known, sized = np.asarray(fresh, np.uint64), np.array([len(s) for s in sets])
                for p in np.unique(known % np.uint64(parts)):
                    some = known % np.uint64(parts) == p
                    out.append(_row(int(p), SIZES, cls=known[some], cnt=sized[some]))
                tok = np.concatenate(sets)
                own = np.repeat(known, sized)
                sets.clear()
                order = np.argsort(tok, kind="stable")
                tok, own = tok[order], own[order]
                values, counts = _runs(tok)
                hot = counts >= max(64, len(known) // 40)
                is_hot, values = np.repeat(hot, counts), values[hot]
                del order, counts, hot  # as large as the tokens, and not needed while the rows are made
                if len(values):
                    for p in np.unique(values >> shift):
                        some = values[(values >> shift) == p]
                        out.append(_row(int(p), HOT_COUNTS, tok=_pack(some)))
                    out += _by_class(fresh[0] % parts, PASSED, own[is_hot], tok[is_hot])
                    tok, own = tok[~is_hot], own[~is_hot]
                edges = np.searchsorted(tok >> shift, np.arange(parts + 1))
                for p in range(parts):
                    lo, hi = edges[p], edges[p + 1]
                    if hi > lo:
                        out += _by_class(p, TOKENS, own[lo:hi], tok[lo:hi])
                    if len(out) >= ROWS_AT_ONCE:
                        yield pa.RecordBatch.from_pylist(out, schema=PACKED_ARROW)
                        out = []
            yield pa.RecordBatch.from_pylist(out, schema=PACKED_ARROW)

    return run


def _by_class(part, kind, own, tok, rank=()):
    order = np.lexsort((tok, own))
    cls, cnt = _runs(own[order])
    return [_row(part, kind, cls=cls, cnt=cnt, tok=_pack(tok[order]), rank=np.asarray(rank)[order] if len(rank) else ())]


def _entries(table: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, token, rank) of all packed rows of a kind."""
    own, tok, rank = [], [], []
    for row in table.filter(pa.compute.equal(table["kind"], kind)).select(["cls", "cnt", "tok", "rank"]).to_pylist():
        own.append(np.repeat(*_counted(row)))
        tok.append(_unpack(row["tok"]))
        rank.append(np.frombuffer(row["rank"], np.uint8))
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *own]), np.concatenate([empty, *tok]), np.concatenate([empty.astype(np.uint8), *rank])


def _count_tokens(parts: int):
    def run(table: pa.Table) -> pa.Table:
        hot = [_unpack(r) for r in table.filter(pa.compute.equal(table["kind"], HOT_COUNTS))["tok"].to_pylist()]
        hot = np.unique(np.concatenate([np.zeros(0, np.uint64), *hot]))
        own, tok, _ = _entries(table, TOKENS)
        order = np.lexsort((own, tok))
        own, tok = own[order], tok[order]
        if len(tok):
            again = np.concatenate(([False], (tok[1:] == tok[:-1]) & (own[1:] == own[:-1])))
            own, tok = own[~again], tok[~again]
        _, counts = _runs(tok)
        rank = np.repeat(np.minimum(counts, HOT_RANK - 1), counts).astype(np.uint8)
        rank[np.isin(tok, hot)] = HOT_RANK
        shared = rank > 1
        own, tok, rank = own[shared], tok[shared], rank[shared]
        passed = _entries(table, PASSED)
        own, tok = np.concatenate([own, passed[0]]), np.concatenate([tok, passed[1]])
        rank = np.concatenate([rank, np.full(len(passed[0]), HOT_RANK, np.uint8)])
        goes = own % np.uint64(parts)
        order = np.argsort(goes, kind="stable")
        own, tok, rank, goes = own[order], tok[order], rank[order], goes[order]
        edges = np.searchsorted(goes, np.arange(parts + 1))
        out = []
        for p in range(parts):
            lo, hi = edges[p], edges[p + 1]
            if hi > lo:
                out += _by_class(p, TOKENS, own[lo:hi], tok[lo:hi], rank[lo:hi])
        onward = table.filter(pa.compute.greater_equal(table["kind"], SIZES)).select(PACKED_ARROW.names).cast(PACKED_ARROW)
        return pa.concat_tables([pa.Table.from_pylist(out, schema=PACKED_ARROW), onward])

    return run


def _prefixes(num: int, den: int):
    """Classes of one class bucket with the tokens of each order's prefix that other classes have too."""

    def run(table: pa.Table) -> pa.Table:
        sizes = {}
        for row in table.filter(pa.compute.equal(table["kind"], SIZES)).select(["cls", "cnt"]).to_pylist():
            sizes.update(zip(*(x.tolist() for x in _counted(row))))
        own, tok, rank = _entries(table, TOKENS)
        order = np.lexsort((tok, own))
        own, tok, rank = own[order], tok[order], rank[order]
        if len(tok):
            again = np.concatenate(([False], (tok[1:] == tok[:-1]) & (own[1:] == own[:-1])))
            own, tok, rank = own[~again], tok[~again], rank[~again]
        cls, shared = _runs(own)
        n = np.array([sizes[c] for c in cls.tolist()], np.int64)
        room = n - -(-n * num // den) + 1 - (n - shared)  # prefix places left after the unshared tokens
        keep = room > 0
        held = np.repeat(keep, shared)
        own, tok, rank = own[held], tok[held], rank[held]
        centre = np.add.reduceat(rank.astype(np.float32), np.cumsum(shared[keep]) - shared[keep]) / n[keep] if keep.any() else np.zeros(0)
        cls, shared, n, room = cls[keep], shared[keep], n[keep], np.minimum(room, shared)[keep]
        starts = np.cumsum(shared) - shared
        place = np.arange(len(tok)) - np.repeat(starts, shared)
        inside = place < np.repeat(room, shared)
        offsets = np.append(0, np.cumsum(room)).astype(np.int32)
        columns = {
            "kind": pa.array(np.full(len(cls), TOKENS, np.int8)), "doc_id": pa.nulls(len(cls), pa.int64()),
            "cls": pa.array(cls.view(np.int64)), "n": pa.array(n.astype(np.int32)), "centre": pa.array(centre.astype(np.float32)),
        }
        for k in range(1, ORDERS + 1):
            by = np.lexsort((mix(tok + np.uint64(k * 0x5851F42D4C957F2D & (2**64 - 1))), rank, own))
            columns[f"pre{k}"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(tok[by][inside].view(np.int64)))
        ends = np.append(0, np.cumsum(shared)).astype(np.int32)
        columns["tokens"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(tok.view(np.int64)))
        return pa.concat_tables([pa.table(columns).cast(CLASS_ARROW), _members(table)])

    return run


def _members(table: pa.Table) -> pa.Table:
    out = [CLASS_ARROW.empty_table()]
    for row in table.filter(pa.compute.equal(table["kind"], MEMBERS)).select(["cls", "cnt", "ids"]).to_pylist():
        cls, cnt = _counted(row)
        fixed = {
            "kind": pa.array(np.full(len(cls), MEMBERS, np.int8)), "doc_id": pa.array(row["ids"], pa.int64()),
            "cls": pa.array(cls.view(np.int64)), "n": pa.array(cnt),
        }
        out.append(pa.table([fixed.get(f.name, pa.nulls(len(cls), f.type)) for f in CLASS_ARROW], schema=CLASS_ARROW))
    return pa.concat_tables(out)


class SimilarSets:
    """The shared-token view of a table: classes, their members, prefixes, and verified links.

    ``documents`` needs ``doc_id`` and ``text``.  A null or blank text is the empty set, linked
    with nothing; null ids keep their row.  Similarity is at least ``num / den``.
    """

    def __init__(self, documents: DataFrame, size: int = SHINGLE, num: int = NUM, den: int = DEN):
        self.num, self.den = num, den
        docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        parts = parts_for(text_bytes(docs), PART_BYTES)
        packed = docs.mapInArrow(tidy(_packed_sets(size, parts)), PACKED)
        shared = packed.groupBy("part").applyInArrow(tidy_group(_count_tokens(parts)), PACKED)
        both = saved(shared.groupBy("part").applyInArrow(tidy_group(_prefixes(num, den)), CLASS), "classes")
        self.members = both.filter(F.col("kind") == MEMBERS).select("doc_id", "cls", "n")
        self.classes = both.filter(F.col("kind") == TOKENS).drop("kind", "doc_id")
        one = self.classes.select(F.posexplode("pre1").alias("pos", "token"), "cls", "n", "centre", F.size("tokens").alias("shared"))
        one = one.select("token", "cls", "n", "centre", (F.col("shared") - F.col("pos")).alias("rest"))
        several = one.groupBy("token").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).filter("lo < hi")
        self.postings = saved(one.join(several.select("token"), "token"), "postings")

    def _close(self, a: str, b: str, rest_a: str, rest_b: str):
        """Sizes and what is left of both sets from the token on (position filter) allow the similarity."""
        sizes = (F.col(a) * self.den >= F.col(b) * self.num) & (F.col(b) * self.den >= F.col(a) * self.num)
        left = F.least(rest_a, rest_b) * (self.num + self.den) >= (F.col(a) + F.col(b)) * self.num
        return sizes & left

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) of classes whose other prefixes meet too and whose sets are similar enough."""
        others = [f"pre{k}" for k in range(2, ORDERS + 1)]

        def side(name: str) -> DataFrame:
            cols = [F.col(c).alias(f"{c}_{name}") for c in ["n", *others, "tokens"]]
            return self.classes.select(F.col("cls").alias(name), *cols)

        both = pairs.join(side("b"), "b").join(side("a"), "a")
        for c in others:
            both = both.filter(F.arrays_overlap(f"{c}_a", f"{c}_b"))
        common = F.size(F.array_intersect("tokens_a", "tokens_b"))
        enough = common * (self.num + self.den) >= (F.col("n_a") + F.col("n_b")) * self.num
        return both.filter(enough).select("a", "b")

    def _placed(self, comp: DataFrame | None) -> DataFrame:
        """Postings of tokens that still have classes of two components, with the component."""
        if comp is None:
            placed = self.postings.withColumn("comp", F.col("cls"))
        else:
            known = comp.select(F.col("node").alias("cls"), F.col("component").alias("comp"))
            placed = self.postings.join(known, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        return placed

    def _star_pairs(self, placed: DataFrame, turn: int) -> DataFrame:
        """One pair for each class: the hub with which it shares most tokens of its prefix.

        A token's hub is the class whose own tokens are the most common ones (the text that the
        others were made from, if it is there), in odd turns any class.
        """
        order = F.xxhash64("cls", F.lit(turn)).cast("double") if turn % 2 else F.col("centre").cast("double")
        pick = F.struct(order.alias("h"), F.col("cls").alias("c"), F.col("comp").alias("k"), F.col("n").alias("m"), F.col("rest").alias("r"))
        hubs = placed.groupBy("token").agg(F.max(pick).alias("hub"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        hubs = hubs.filter("lo < hi").select("token", F.col("hub.c").alias("a"), F.col("hub.k").alias("a_comp"), F.col("hub.m").alias("a_n"), F.col("hub.r").alias("a_rest"))
        pairs = placed.join(hubs, "token").filter((F.col("comp") != F.col("a_comp")) & self._close("n", "a_n", "rest", "a_rest"))
        counted = pairs.groupBy(F.col("cls").alias("b"), "a").agg(F.count("*").alias("met"))
        return counted.groupBy("b").agg(F.max_by("a", F.struct("met", "a")).alias("a"))

    def _rest_pairs(self, placed: DataFrame) -> DataFrame:
        """Every pair of two components that shares a token of its prefixes."""
        open_ = placed.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi")
        left = placed.join(open_.select("token"), "token")
        right = left.select("token", F.col("cls").alias("b"), F.col("n").alias("b_n"), F.col("comp").alias("b_comp"), F.col("rest").alias("b_rest"))
        met = left.withColumnRenamed("cls", "a").join(right, "token")
        return met.filter((F.col("comp") < F.col("b_comp")) & self._close("n", "b_n", "rest", "b_rest")).select("a", "b").distinct()

    def links(self) -> DataFrame:
        """All similar pairs (a, b) of different classes, a < b: the join itself, every pair once."""
        pairs = self._rest_pairs(self._placed(None))
        return self.verified(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    def connected(self) -> DataFrame:
        """(node, component) of all classes with a link, without writing out the links inside a group."""
        comp, found = None, None
        for turn in range(STAR_ROUNDS + 1):
            placed = self._placed(comp)
            pairs = self._star_pairs(placed, turn) if turn < STAR_ROUNDS else self._rest_pairs(placed)
            new = saved(self.verified(pairs), "links")
            if comp is not None and not new.head(1):
                continue
            found = new if found is None else found.unionAll(new)
            comp = components(found)
        return comp


def similar_documents(documents: DataFrame, size: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """Per row of ``documents``: doc_id, n_shingles, component_id, class_id.

    ``component_id`` is the smallest ``doc_id`` reachable by links, itself included; ``class_id``
    the smallest ``doc_id`` with the same set.  Empty sets stay alone.  Repeated ids and rows
    are kept; an empty table gives no rows; columns other than the two are not looked at.
    """
    sets = SimilarSets(documents, size, num, den)
    classes = sets.members.filter("n > 0").groupBy("cls", "n").agg(F.min("doc_id").alias("class_id"))
    comp = sets.connected().select(F.col("node").alias("cls"), "component")
    placed = classes.join(comp, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    firsts = placed.groupBy("component").agg(F.min("class_id").alias("component_id"))
    placed = placed.join(firsts, "component").select("cls", "n", "class_id", "component_id")
    return sets.members.join(placed, ["cls", "n"], "left").select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
    )
