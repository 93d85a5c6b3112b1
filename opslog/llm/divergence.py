"""How far each source of a language is from the others and from the whole, term by term.

Identical texts of a language are one text with a multiplicity per source: it is tokenized once,
and its counts and document frequencies are added with those multiplicities.  What follows is
sparse: a source's counts are kept for the terms that it has, so the sum over all terms of a pair of
sources is put together from the terms of one, those of the other and those of both:

    sum f = V f(a0, b0) + sum_A (f(a, b0) - f(a0, b0)) + sum_B (f(a0, b) - f(a0, b0))
            + sum_AB (f(a, b) - f(a, b0) - f(a0, b) + f(a0, b0))

where a0 and b0 are the shares of a term that a source lacks.  The first two sums run over counts
of counts, the last over distinct patterns of counts, never over pairs of documents.

Null lang, source and text are ''; an empty text has no terms but its source still counts; repeated
rows count as often as they occur; a text of any length is read in pieces of ``PIECE`` bytes; ties of
value go to the item whose UTF-8 bytes come first; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import saved

LEAST_DOCS = 3  # documents of its language that a kept term is in
SCALE = 1_000_000_000  # shares are whole parts of this
TOP_TERMS = 200
SLICE = 4 << 20  # bytes of text that are counted together
PIECE = 1 << 20  # bytes of one text that are split at once
BLOCK = 2_000_000  # counts that are spread over sources at once
LOOKUP_ROWS = 20_000  # groups of at most this many rows are sent to every task

# Fixed: A-Z become a-z, other ASCII bytes part terms, bytes of other characters are kept.
TERM_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
LOCAL = "lang string, source string, text string, copies bigint"
COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def terms_of(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, piece by piece; a piece ends between two terms."""
    plain = text.encode("utf-8", "replace").translate(TERM_BYTES)
    at = 0
    while at < len(plain):
        end = at + PIECE
        if end < len(plain):
            cut = plain.find(b" ", end)
            end = cut if cut >= 0 else len(plain)
        yield plain[at:end].split()
        at = end


def _merge_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies of a batch become one row before anything is shuffled."""
    for batch in batches:
        table = pa.Table.from_batches([batch]).group_by(["lang", "source", "text"]).aggregate([([], "count_all")])
        table = table.rename_columns(["lang", "source", "text", "copies"])
        yield from table.cast(pa.schema([("lang", pa.string()), ("source", pa.string()), ("text", pa.string()), ("copies", pa.int64())])).to_batches()


class _Codes(dict):
    def __missing__(self, key):
        value = self[key] = len(self)
        return value


class _Slice:
    """Texts that are counted together, and what is sent on for them."""

    def __init__(self):
        self.terms, self.groups = _Codes(), _Codes()
        self.pending: list[np.ndarray] = []
        self.waiting = self.bytes = self.texts = 0
        self.keys, self.times = [], []
        self.text_of, self.group_of, self.copies = [], [], []

    def add(self, lang: str, text: str, holders: list[dict]) -> None:
        for holder in holders:
            self.text_of.append(self.texts)
            self.group_of.append(self.groups[lang, holder["source"]])
            self.copies.append(holder["copies"])
        for words in terms_of(text):
            codes = np.fromiter(map(self.terms.__getitem__, words), np.int64, len(words))
            self.pending.append(codes | (self.texts << 32))
            self.waiting += len(words)
            if self.waiting > BLOCK:
                self._settle()
        self.bytes += len(text)
        self.texts += 1

    def _settle(self) -> None:
        if self.pending:
            keys, times = np.unique(np.concatenate(self.pending), return_counts=True)
            self.keys.append(keys)
            self.times.append(times)
            self.pending, self.waiting = [], 0

    def counts(self) -> Iterator[pa.RecordBatch]:
        """Occurrences and documents of each term in each (lang, source)."""
        self._settle()
        if not self.keys or not sum(map(len, self.keys)):
            return
        keys, times = _summed(np.concatenate(self.keys), np.concatenate(self.times))
        text, term = keys >> 32, keys & 0xFFFFFFFF
        first = np.searchsorted(text, np.arange(self.texts + 1))
        of, group, copies = (np.array(x, np.int64) for x in (self.text_of, self.group_of, self.copies))
        sizes = first[of + 1] - first[of]
        names = list(self.groups)
        langs, sources = pa.array([n[0] for n in names], pa.string()), pa.array([n[1] for n in names], pa.string())
        words = pa.array(list(self.terms), pa.binary()).cast(pa.string())
        ends, lo = np.cumsum(sizes), 0
        while lo < len(of):  # some holders at a time, each with all terms of its text
            done = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, done + BLOCK, "right")))
            n = sizes[lo:hi]
            at = np.repeat(first[of[lo:hi]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            weight = np.repeat(copies[lo:hi], n)
            pair = (np.repeat(group[lo:hi], n) << 32) | term[at]
            both, occurrences, docs = _summed(pair, times[at] * weight, weight)
            place = pa.array(both >> 32)
            yield pa.RecordBatch.from_arrays(
                [langs.take(place), sources.take(place), words.take(pa.array(both & 0xFFFFFFFF)), pa.array(occurrences), pa.array(docs)],
                names=["lang", "source", "term", "n", "docs"],
            )
            lo = hi


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order and the sums of their values."""
    if not len(keys):
        return (keys, *values)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return (keys[starts], *[np.add.reduceat(v[order], starts) for v in values])


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = _Slice()
    for batch in batches:
        for i in range(batch.num_rows):
            lang, text, holders = (batch.column(k)[i].as_py() for k in range(3))
            part.add(lang, text, holders)
            if part.bytes >= SLICE:
                yield from part.counts()
                part = _Slice()
    yield from part.counts()


def term_counts(docs: DataFrame) -> DataFrame:
    """``n`` occurrences and ``docs`` documents of every term of every (lang, source)."""
    plain = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    copies = plain.mapInArrow(_merge_copies, LOCAL).repartition("lang", "text")
    texts = copies.groupBy("lang", "text").agg(F.collect_list(F.struct("source", "copies")).alias("holders"))
    parts = texts.mapInArrow(_count_terms, COUNTS)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(docs: DataFrame) -> DataFrame:
    """Terms in at least ``LEAST_DOCS`` documents of a lang: all occurrences, and those of each source that has any."""
    by = F.array_sort(F.collect_list(F.struct("source", "n"))).alias("by")
    grouped = term_counts(docs).groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_all"), by)
    return grouped.filter(F.col("docs") >= LEAST_DOCS).drop("docs")


def share(n: str, total: str, terms: str) -> Column:
    """A count's smoothed share; decimals, since billions of occurrences times ``SCALE`` pass 64 bits."""
    return F.expr(f"1 + (CAST({n} + 1 AS DECIMAL(20,0)) * {SCALE}) div nullif(CAST({total} + {terms} AS DECIMAL(20,0)), 0)")


def gap(p: str, q: str) -> Column:
    """Whole part of (p - q)^2 / q; shares stay far under 2^31, so the square fits 64 bits."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _lookup(df: DataFrame) -> DataFrame:
    """A saved table of groups: sent to every task only while it is short, else joined by a shuffle."""
    return F.broadcast(df) if df.limit(LOOKUP_ROWS + 1).count() <= LOOKUP_ROWS else df


def divergence(docs: DataFrame) -> DataFrame:
    """Per (lang, source): its distance to each other source, and the terms it uses more than its language."""
    kept = saved(kept_terms(docs), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_all").alias("n_lang"))
    used = kept.select("lang", "term", "n_all", F.explode("by").alias("g")).select("lang", "term", "n_all", "g.source", "g.n")
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    seen = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    groups = seen.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("total", "v", "n_lang")])
    groups = saved(groups.withColumn("zero", F.coalesce(share("0", "total", "v"), F.lit(1))), "source-groups")
    return _pairs(kept, used, groups).unionByName(_terms(used, groups)).select("lang", "source", "part", "item", "value", "rank")


def _terms(used: DataFrame, groups: DataFrame) -> DataFrame:
    rows = used.join(_lookup(groups), ["lang", "source"]).withColumns({"p": share("n", "total", "v"), "q": share("n_all", "n_lang", "v")})
    rows = rows.filter("p > q").select("lang", "source", F.col("term").alias("item"), gap("p", "q").alias("value"))
    rank = F.expr("row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)").cast("int")
    return rows.withColumn("rank", rank).filter(F.col("rank") <= TOP_TERMS).withColumn("part", F.lit("term"))


def _pairs(kept: DataFrame, used: DataFrame, groups: DataFrame) -> DataFrame:
    """Every ordered pair of sources of a language with its summed distance."""
    look = _lookup(groups)

    def side(prefix: str) -> DataFrame:
        return look.select("lang", *[F.col(c).alias(f"{prefix}_{c}") for c in ("source", "total", "zero", "v")])

    exact = "decimal(38,0)"
    of_counts = saved(used.groupBy("lang", "source", "n").agg(F.count("*").alias("m")), "counts-of-counts")
    one = of_counts.join(look, ["lang", "source"]).withColumn("p", share("n", "total", "v"))
    one = one.select("lang", F.col("source").alias("s"), F.col("zero").alias("z"), "p", "m")
    other = look.select("lang", F.col("source").alias("t"), F.col("zero").alias("y"))
    alone = one.join(other, "lang").filter("s != t")
    left = alone.select("lang", F.col("s").alias("source"), F.col("t").alias("item"), (F.col("m").cast(exact) * (gap("p", "y") - gap("z", "y"))).alias("x"))
    right = alone.select("lang", F.col("t").alias("source"), F.col("s").alias("item"), (F.col("m").cast(exact) * (gap("y", "p") - gap("y", "z"))).alias("x"))

    patterns = kept.filter(F.size("by") > 1).groupBy("lang", "by").agg(F.count("*").alias("m"))
    first = patterns.select("lang", "m", "by", F.posexplode("by").alias("i", "a"))
    second = first.select("lang", "m", "a", F.explode(F.expr("slice(by, i + 2, size(by))")).alias("b"))
    shared = second.groupBy("lang", F.col("a.source").alias("a_source"), F.col("b.source").alias("b_source"), F.col("a.n").alias("a_n"), F.col("b.n").alias("b_n")).agg(F.sum("m").alias("m"))
    shared = shared.join(side("a").drop("a_v"), ["lang", "a_source"]).join(side("b").withColumnRenamed("b_v", "v"), ["lang", "b_source"])
    shared = shared.withColumns({"p": share("a_n", "a_total", "v"), "q": share("b_n", "b_total", "v")})

    def corrected(p: str, q: str, p0: str, q0: str) -> Column:
        return (F.col("m").cast(exact) * (gap(p, q) - gap(p, q0) - gap(p0, q) + gap(p0, q0))).alias("x")

    both = shared.select("lang", F.col("a_source").alias("source"), F.col("b_source").alias("item"), corrected("p", "q", "a_zero", "b_zero")).unionAll(
        shared.select("lang", F.col("b_source").alias("source"), F.col("a_source").alias("item"), corrected("q", "p", "b_zero", "a_zero"))
    )
    base = groups.select("lang", "source", "v", "zero").join(other, "lang").filter("source != t")
    base = base.select("lang", "source", F.col("t").alias("item"), (F.col("v").cast(exact) * gap("zero", "y")).alias("x"))
    parts = base.unionAll(left).unionAll(right).unionAll(both)
    summed = parts.groupBy("lang", "source", "item").agg(F.sum("x").cast("bigint").alias("value"))
    rank = F.expr("row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)").cast("int")
    return summed.withColumn("rank", rank).withColumn("part", F.lit("pair"))
