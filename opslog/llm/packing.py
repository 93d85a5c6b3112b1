"""Best-fit packing by exact-complement lookups over the histogram of lengths.

Only the count of pieces of each length (one number per length up to the sequence size) reaches
the driver, whatever the table holds.  The plan is a list of patterns, each a few lengths and how
often it is used.  A pattern starts with the longest length left; the gap is looked up among the
single lengths, the sums of two and of three that are still available; where nothing fills it
exactly, the longest length that fits goes in (best fit) and the smaller gap is looked up again.
Every piece knows its rank among the pieces of its length (a counter in its task plus the counts
of earlier tasks), and the rank alone says which use of which pattern it fills.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opslog.llm.common import saved, strings, tidy
from opslog.llm.tokens import encoder

SIZE = 2048
END_ID = 0

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task bigint, turn bigint"


def _complement(gap: int, left: np.ndarray, deep: int = 3) -> list[int] | None:
    """One to ``deep`` (three at most) available lengths whose sum is ``gap``, longest first."""
    if gap < len(left) and left[gap] > 0:
        return [gap]
    if deep == 1:
        return None
    have = np.flatnonzero(left[: gap + 1] > 0)[::-1]

    def pair(total: int, spent: int) -> list[int] | None:
        some = have[(have < total) & (2 * have >= total)]
        some = some[left[total - some] > 0]
        for a in some:
            parts = [spent, int(a), int(total - a)] if spent else [int(a), int(total - a)]
            if all(left[p] >= parts.count(p) for p in parts):
                return parts
        return None

    found = pair(gap, 0)
    if found or deep == 2:
        return found
    for a in have:
        if 3 * a < gap:
            break
        if a < gap and (found := pair(int(gap - a), int(a))):
            return found
    return None


def plan(histogram: np.ndarray, size: int = SIZE) -> list[tuple[list[int], int]]:
    """Patterns (lengths, uses) that place ``histogram[k]`` pieces of each length ``k <= size``.

    Exact fills for all lengths before any best fit, or best fit as soon as a length has no
    exact fill, with complements of up to one, two or three: the plan with fewest sequences.
    """
    plans = [_plan(histogram, size, passes, deep) for passes in ((False, True), (True,)) for deep in (1, 2, 3)]
    return min(plans, key=lambda p: sum(times for _, times in p))


def _plan(histogram: np.ndarray, size: int, passes: tuple[bool, ...], deep: int) -> list[tuple[list[int], int]]:
    left = np.asarray(histogram, np.int64).copy()
    out: list[tuple[list[int], int]] = []

    def use(parts: list[int]) -> None:
        times = int(min(left[p] // parts.count(p) for p in set(parts)))
        for p in parts:
            left[p] -= times
        out.append((parts, times))

    for best_fit in passes:
        for first in range(size, 0, -1):
            while left[first] > 0:
                parts, gap = [first], size - first
                left[first] -= 1
                while gap:
                    fill = _complement(gap, left, deep)
                    if not fill and best_fit:
                        fits = np.flatnonzero(left[: gap + 1] > 0)
                        fill = [int(fits[-1])] if len(fits) else None
                    if not fill:
                        break
                    parts += fill
                    gap -= sum(fill)
                    for p in fill:
                        left[p] -= 1
                for p in parts:
                    left[p] += 1
                if gap and not best_fit:
                    break
                use(parts)
    return out


def _pieces(tokenizer: str, spaced: bool, size: int, end_id: int, with_ids: bool, remembered: int | None = None):
    names = [c.split()[0] for c in PIECE.split(", ")] + ["ids"] * with_ids

    def run(batches):
        from pyspark import TaskContext

        task, model, end = TaskContext.get().partitionId(), encoder(tokenizer, spaced, remembered), np.array([end_id], "<u4")
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            rows = []
            for doc, own in zip(batch.column(0).to_pylist(), model.encode_all(strings(batch, "text"))):
                ids = np.concatenate([own, end])
                cut = (len(ids) - 1) % size + 1
                edges = [0, *range(cut, len(ids) + 1, size)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    data = ids[a:b].tobytes()
                    rows.append((doc, k, a, b - a, zlib.crc32(data), task, int(seen[b - a]), *[data] * with_ids))
                    seen[b - a] += 1
            if rows:
                kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5, *[pa.binary()] * with_ids]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return run


def _place(patterns: list[tuple[list[int], int]], size: int):
    """(length, rank) to (sequence_id, offset) from the plan's intervals of ranks."""
    first, base, offset = ([[] for _ in range(size + 1)] for _ in range(3))
    used, sequence = [0] * (size + 1), 0
    for parts, times in patterns:
        at = 0
        for p in parts:
            first[p].append(used[p])
            base[p].append(sequence)
            offset[p].append(at)
            used[p] += times
            at += p
        sequence += times
    first, base, offset = ([np.array(x, np.int64) for x in y] for y in (first, base, offset))

    def run(batches):
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for p in np.unique(length):
                here = length == p
                k = np.searchsorted(first[p], rank[here], side="right") - 1
                seq[here] = base[p][k] + rank[here] - first[p][k]
                off[here] = offset[p][k]
            kept = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(seq), pa.array(off)],
                names=[*kept, "sequence_id", "offset"],
            )

    return run


def pack(
    documents: DataFrame,
    tokenizer: str = "byte_bpe_50k.json",
    spaced: bool = True,
    size: int = SIZE,
    end_id: int = END_ID,
    with_ids: bool = False,
    remembered: int | None = None,
) -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and ``end_id``; one longer than ``size`` is cut so that only its first
    piece is short.  A null or empty text is the end id alone.  Null and repeated ids keep a row
    for each row; an empty table gives no rows.  ``with_ids`` adds the piece's ids as
    little-endian 32-bit integers.  ``remembered`` bounds the pieces of text that a worker keeps, not what is packed.
    """
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = docs.mapInArrow(tidy(_pieces(tokenizer, spaced, size, end_id, with_ids, remembered), holds=True), PIECE + ", ids binary" * with_ids)
    pieces = saved(made, "pieces")
    counts = pieces.groupBy("task", "length").agg(F.count("*").alias("many"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "length", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("before"))
    histogram = np.zeros(size + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most ``size`` rows
        histogram[row["length"]] = row["count"]
    ranked = pieces.join(offsets, ["task", "length"]).withColumn("rank", F.col("turn") + F.col("before")).drop("task", "turn", "before")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return ranked.select(*columns, "rank").mapInArrow(
        _place(plan(histogram, size), size), schema + ", sequence_id bigint, offset bigint"
    )
