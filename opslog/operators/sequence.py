"""Next and previous row of a key, safe for keys that hold most of the rows.

A plain ``lead`` over a key sorts the whole key in one task.  Here the key is cut
into chunks of the order column: rows find their neighbour inside the chunk, and
only the one edge row per chunk looks further, over a list that has one row per
chunk of the key.  The busiest task then holds one chunk, and the second list is
bounded by the number of chunks in the time range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslog.functions.timekeys import epoch


def minute_chunk(ts: str) -> Column:
    """The usual chunk of a log: one minute."""
    return F.call_function("div", epoch(ts), F.lit(60))


def next_row(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    chunk: Column,
    payload: Sequence[str],
    name: str = "next_row",
    backward: bool = False,
) -> DataFrame:
    """Add struct ``name`` with the payload of the key's next row (null at the end).

    ``chunk`` must not decrease along ``order_by``; ``order_by`` must be unique
    inside a key, so that the result is the same on every run.
    """
    direction = F.desc if backward else F.asc
    inside = Window.partitionBy("_chunk", *keys).orderBy(*[direction(c) for c in order_by])
    across = Window.partitionBy(*keys).orderBy(direction("_chunk"))
    payload_row = F.struct(*payload)
    linked = df.withColumn("_chunk", chunk).withColumns(
        {
            name: F.lead(payload_row).over(inside),
            "_edge": F.first(payload_row).over(inside.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    settled = linked.filter(F.col(name).isNotNull())
    edges = linked.filter(F.col(name).isNull()).withColumn(name, F.lead("_edge").over(across))
    return settled.unionByName(edges).drop("_chunk", "_edge")


def previous_row(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    chunk: Column,
    payload: Sequence[str],
    name: str = "previous_row",
) -> DataFrame:
    return next_row(df, keys, order_by, chunk, payload, name, backward=True)


def both_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    chunk: Column,
    payload: Sequence[str],
    after: str = "next_row",
    before: str = "previous_row",
) -> DataFrame:
    """``next_row`` and ``previous_row`` from one sort of the chunks and one of their edges.

    A chunk's last row lacks its next and its first row lacks its previous row.  Of these edge rows in
    order, the next one after a last row is the first of the next chunk, and the other way round.
    """
    row = F.struct(*payload)
    inside = Window.partitionBy("_chunk", *keys).orderBy(*order_by)
    across = Window.partitionBy(*keys).orderBy("_chunk", *order_by)
    linked = df.withColumn("_chunk", chunk).withColumns({after: F.lead(row).over(inside), before: F.lag(row).over(inside)})
    whole = F.col(after).isNotNull() & F.col(before).isNotNull()
    edges = linked.filter(~whole).withColumns(
        {after: F.coalesce(after, F.lead(row).over(across)), before: F.coalesce(before, F.lag(row).over(across))}
    )
    return linked.filter(whole).unionByName(edges).drop("_chunk")


def newest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Last row of each key, as an aggregate that combines before the shuffle."""
    return _edge_row(df, keys, order_by, cols, F.max_by)


def oldest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """First row of each key."""
    return _edge_row(df, keys, order_by, cols, F.min_by)


def _edge_row(df, keys, order_by, cols, pick):
    row = pick(F.struct(*cols), F.struct(*order_by)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, *[F.col("_row")[c].alias(c) for c in cols])
