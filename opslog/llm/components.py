"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import saved

ROUNDS = 64


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u, v) with u > v: neighbours of a node are hung on its smallest one.

    The large step looks at all neighbours and moves those above the node, the small
    step looks at those below it and moves them.
    """
    if large:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = edges.select(F.col("v").alias("u"), F.col("u").alias("far")).join(least, "u").select(F.col("far").alias("u"), F.col("m").alias("v"))
        return moved.filter("u != v").distinct()
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of any comparable type to (node, component): the smallest node reachable.

    Nodes without an edge to another node have no row; null ends are ignored, repeated
    edges and loops are harmless, no edges give no rows.  Every step is a grouping and a
    join over the edges, so that a node with very many links is split like any join key.
    """
    now = saved(
        edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = None
    for _ in range(ROUNDS):
        now = saved(_star(_star(now, large=True), large=False), "stars")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(nodes.select(F.col("component").alias("node"), "component")).distinct()
