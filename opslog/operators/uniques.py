"""Unique and total views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.operators.dims import by_levels
from opslog.spec import Grain, Level


def client_visits(
    events: DataFrame, ts: str, grain: Grain, client: str, keys: Sequence[str] = ()
) -> DataFrame:
    """One row per (bucket, keys, client) with its number of views.

    This is what leaves the scan: a client with any number of rows is one row per
    bucket and task before the first shuffle.
    """
    return events.groupBy(grain.bucket(ts).alias("bucket"), *keys, client).agg(
        F.count(F.lit(1)).alias("views")
    )


SKETCH_BITS = 14  # 16,384 registers: a standard error of 0.8 %; a fixed value, only equal ones merge


def unique_sketch(visits: DataFrame, levels: Sequence[Level], client: str) -> DataFrame:
    """Per level a sketch of the clients and the views.  Unlike uv, sketches merge to coarser buckets."""
    sketch = F.hll_sketch_agg(client, SKETCH_BITS)
    return by_levels(visits, levels, [sketch.alias("uv_sketch"), F.sum("views").alias("pv")], also=["bucket"])


def estimated(stats: DataFrame) -> DataFrame:
    """``uv`` as the sketch estimates it."""
    return stats.withColumn("uv", F.hll_sketch_estimate("uv_sketch"))


def unique_total(
    visits: DataFrame, levels: Sequence[Level], client: str, approx: bool = False
) -> DataFrame:
    """uv and pv of every level, recomputed per level because uniques do not add."""
    unique = F.approx_count_distinct(client) if approx else F.count_distinct(client)
    return by_levels(
        visits, levels, [unique.alias("uv"), F.sum("views").alias("pv")], also=["bucket"]
    )
