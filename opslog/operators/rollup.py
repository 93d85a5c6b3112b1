"""Roll-ups of statistics tables, by entity and by time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.operators.dims import by_levels
from opslog.spec import Grain, Level, Rule


def rollup_entity(
    stats: DataFrame, levels: Sequence[Level], rules: Sequence[Rule], keep: Sequence[str] = ("bucket",)
) -> DataFrame:
    """Server statistics to all levels at once (the finest level is kept as it is)."""
    return by_levels(stats, levels, [r.column() for r in rules], also=list(keep))


def rollup_time(
    stats: DataFrame,
    to: Grain,
    keys: Sequence[str],
    rules: Sequence[Rule],
    bucket: str = "bucket",
) -> DataFrame:
    """Statistics of one grain to a coarser one."""
    coarse = stats.withColumn(bucket, to.bucket(bucket))
    return coarse.groupBy(bucket, *keys).agg(*[r.column() for r in rules])


def shares(stats: DataFrame, buckets: Sequence[str], whole: str, prefix: str = "share_") -> DataFrame:
    """Add each count's percentage of ``whole``."""
    base = F.nullif(F.col(whole), F.lit(0))
    return stats.withColumns(
        {
            f"{prefix}{c}": F.coalesce(F.col(c).cast("double") * 100 / base, F.lit(0.0))
            for c in buckets
        }
    )
