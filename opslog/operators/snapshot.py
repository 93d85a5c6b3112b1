"""Dashboard snapshots: the latest values of several metrics side by side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.operators.sequence import newest


def at_latest_bucket(stats: DataFrame, bucket: str = "bucket") -> DataFrame:
    """Rows of the newest bucket the table holds (one scalar sub-query)."""
    newest_bucket = stats.select(F.max(bucket).alias("latest")).scalar()
    return stats.filter(F.col(bucket) == newest_bucket)


def latest_per_key(
    stats: DataFrame, keys: Sequence[str], cols: Sequence[str], bucket: str = "bucket"
) -> DataFrame:
    """Each key's own newest row."""
    return newest(stats, keys, [bucket], cols)


def combine(metrics: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Union of metrics with different measures, missing ones as 0, summed per key."""
    names = list(dict.fromkeys(c for m in metrics for c in m.columns if c not in keys))
    padded = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), metrics)
    return padded.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])


def flagged(slices: dict[str, DataFrame], flag: str = "flag") -> DataFrame:
    """Union of slices, each row marked with the name of its slice."""
    marked = [df.withColumn(flag, F.lit(name)) for name, df in slices.items()]
    return reduce(lambda a, b: a.unionByName(b), marked)
