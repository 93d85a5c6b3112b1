"""Gauges: average, minimum and maximum of samples per bucket and entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.functions.measures import exact_mean, rounded_mean


def by_category(category: str, value: Column, names: dict[str, str]) -> dict[str, Column]:
    """One value column per category; ``names`` maps category to gauge name."""
    return {name: F.when(F.col(category) == cat, value) for cat, name in names.items()}


def gauge(
    samples: DataFrame, keys: Sequence[str], values: dict[str, Column], digits: int | None = None
) -> DataFrame:
    """``avg_/min_/max_`` of each value per key."""
    aggs = []
    for name, value in values.items():
        avg = exact_mean(value) if digits is None else rounded_mean(value, digits)
        aggs += [
            avg.alias(f"avg_{name}"),
            F.min(value).alias(f"min_{name}"),
            F.max(value).alias(f"max_{name}"),
        ]
    return samples.groupBy(*keys).agg(*aggs)


def gauge_parts(samples: DataFrame, keys: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """Sum, count, minimum and maximum: what later steps can merge exactly."""
    aggs = []
    for name, value in values.items():
        aggs += [
            F.sum(value).alias(f"sum_{name}"),
            F.count(value).alias(f"n_{name}"),
            F.min(value).alias(f"min_{name}"),
            F.max(value).alias(f"max_{name}"),
        ]
    return samples.groupBy(*keys).agg(*aggs)


def finish_gauge(
    parts: DataFrame, keys: Sequence[str], names: Sequence[str], digits: int | None = None
) -> DataFrame:
    """Merge parts to ``keys``; the average is over samples."""
    return parts.groupBy(*keys).agg(*finish_columns(names, digits))


def finish_columns(names: Sequence[str], digits: int | None = None) -> list[Column]:
    aggs = []
    for name in names:
        whole, count = F.sum(f"sum_{name}"), F.nullif(F.sum(f"n_{name}"), F.lit(0))
        avg = whole.cast("double") / count if digits is None else F.round(whole / count, digits)
        aggs += [
            avg.alias(f"avg_{name}"),
            F.min(f"min_{name}").alias(f"min_{name}"),
            F.max(f"max_{name}").alias(f"max_{name}"),
        ]
    return aggs


def gauge_zeros(names: Sequence[str]) -> dict[str, object]:
    return {f"{kind}_{name}": 0 for name in names for kind in ("avg", "min", "max")}


SIDES = ("rx", "tx")


def port_parts(samples: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count, sum, minimum and maximum of ``rx`` and ``tx``; a bad number counts as 0."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for s in SIDES:
        known = F.coalesce(F.col(s), F.lit(0))
        aggs += [
            F.sum(known).alias(f"sum_{s}"),
            F.min(known).alias(f"low_{s}"),
            F.max(known).alias(f"high_{s}"),
        ]
    return samples.groupBy(*keys).agg(*aggs)


def merge_port_parts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    aggs = [F.sum("n").alias("n")]
    for s in SIDES:
        aggs += [
            F.sum(f"sum_{s}").alias(f"sum_{s}"),
            F.min(f"low_{s}").alias(f"low_{s}"),
            F.max(f"high_{s}").alias(f"high_{s}"),
        ]
    return parts.groupBy(*keys).agg(*aggs)


def port_gauge(
    per_port: DataFrame, keys: Sequence[str], frame: DataFrame, by: Sequence[str]
) -> DataFrame:
    """Integer gauges from one row of parts per port; a silent port is one sample of 0.

    The average is taken over samples, so grouping by switch averages over its
    ports and samples together.
    """
    filled = frame.join(per_port, list(keys), "left")
    n, zero = F.sum(F.coalesce(F.col("n"), F.lit(1))), F.lit(0).cast("bigint")
    out = []
    for s in SIDES:
        out += [
            _whole_mean(F.sum(F.coalesce(f"sum_{s}", zero)), n).alias(f"avg_{s}_bps"),
            F.min(F.coalesce(f"low_{s}", zero)).alias(f"min_{s}_bps"),
            F.max(F.coalesce(f"high_{s}", zero)).alias(f"max_{s}_bps"),
        ]
    return filled.groupBy(*by).agg(*out)


def _whole_mean(total: Column, count: Column) -> Column:
    """Integer quotient: exact for sums a double cannot hold."""
    return F.call_function("div", total, count)
