"""Aggregate expressions shared by the metric operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opslog.spec import percent

__all__ = ["count_when", "exact_mean", "mbps", "percent", "rounded_mean"]


def count_when(cond: Column) -> Column:
    return F.count_if(cond)


def exact_mean(value: Column) -> Column:
    """sum / count as a double.

    With a decimal input the sum is exact, so the result does not depend on the
    order in which tasks finish.
    """
    return F.sum(value).cast("double") / F.nullif(F.count(value), F.lit(0))


def rounded_mean(value: Column, digits: int) -> Column:
    """Mean of a decimal value, rounded half up on the exact quotient."""
    return F.round(F.sum(value) / F.nullif(F.count(value), F.lit(0)), digits)


def mbps(bytes_per_minute: Column) -> Column:
    """Bytes per minute as Mbit/s with two digits."""
    return F.round(bytes_per_minute.cast("double") * 8 / 60 / 1024 / 1024, 2).cast("decimal(18,2)")
