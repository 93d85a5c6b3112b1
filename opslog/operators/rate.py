"""Transactions per slot, summed up per bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.spec import Grain


def rate_per_slot(
    rows: DataFrame,
    ts: str,
    entity: Sequence[str],
    slot: Grain,
    bucket: Grain,
    name: str = "tps",
    count: Column | None = None,
) -> DataFrame:
    """avg, min and max number of rows per slot of each bucket.

    The average is over all slots of the bucket, the minimum is 0 unless every
    slot has a row.  ``count`` says how many rows an already reduced row stands for.
    """
    if bucket.seconds is None or slot.seconds is None:
        raise ValueError("slots must divide a bucket of constant length")
    slots = bucket.seconds // slot.seconds
    n = F.count(F.lit(1)) if count is None else F.sum(count)
    per_slot = rows.groupBy(slot.bucket(ts).alias("slot"), *entity).agg(n.alias("n"))
    full = F.count(F.lit(1)) == slots
    return per_slot.groupBy(bucket.bucket("slot").alias("bucket"), *entity).agg(
        (F.sum("n").cast("double") / slots).alias(f"avg_{name}"),
        F.when(full, F.min("n")).otherwise(F.lit(0)).cast("bigint").alias(f"min_{name}"),
        F.max("n").alias(f"max_{name}"),
    )
