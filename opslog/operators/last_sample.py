"""Last reading of each category in a bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.operators.sequence import newest

EMPTY = "empty"  # shown as the mount of a host that sent no sample


def last_sample(
    samples: DataFrame,
    keys: Sequence[str],
    category: str,
    value: str,
    order_by: Sequence[str],
    names: dict[str, str],
) -> DataFrame:
    """Newest value per (keys, category), one column per category of ``names``."""
    wanted = samples.filter(F.col(category).isin(*names))
    last = newest(wanted, [*keys, category], order_by, [value])
    return last.groupBy(*keys).agg(
        *[F.sum(F.when(F.col(category) == c, F.col(value))).alias(n) for c, n in names.items()]
    )
