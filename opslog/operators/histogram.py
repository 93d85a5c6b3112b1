"""Histograms of session durations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.functions.measures import count_when
from opslog.functions.timekeys import seconds_between
from opslog.operators.sequence import next_row


@dataclass(frozen=True)
class Bin:
    """Durations in ``(over, upto]`` seconds; no upper end where ``upto`` is None."""

    name: str
    over: int
    upto: int | None

    def holds(self, seconds: Column) -> Column:
        cond = seconds > self.over
        return cond if self.upto is None else cond & (seconds <= self.upto)


def short_bins() -> list[Bin]:
    """Six ten-second bins and the rest."""
    tens = [Bin(f"c{t}_sec", t - 10, t) for t in range(10, 61, 10)]
    return [*tens, Bin("other", 60, None)]


def long_bins() -> list[Bin]:
    """Ten-second bins to a minute, minute bins to ten minutes, then 30, 60 and the rest."""
    tens = [Bin(f"c_{t - 9}_{t}s", t - 10, t) for t in range(10, 61, 10)]
    minutes = [Bin(f"c_{m}_{m + 1}m", m * 60, (m + 1) * 60) for m in range(1, 10)]
    wide = [Bin("c_10_30m", 600, 1800), Bin("c_30_60m", 1800, 3600), Bin("c_other", 3600, None)]
    return [*tens, *minutes, *wide]


def scaled(bins: Sequence[Bin], seconds: int) -> list[Bin]:
    """The same bins in another unit, e.g. quarter hours of 900 seconds."""
    return [Bin(b.name, b.over * seconds, b.upto and b.upto * seconds) for b in bins]


def closed_durations(sessions: DataFrame, on: str, off: str) -> DataFrame:
    """Length of sessions that carry their own end."""
    return sessions.withColumn("seconds", seconds_between(on, off))


def next_event_durations(
    events: DataFrame,
    keys: Sequence[str],
    ts: str,
    order_by: Sequence[str],
    chunk: Column,
    opens: Column,
    missing: int = 999,
) -> DataFrame:
    """Time from each opening row to the key's next row, ``missing`` where there is none."""
    linked = next_row(events, keys, order_by, chunk, [ts], "following")
    gap = F.coalesce(seconds_between(ts, F.col("following")[ts]), F.lit(missing))
    return linked.filter(opens).withColumn("seconds", gap).drop("following")


def duration_histogram(
    sessions: DataFrame, keys: Sequence[str], bins: Sequence[Bin], seconds: str = "seconds"
) -> DataFrame:
    """``total_cnt`` and one counter per bin over sessions longer than 0."""
    positive = sessions.filter(F.col(seconds) > 0)
    return positive.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_cnt"),
        *[count_when(b.holds(F.col(seconds))).alias(b.name) for b in bins],
    )
