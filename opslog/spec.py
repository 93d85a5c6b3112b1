"""Grains, job windows, entity levels and measure rules."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grain:
    """A time bucket: truncation unit, text key and length (None: not constant)."""

    unit: str
    key_format: str
    key_length: int
    seconds: int | None

    @property
    def step(self) -> Column:
        return F.expr(f"interval 1 {self.unit}")

    def bucket(self, ts: Column | str) -> Column:
        return F.date_trunc(self.unit, ts)

    def key(self, bucket: Column | str) -> Column:
        return F.date_format(bucket, self.key_format)


SECOND = Grain("second", "yyyyMMddHHmmss", 14, 1)
MINUTE = Grain("minute", "yyyyMMddHHmm", 12, 60)
HOUR = Grain("hour", "yyyyMMddHH", 10, 3600)
DAY = Grain("day", "yyyyMMdd", 8, 86400)
MONTH = Grain("month", "yyyyMM", 6, None)
GRAINS = {g.unit: g for g in (SECOND, MINUTE, HOUR, DAY, MONTH)}


@dataclass(frozen=True)
class Window:
    """``[begin, end)`` plus the extra time read before and after it."""

    begin: datetime
    end: datetime
    read_from: datetime
    read_to: datetime


@dataclass(frozen=True)
class WindowSpec:
    """How a job turns its fire time into a window (all in seconds)."""

    delay: int = 60
    window: int = 300
    pre: int = 0
    post: int = 0

    def at(self, fire: datetime) -> Window:
        end = fire.replace(second=0, microsecond=0) - timedelta(seconds=self.delay + self.post)
        return self.between(end - timedelta(seconds=self.window), end)

    def between(self, begin: datetime, end: datetime) -> Window:
        """The window of a backfill over ``[begin, end)``."""
        if end <= begin:
            raise ValueError("a window must end after it begins")
        return Window(
            begin,
            end,
            begin - timedelta(seconds=self.pre),
            end + timedelta(seconds=self.post),
        )


@dataclass(frozen=True)
class Level:
    """An entity grain, named, with the id columns that identify it."""

    name: str
    ids: tuple[str, ...]


SERVER = Level("server", ("app_id", "site_id", "server_id"))
SITE = Level("site", ("app_id", "site_id"))
APP = Level("app", ("app_id",))
ENTITY_LEVELS = (SERVER, SITE, APP)

# Averages are averaged as decimals: the sum of doubles depends on the order in which
# tasks finish, and a re-run must give the same table.
EXACT = "decimal(38,12)"

UNKNOWN = "999"  # id of a device the dimension does not know
ALL = "*"  # id of a column a coarser level has summed over


@dataclass(frozen=True)
class Rule:
    """How one measure of a statistics table aggregates further."""

    name: str
    kind: str
    of: tuple[str, ...] = ()
    digits: int | None = None

    def column(self) -> Column:
        src = self.of or (self.name,)
        if self.kind == "sum":
            out = F.sum(src[0])
        elif self.kind == "min":
            out = F.min(src[0])
        elif self.kind == "max":
            out = F.max(src[0])
        elif self.kind == "mean":
            exact = F.sum(F.col(src[0]).cast(EXACT))
            out = exact / F.nullif(F.count(src[0]), F.lit(0))
        elif self.kind == "ratio":
            out = percent(F.sum(src[0]), F.sum(src[1]))
        elif self.kind == "sketch":
            out = F.hll_union_agg(src[0])
        elif self.kind == "weighted":
            out = F.coalesce(
                F.sum(src[0]).cast("double") / F.nullif(F.sum(src[1]), F.lit(0)), F.lit(0.0)
            )
        else:
            raise ValueError(f"unknown rule kind {self.kind}")
        if self.digits is not None:
            out = F.round(out, self.digits)
        if self.kind == "mean":
            out = out.cast("double")
        return out.alias(self.name)


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` as a double, 0 where there is nothing to divide."""
    return F.coalesce(part.cast("double") * 100 / F.nullif(whole, F.lit(0)), F.lit(0.0))


def total(name: str) -> Rule:
    return Rule(name, "sum")


def low(name: str, of: str | None = None) -> Rule:
    return Rule(name, "min", (of,) if of else ())


def high(name: str, of: str | None = None) -> Rule:
    return Rule(name, "max", (of,) if of else ())


def mean(name: str, digits: int | None = None) -> Rule:
    """Average of averages, every input row weighing the same."""
    return Rule(name, "mean", (), digits)


def ratio(name: str, part: str, whole: str) -> Rule:
    return Rule(name, "ratio", (part, whole))


def weighted(name: str, sum_col: str, count_col: str) -> Rule:
    """Average from stored sum and count, exact over any grouping."""
    return Rule(name, "weighted", (sum_col, count_col))


def sketch(name: str) -> Rule:
    """Sketches of uniques merge over entities and time, where counts of uniques do not."""
    return Rule(name, "sketch")


def gauge_rules(*names: str, digits: int | None = None) -> list[Rule]:
    """avg/min/max rules for each gauge name."""
    rules: list[Rule] = []
    for name in names:
        rules += [mean(f"avg_{name}", digits), low(f"min_{name}"), high(f"max_{name}")]
    return rules
