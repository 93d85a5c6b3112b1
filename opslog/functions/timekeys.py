"""Time keys, partition columns and partition predicates."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from opslog.spec import MINUTE

RAW_TIME = "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]"


def minute_key(ts: Column | str) -> Column:
    return F.date_format(ts, MINUTE.key_format)


def day_part(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyyMMdd").alias("dt")


def hour_part(ts: Column | str) -> Column:
    return F.date_format(ts, "HH").alias("hh")


def parts_from_key(key: Column) -> tuple[Column, Column]:
    """``dt`` and ``hh`` cut from a minute or hour key."""
    return F.substring(key, 1, 8).alias("dt"), F.substring(key, 9, 2).alias("hh")


def epoch(ts: Column | str) -> Column:
    """Whole seconds since 1970."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_seconds(col.cast("timestamp"))


def seconds_between(start: Column | str, stop: Column | str) -> Column:
    return epoch(stop) - epoch(start)


def from_epoch_text(seconds: Column) -> Column:
    """Epoch seconds as ``yyyy-MM-dd HH:mm:ss.SSS``."""
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm:ss.SSS")


def parse_time(text: Column) -> Column:
    """Log time with or without a fraction; null where it is not a time."""
    return F.try_to_timestamp(text, F.lit(RAW_TIME))


def parse_web_time(text: Column, zoned: bool = False) -> Column:
    """``dd/MMM/yyyy:HH:mm:ss +zzzz`` as the wall clock the line shows, or ``zoned`` as the instant it means.

    A line without an offset is wall clock in both cases.
    """
    wall = F.try_to_timestamp(F.substring(text, 1, 20), F.lit("dd/MMM/yyyy:HH:mm:ss"))
    return F.coalesce(F.try_to_timestamp(text, F.lit("dd/MMM/yyyy:HH:mm:ss Z")), wall) if zoned else wall


def instant(when: datetime) -> Column:
    """A wall-clock time in the session's zone.

    A Python time as a literal would be read in the driver's own zone, while partition names are
    wall clock: so the text is what travels.
    """
    return F.lit(when.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def in_range(ts: str, begin: datetime, end: datetime) -> Column:
    """Half-open ``[begin, end)``."""
    return (F.col(ts) >= instant(begin)) & (F.col(ts) < instant(end))


def partition_predicate(begin: datetime, end: datetime) -> Column:
    """The ``dt``/``hh`` partitions that ``[begin, end)`` touches.

    Whole days in between need no hour test, so the predicate has at most three
    terms however long the range is, and every term is a partition filter.
    """
    last = end - timedelta(microseconds=1)
    first_day, first_hour = begin.strftime("%Y%m%d"), begin.strftime("%H")
    last_day, last_hour = last.strftime("%Y%m%d"), last.strftime("%H")
    dt, hh = F.col("dt"), F.col("hh")
    if first_day == last_day:
        return (dt == first_day) & (hh >= first_hour) & (hh <= last_hour)
    return (
        ((dt == first_day) & (hh >= first_hour))
        | ((dt > first_day) & (dt < last_day))
        | ((dt == last_day) & (hh <= last_hour))
    )
