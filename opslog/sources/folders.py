"""Which folders of a partitioned table hold its rows for a range of hours.

Only the days of the range are listed, then the hours of the range.  Below an hour a table may have one
folder per micro-batch or batch job.  Compaction puts those of a closed hour together in one new folder and
says so in a manifest of the day, ``_manifest/dt=D/vN.json``: which folders of an hour the new one replaces.  The
newest version of a manifest counts.  A compacted folder that no manifest names does not count, a folder that is
replaced does not count, so a reader sees each row once at any moment.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timedelta

from pyspark.sql import SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from opslog.plans.upkeep import at_once, children, read_text, write_text

MANIFEST = "_manifest"
COMPACT = "compact."


def days_of(begin: datetime, end: datetime) -> Iterator[tuple[str, str, str]]:
    """(day, first hour, last hour) of ``[begin, end)``."""
    last = end - timedelta(microseconds=1)
    day = begin.replace(hour=0, minute=0, second=0, microsecond=0)
    while day <= last:
        low = begin.strftime("%H") if day.date() == begin.date() else "00"
        high = last.strftime("%H") if day.date() == last.date() else "23"
        yield day.strftime("%Y%m%d"), low, high
        day += timedelta(days=1)


def hours(spark: SparkSession, path: str, begin: datetime, end: datetime) -> list[tuple[str, str]]:
    """(dt, hh) of the hours of a range that have a folder."""

    def of_day(day: tuple[str, str, str]) -> list[tuple[str, str]]:
        dt, low, high = day
        found = [name[3:] for name in children(spark, f"{path}/dt={dt}") if name.startswith("hh=")]
        return [(dt, hh) for hh in sorted(found) if low <= hh <= high]

    return [h for day in at_once(of_day, list(days_of(begin, end))) for h in day]


def _newest(spark: SparkSession, path: str, dt: str) -> int:
    names = children(spark, f"{path}/{MANIFEST}/dt={dt}")
    return max((int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json")), default=0)


def manifest(spark: SparkSession, path: str, dt: str) -> dict[str, dict]:
    """Per hour of a day ``compacted``, source to folder, and ``replaced``, the folders whose rows are in those."""
    version = _newest(spark, path, dt)
    return json.loads(read_text(spark, f"{path}/{MANIFEST}/dt={dt}/v{version:08d}.json")) if version else {}


def publish(spark: SparkSession, path: str, dt: str, content: dict[str, dict]) -> None:
    """The next version of a day's manifest; no version is ever written over."""
    version = _newest(spark, path, dt) + 1
    write_text(spark, f"{path}/{MANIFEST}/dt={dt}/v{version:08d}.json", json.dumps(content))


def counted(names: list[str], of_hour: dict | None) -> list[str]:
    """Those of an hour's batch folders that count."""
    entry = of_hour or {"compacted": {}, "replaced": []}
    gone, kept = set(entry["replaced"]), set(entry["compacted"].values())
    return sorted(n for n in names if n in kept or not (n in gone or n.startswith(COMPACT)))


def live(spark: SparkSession, path: str, begin: datetime, end: datetime) -> dict[tuple[str, str], list[str]]:
    """Per hour the batch folders that count, by name; an empty list where the hour's own folder holds the files."""
    found = hours(spark, path, begin, end)
    days = sorted({dt for dt, _ in found})
    known = dict(zip(days, at_once(lambda dt: manifest(spark, path, dt), days)))

    def of_hour(hour: tuple[str, str]) -> list[str] | None:
        dt, hh = hour
        names = [n[6:] for n in children(spark, f"{path}/dt={dt}/hh={hh}") if n.startswith("batch=")]
        return (counted(names, known[dt].get(hh)) or None) if names else []

    return {h: names for h, names in zip(found, at_once(of_hour, found)) if names is not None}


def paths_of(path: str, hour: tuple[str, str], names: list[str]) -> list[str]:
    folder = f"{path}/dt={hour[0]}/hh={hour[1]}"
    return [f"{folder}/batch={n}" for n in names] or [folder]


def some_folder(spark: SparkSession, path: str) -> str | None:
    """A folder with files, the newest hour's if it has any: for the schema of a table without rows in a range."""
    names = children(spark, path)
    for name in sorted((n for n in names if "=" in n), reverse=True):
        found = some_folder(spark, f"{path}/{name}")
        if found:
            return found
    return path if any("=" not in n and n[0] not in "_." for n in names) else None


def schema_of(spark: SparkSession, folder: str) -> StructType:
    """Columns of a table's files and of its folders; the latter are text, so hour ``08`` is no number."""
    keys = [part.split("=", 1)[0] for part in folder.split("/") if "=" in part]
    keys = [k for k in ("dt", "hh", "batch") if k in keys]
    fields = [f for f in spark.read.parquet(folder).schema.fields if f.name not in keys]
    return StructType([*fields, *[StructField(k, StringType()) for k in keys]])
