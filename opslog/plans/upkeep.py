"""Retention, range deletes and re-runs on partitioned tables.

All of it works on partition folders through the Hadoop file system of the
session, so it is the same on a cluster's shared storage and on a local disk, and
no row is read to delete a row.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslog.spec import DAY, GRAINS, HOUR, MONTH, Grain

CALLS = 16  # to the file system at the same time

# Days each kind of table is kept, and the spans of the roll-ups.
KEEP_DAYS = {"stat": 180, "raw": 180, "web": 7}
KEEP_ROLLUP = {"hour": ("months", 1), "day": ("months", 6), "month": ("months", 60)}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def partitions(spark: SparkSession, path: str, depth: int) -> Iterator[tuple[dict[str, str], str]]:
    """Partition values and folder of every partition ``depth`` levels down."""
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return
    level = [({}, root)]
    for _ in range(depth):
        below = []
        for values, folder in level:
            for status in fs.listStatus(folder):
                name = status.getPath().getName()
                if status.isDirectory() and "=" in name:
                    key, value = name.split("=", 1)
                    below.append(({**values, key: value}, status.getPath()))
        level = below
    for values, folder in level:
        yield values, folder.toString()


def children(spark: SparkSession, path: str) -> dict[str, float]:
    """Names directly below a folder, with the time (epoch seconds) of their last change; none if it is not there."""
    fs, folder = _fs(spark, path)
    if not fs.exists(folder):
        return {}
    return {s.getPath().getName(): s.getModificationTime() / 1000 for s in fs.listStatus(folder)}


def at_once(fn, items: list) -> list:
    """``fn`` of every item; several calls to the file system under way together."""
    if len(items) < 4:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(CALLS) as pool:
        return list(pool.map(fn, items))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file in one step: written under another name, then renamed over what is there."""
    jvm = spark.sparkContext._jvm
    fs, target = _fs(spark, path)
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
    out = fs.create(part, True)
    try:
        out.write(text.encode())
    finally:
        out.close()
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(part, target):
        raise RuntimeError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is none."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def drop_folders(spark: SparkSession, folders: list[str]) -> int:
    def drop(folder: str) -> None:
        fs, hpath = _fs(spark, folder)
        fs.delete(hpath, True)

    at_once(drop, folders)
    return len(folders)


def drop_old_days(spark: SparkSession, path: str, today: datetime, keep_days: int) -> int:
    """Drop the ``dt`` partitions up to ``today - keep_days``."""
    limit = (today - timedelta(days=keep_days)).strftime("%Y%m%d")
    drop_folders(spark, [f for v, f in partitions(spark, f"{path}/_manifest", 1) if v["dt"] <= limit])
    return drop_folders(spark, [f for v, f in partitions(spark, path, 1) if v["dt"] <= limit])


def months_back(day: datetime, months: int) -> datetime:
    """The same day ``months`` months earlier, or the last day of that month."""
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    first_of_next = datetime(year + (month + 1) // 12, (month + 1) % 12 + 1, 1)
    last = (first_of_next - timedelta(days=1)).day
    return day.replace(year=year, month=month + 1, day=min(day.day, last))


def drop_old_rollups(spark: SparkSession, path: str, grain: Grain, today: datetime) -> int:
    """Drop roll-up keys older than the span its grain is kept for."""
    _, months = KEEP_ROLLUP[grain.unit]
    limit = months_back(today, months).strftime(STRFTIME[grain.unit])
    return drop_folders(spark, [f for k, f in _keys(spark, path, grain) if k < limit])


STRFTIME = {"hour": "%Y%m%d%H", "day": "%Y%m%d", "month": "%Y%m"}
LAYOUT = {"hour": ["dt", "hh"], "day": ["dt"], "month": ["mm"]}


def layout(df: DataFrame, grain: Grain, bucket: str = "bucket") -> DataFrame:
    """Add the partition columns of a roll-up table, so that one key is one folder."""
    if grain == MONTH:
        return df.withColumn("mm", MONTH.key(bucket))
    out = df.withColumn("dt", DAY.key(bucket))
    return out.withColumn("hh", F.date_format(bucket, "HH")) if grain == HOUR else out


def _keys(spark: SparkSession, path: str, grain: Grain) -> Iterator[tuple[str, str]]:
    columns = LAYOUT[grain.unit]
    for values, folder in partitions(spark, path, len(columns)):
        yield "".join(values[c] for c in columns), folder


def check_key(grain: Grain, key: str) -> str:
    """A key must have the digits of its grain and be a real time."""
    if len(key) != grain.key_length or not key.isdigit():
        raise ValueError(f"{key!r} is not a {grain.unit} key")
    datetime.strptime(key, STRFTIME[grain.unit])
    return key


def delete_range(spark: SparkSession, path: str, unit: str, start: str, end: str | None = None) -> int:
    """Delete the keys ``start..end`` (both included; one key without ``end``)."""
    grain = GRAINS[unit]
    low = check_key(grain, start)
    high = check_key(grain, end) if end else low
    if high < low:
        raise ValueError("the range ends before it starts")
    return drop_folders(spark, [f for k, f in _keys(spark, path, grain) if low <= k <= high])
