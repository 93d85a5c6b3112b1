"""Closed hours of streamed tables in few files.

A stream writes a folder per micro-batch and hour.  ``compact`` reads those of one source for all closed hours of a
range, writes them once more as one folder per hour, and then publishes the switch day by day (see
``sources/folders.py``).  If it fails before that, readers go on with the old folders.  ``sweep`` removes what is
replaced, and what a failed run left, once no reader that started earlier can still need it.
Folders of batch jobs are left alone: their rows are replaced by name.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from opslog.plans.upkeep import at_once, children, drop_folders
from opslog.sinks.tables import save
from opslog.sources.folders import COMPACT, counted, hours, live, manifest, paths_of, publish, schema_of

GRACE_SECONDS = 6 * 3600  # what a reader may take that listed the old folders


def _of_source(names: list[str], source: str) -> list[str]:
    """A stream's folders: source.run.batch, and what was compacted of it before."""
    mine = re.compile(rf"{re.escape(source)}\.[^.]+\.\d+$|{re.escape(COMPACT + source)}\.[^.]+$")
    return [n for n in names if mine.match(n)]


def compact(
    spark: SparkSession,
    path: str,
    source: str,
    begin: datetime,
    end: datetime,
    least: int = 2,
    before_switch: Callable[[], None] = lambda: None,
) -> int:
    """Compact the hours of ``[begin, end)``, which must be closed; the number of hours with ``least`` folders or more."""
    work = {h: _of_source(names, source) for h, names in live(spark, path, begin, end).items()}
    work = {h: names for h, names in work.items() if len(names) >= least}
    if not work:
        return 0
    folders = [f for h, names in work.items() for f in paths_of(path, h, names)]
    name = f"{COMPACT}{source}.{uuid.uuid4().hex}"
    rows = spark.read.schema(schema_of(spark, folders[0])).option("basePath", path).parquet(*folders)
    save(rows.withColumn("batch", F.lit(name)), path, ["dt", "hh", "batch"])
    before_switch()
    for dt in sorted({dt for dt, _ in work}):
        content = manifest(spark, path, dt)
        for (day, hh), names in work.items():
            if day == dt:
                old = content.get(hh, {"compacted": {}, "replaced": []})
                content[hh] = {"compacted": {**old["compacted"], source: name}, "replaced": sorted({*old["replaced"], *names})}
        publish(spark, path, dt, content)
    return len(work)


def sweep(spark: SparkSession, path: str, begin: datetime, end: datetime, grace: float = GRACE_SECONDS) -> int:
    """Remove replaced folders, and compacted ones that were never published, older than ``grace`` seconds."""
    limit = time.time() - grace
    found = hours(spark, path, begin, end)
    known = {dt: manifest(spark, path, dt) for dt in {dt for dt, _ in found}}

    def spare(hour: tuple[str, str]) -> list[str]:
        dt, hh = hour
        folder = f"{path}/dt={dt}/hh={hh}"
        times = {n[6:]: at for n, at in children(spark, folder).items() if n.startswith("batch=")}
        kept = set(counted(list(times), known[dt].get(hh)))
        return [f"{folder}/batch={n}" for n, at in times.items() if n not in kept and at <= limit]

    return drop_folders(spark, [f for folders in at_once(spare, found) for f in folders])
