"""Running jobs: one window, a backfill, a roll-up, the dashboard, the retention."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.functions.timekeys import instant
from opslog.operators.snapshot import at_latest_bucket, combine
from opslog.plans.lake import PARTITIONS, RAW_TIME, Lake
from opslog.plans.minute import JOBS, SPARSE_TABLES
from opslog.plans.rollups import ROLLUPS, roll
from opslog.plans.upkeep import KEEP_DAYS, STRFTIME, delete_range, drop_folders, drop_old_days, drop_old_rollups, partitions
from opslog.plans.windows import SLOT_SECONDS, WINDOWS, aligned, at_fire, hour_of, pieces
from opslog.sinks.tables import merge_snapshot, save_snapshot
from opslog.spec import DAY, HOUR, MINUTE, MONTH, Grain, Window

WINDOW_OF = {"switches": "hosts", "uvpv_sketch": "uvpv"}
LOOK_BACK = timedelta(days=2)  # longest session that a backfill sees whole


def run_window(lake: Lake, job: str, window: Window, drop_first: bool = False) -> list[str]:
    """Write the tables of one job for one window; a re-run replaces the same folders.

    ``drop_first`` also clears folders of the window that got no rows, after the write.
    """
    if not aligned(window):
        raise ValueError("a written window must start and end on slot borders")
    written = []
    for name, table in JOBS[job](lake, window).items():
        stamp = datetime.now()
        lake.write_stat(table, name, MINUTE, stamp)
        if drop_first or name in SPARSE_TABLES:
            low, high = (t.strftime("%Y%m%d%H%M") for t in (window.begin, window.end))
            drop_stale(lake, name, MINUTE, low, high, stamp)
        written.append(name)
    return written


def drop_stale(lake: Lake, table: str, grain: Grain, low: str, high: str, stamp: datetime) -> int:
    """Drop the folders of the key range ``[low, high)`` that the write of ``stamp`` gave no rows.

    The new rows are in place by then: a job that fails leaves the old ones.
    """
    columns = PARTITIONS[grain]
    path = lake.stat_path(table, grain)
    inside = [("".join(v[c] for c in columns), f) for v, f in partitions(lake.spark, path, len(columns))]
    inside = [(k, f) for k, f in inside if low <= k < high]
    if not inside:
        return 0
    fresh = lake.spark.read.option("basePath", path).parquet(*[f for _, f in inside])
    fresh = fresh.where(F.col("chg_date") == instant(stamp)).select(F.substring("stat_key", 1, 12).alias("k")).distinct()
    kept = {_folder_key(r["k"], grain) for r in fresh.collect()}
    return drop_folders(lake.spark, [f for k, f in inside if k not in kept])


def _folder_key(stat_key: str, grain: Grain) -> str:
    """The folder of a row: minutes are kept by slot."""
    if grain != MINUTE:
        return stat_key
    minutes = SLOT_SECONDS // 60
    return f"{stat_key[:10]}{int(stat_key[10:12]) // minutes * minutes:02d}"


def run_at(lake: Lake, job: str, fire: datetime) -> list[str]:
    """The window that is complete at a fire time."""
    return run_window(lake, job, at_fire(WINDOWS[WINDOW_OF.get(job, job)], fire))


def backfill(
    lake: Lake,
    job: str,
    begin: datetime,
    end: datetime,
    step: timedelta = timedelta(days=1),
    drop_first: bool = False,
    look_back: timedelta = LOOK_BACK,
) -> int:
    """Recompute ``[begin, end)``, one Spark job per ``step``.

    A job that looks back (sessions that run when the window begins) reads ``look_back`` of what is
    there by then, where its five-minute run reads the little that is ready in time.
    """
    done = 0
    spec = WINDOWS[WINDOW_OF.get(job, job)]
    for window in pieces(spec, begin, end, step):
        if spec.pre:
            window = replace(window, read_from=min(window.read_from, window.begin - look_back))
        run_window(lake, job, window, drop_first)
        done += 1
    return done


def drop_slots(lake: Lake, table: str, window: Window) -> int:
    """Drop a table's folders inside a window."""
    low, high = (t.strftime("%Y%m%d%H%M") for t in (window.begin, window.end))
    found = partitions(lake.spark, lake.stat_path(table, MINUTE), 3)
    return drop_folders(
        lake.spark, [folder for v, folder in found if low <= v["dt"] + v["hh"] + v["slot"] < high]
    )


def run_rollup(lake: Lake, table: str, to: Grain, begin: datetime, end: datetime, exact: bool = False) -> None:
    """Write the keys of ``[begin, end)``; of a sparse table, keys that have no rows any more go."""
    stamp = datetime.now()
    lake.write_stat(roll(lake, table, to, begin, end, exact), table, to, stamp)
    if table in SPARSE_TABLES:
        low, high = (t.strftime(STRFTIME[to.unit]) for t in (begin, end))
        if to == MONTH:
            high = f"{high}~"  # the month of the last day counts
        drop_stale(lake, table, to, low, high, stamp)


def run_hour(lake: Lake, fire: datetime, tables: list[str] | None = None) -> None:
    """Hour roll-up of every table at a fire time."""
    begin, end = hour_of(fire)
    for table in tables or list(ROLLUPS):
        run_rollup(lake, table, HOUR, begin, end)


def run_day(lake: Lake, day: datetime, tables: list[str] | None = None) -> None:
    """Day roll-up; on the first of a month also the month before."""
    begin = day.replace(hour=0, minute=0, second=0, microsecond=0) - timedelta(days=1)
    for table in tables or list(ROLLUPS):
        run_rollup(lake, table, DAY, begin, begin + timedelta(days=1))
        if day.day == 1:
            first = begin.replace(day=1)
            run_rollup(lake, table, MONTH, first, begin + timedelta(days=1))


def dashboard(lake: Lake, begin: datetime, end: datetime) -> DataFrame:
    """Latest concurrency, views and traffic per site and per app, one row per id."""

    def latest(table: str, measures: dict[str, str]) -> DataFrame:
        rows = lake.stat(table, MINUTE, begin, end).filter("level = 'site'")
        shown = [F.col(source).cast("bigint").alias(name) for name, source in measures.items()]
        return at_latest_bucket(rows).select("app_id", "site_id", *shown)

    sites = combine(
        [
            latest("ccu", {"ccu": "max_ccu"}),
            latest("uvpv", {"uv": "uv", "pv": "pv"}),
            latest("bandwidth", {"traffic": "max_mbps"}),
        ],
        ["app_id", "site_id"],
    )
    names = ["ccu", "uv", "pv", "traffic"]
    per_site = sites.select(F.concat_ws("_", "app_id", "site_id").alias("id"), *names)
    per_app = sites.groupBy("app_id").agg(*[F.sum(n).alias(n) for n in names])
    return per_site.unionByName(per_app.withColumnRenamed("app_id", "id").select("id", *names))


def publish_dashboard(lake: Lake, begin: datetime, end: datetime, path: str, now: datetime) -> None:
    """Upsert the snapshot.  The new one is written beside the old one it reads."""
    fresh = dashboard(lake, begin, end).withColumn("chg_date", instant(now))
    schema = "id STRING, ccu BIGINT, uv BIGINT, pv BIGINT, traffic BIGINT, chg_date TIMESTAMP"
    versions = sorted(v["version"] for v, _ in partitions(lake.spark, path, 1))
    old = None
    if versions:
        old = lake.spark.read.csv(f"{path}/version={versions[-1]}", sep="|", schema=schema)
    merged = merge_snapshot(old, fresh, ["id"], "chg_date")
    save_snapshot(merged, f"{path}/version={now.strftime('%Y%m%d%H%M%S')}")


def retention(lake: Lake, today: datetime) -> int:
    """Drop what is older than each table's span."""
    dropped = 0
    for table in ROLLUPS:
        dropped += drop_old_days(lake.spark, lake.stat_path(table, MINUTE), today, KEEP_DAYS["stat"])
        for grain in (HOUR, DAY, MONTH):
            dropped += drop_old_rollups(lake.spark, lake.stat_path(table, grain), grain, today)
    for raw in RAW_TIME:
        keep = KEEP_DAYS["web" if raw.endswith("web_log") else "raw"]
        dropped += drop_old_days(lake.spark, lake.raw_path(raw), today, keep)
    return dropped


def forget(lake: Lake, grain: Grain, start: str, end: str | None = None) -> int:
    """Delete a key range of one grain from every roll-up table."""
    return sum(
        delete_range(lake.spark, lake.stat_path(table, grain), grain.unit, start, end) for table in ROLLUPS
    )
