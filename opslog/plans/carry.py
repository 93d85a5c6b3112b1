"""Concurrency window by window, with the sessions that are still open handed from one window to the next.

A window reads the rows that begin in it and what the window before handed on, so a session counts in every
window that it touches however long it is, and no window reads further back.  What is handed on is one row
per open session, stored per border; a re-run of a window starts from the same border and replaces
the next one.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.functions.timekeys import instant
from opslog.operators.concurrency import still_open
from opslog.plans.lake import Lake
from opslog.plans.minute import OFF, ccu_of
from opslog.plans.run import LOOK_BACK
from opslog.plans.upkeep import drop_folders, partitions
from opslog.plans.windows import WINDOWS, aligned, pieces
from opslog.spec import MINUTE, Window

TABLE = "ccu"
BORDER = "%Y%m%d%H%M"
KEEP_BORDERS = timedelta(days=7)  # how far back a window may be run again from what was handed to it


def _path(lake: Lake) -> str:
    return f"{lake.root}/carry/{TABLE}"


def _sessions(lake: Lake, begin: datetime, end: datetime) -> DataFrame:
    log = lake.raw("session_log", begin, end).filter(F.col("motion") == OFF)
    return log.select("server_ip", "client_id", F.col("registered_at").alias("on_at"), "off_at")


def handed_on(lake: Lake, at: datetime, look_back: timedelta = LOOK_BACK) -> DataFrame:
    """Sessions open at a border; where none are stored (a first window), those of the ``look_back`` before it."""
    key = at.strftime(BORDER)
    stored = [f for v, f in partitions(lake.spark, _path(lake), 1) if v["at"] == key]
    if stored:
        return lake.spark.read.parquet(stored[0])
    return still_open(_sessions(lake, at - look_back, at), instant(at))


def run_carried(lake: Lake, window: Window, look_back: timedelta = LOOK_BACK) -> None:
    """Write a window's concurrency and the sessions it hands on."""
    if not aligned(window):
        raise ValueError("a written window must start and end on slot borders")
    sessions = _sessions(lake, window.begin, window.end).unionByName(handed_on(lake, window.begin, look_back))
    lake.write_stat(ccu_of(lake, sessions, window, MINUTE), TABLE, MINUTE, datetime.now())
    path = f"{_path(lake)}/at={window.end.strftime(BORDER)}"
    still_open(sessions, instant(window.end)).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    oldest = (window.end - KEEP_BORDERS).strftime(BORDER)
    drop_folders(lake.spark, [f for v, f in partitions(lake.spark, _path(lake), 1) if v["at"] < oldest])


def backfill_carried(lake: Lake, begin: datetime, end: datetime, step: timedelta = timedelta(days=1)) -> int:
    """``[begin, end)`` window by window, each on what the one before handed on."""
    done = 0
    for window in pieces(WINDOWS[TABLE], begin, end, step):
        run_carried(lake, window)
        done += 1
    return done
