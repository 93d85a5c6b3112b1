"""Where the tables of a deployment live and how they are laid out."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslog.functions.timekeys import instant
from opslog.operators.dims import calendar
from opslog.plans.windows import SLOT_SECONDS
from opslog.sinks.tables import save
from opslog.sources.tables import PORT_FILE, ROUTER_FILE, SERVER_FILE, read_dimension, read_window
from opslog.spec import DAY, HOUR, MINUTE, MONTH, Grain, Window

# Time column of every raw table.
RAW_TIME = {
    "route_log": "log_time",
    "status_log": "log_time",
    "router_web_log": "log_time",
    "session_log": "registered_at",
    "probe_log": "test_time",
    "web_log": "log_time",
    "cpu": "sample_time",
    "mem": "sample_time",
    "disk": "sample_time",
    "network": "sample_time",
}
DIM_SCHEMA = {"servers": SERVER_FILE, "ports": PORT_FILE, "routers": ROUTER_FILE}
PARTITIONS = {MINUTE: ["dt", "hh", "slot"], HOUR: ["dt", "hh"], DAY: ["dt"], MONTH: ["mm"]}


@dataclass(frozen=True)
class Lake:
    """Raw tables, dimensions and statistics below one root folder."""

    spark: SparkSession
    root: str

    def raw_path(self, name: str) -> str:
        return f"{self.root}/raw/{name}"

    def dim_path(self, name: str) -> str:
        return f"{self.root}/dim/{name}"

    def stat_path(self, name: str, grain: Grain) -> str:
        return f"{self.root}/{grain.unit}/{name}"

    def raw(self, name: str, begin: datetime, end: datetime) -> DataFrame:
        return read_window(self.spark, self.raw_path(name), RAW_TIME[name], begin, end)

    def dim(self, name: str) -> DataFrame:
        return read_dimension(self.spark, self.dim_path(name), DIM_SCHEMA[name])

    def stat(self, name: str, grain: Grain, begin: datetime, end: datetime) -> DataFrame:
        """Statistics rows of ``[begin, end)``; only the partitions of the range are read."""
        table = self.spark.read.parquet(self.stat_path(name, grain))
        low, high = instant(begin), instant(end)
        rows = table.where((F.col("bucket") >= low) & (F.col("bucket") < high))
        if grain == MONTH:
            return rows.where(F.col("mm").cast("string") >= begin.strftime("%Y%m"))
        return rows.where(F.col("dt").cast("string").between(begin.strftime("%Y%m%d"), end.strftime("%Y%m%d")))

    def write_stat(self, df: DataFrame, name: str, grain: Grain, stamp: datetime | None = None) -> None:
        """Replace the folders ``df`` has rows for; every row gets the load stamp."""
        at = instant(stamp) if stamp else F.current_timestamp()
        stamped = with_partitions(df, grain).withColumn("chg_date", at)
        save(stamped, self.stat_path(name, grain), PARTITIONS[grain])


def with_partitions(df: DataFrame, grain: Grain) -> DataFrame:
    """Statistics columns plus the text key and the partition columns."""
    out = df.withColumn("stat_key", grain.key("bucket"))
    if grain == MONTH:
        return out.withColumn("mm", F.col("stat_key"))
    out = out.withColumn("dt", DAY.key("bucket"))
    if grain in (MINUTE, HOUR):
        out = out.withColumn("hh", F.date_format("bucket", "HH"))
    if grain == MINUTE:
        minutes = SLOT_SECONDS // 60
        slot = F.minute("bucket") - F.minute("bucket") % minutes
        out = out.withColumn("slot", F.lpad(slot.cast("string"), 2, "0"))
    return out


def window_frame(dim: DataFrame, window: Window, grain: Grain, role: str | None = None) -> DataFrame:
    """Calendar of a job's window over a dimension."""
    days = (window.end - window.begin).days
    return calendar(dim, window.begin, window.end, grain, role, spread=max(1, days))
