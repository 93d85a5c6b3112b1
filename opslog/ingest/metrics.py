"""Agent metrics of hosts and counter readings of switches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.ingest.envelope import BAD_JSON, BAD_TIME, finish, first_reason

# The shape of a sample, the header some agents prepend, the plugins
# and the categories each metric table keeps.
SAMPLE = (
    "array<struct<values: array<string>, dstypes: array<string>, dsnames: array<string>, time: double, "
    "interval: string, host: string, plugin: string, plugin_instance: string, type: string, "
    "type_instance: string, meta: string>>"
)
HEADER_LENGTH = 15
MOUNT_PLUGIN = "df"
METRIC_TABLES = {
    "cpu": ("cpu", ["idle", "system", "user"]),
    "mem": ("memory", ["used"]),
    "disk": ("df", ["free", "used"]),
}
SWITCH_PLUGIN = "snmp"
SKIPPED_INTERFACES = "Link"
METRIC_COLUMNS = [
    "values", "ds_types", "ds_names", "sample_time", "interval", "host", "plugin", "plugin_instance",
    "type", "type_instance", "meta",
]


def parse_samples(lines: DataFrame) -> DataFrame:
    """One row per sample of each JSON array; a line that is none is one refused row."""
    start = F.col("value").startswith("[") | F.col("value").startswith("{")
    body = F.when(start, F.col("value")).otherwise(
        F.substring("value", F.lit(HEADER_LENGTH + 1), F.length("value"))
    )
    samples = lines.select("value", F.explode_outer(F.from_json(body, SAMPLE)).alias("s"))
    mount = F.when(F.col("s.plugin") == MOUNT_PLUGIN, F.translate("s.plugin_instance", "-", "/"))
    seconds = F.col("s.time").cast("bigint")
    parsed = samples.select(
        _listed("s.values").alias("values"),
        _listed("s.dstypes").alias("ds_types"),
        _listed("s.dsnames").alias("ds_names"),
        F.timestamp_seconds(seconds).alias("sample_time"),
        F.col("s.interval").alias("interval"),
        F.upper("s.host").alias("host"),
        F.col("s.plugin").alias("plugin"),
        F.coalesce(mount, F.col("s.plugin_instance"), F.lit("")).alias("plugin_instance"),
        F.col("s.type").alias("type"),
        F.coalesce("s.type_instance", F.lit("")).alias("type_instance"),
        F.coalesce("s.meta", F.lit("")).alias("meta"),
        "value",
        first_reason((F.col("s.host").isNotNull(), BAD_JSON), (seconds.isNotNull(), BAD_TIME)),
    )
    return finish(parsed, "sample_time", METRIC_COLUMNS)


def _listed(name: str) -> Column:
    return F.array_join(name, ",")


def host_metrics(samples: DataFrame) -> dict[str, DataFrame]:
    """The rows of each host metric table, from one parse."""
    out = {}
    for table, (plugin, kept) in METRIC_TABLES.items():
        own = (F.col("plugin") == plugin) | (F.col("type") == plugin)
        out[table] = samples.filter(own & F.col("type_instance").isin(kept))
    return out


def switch_metrics(samples: DataFrame) -> DataFrame:
    return samples.filter(
        (F.col("plugin") == SWITCH_PLUGIN) & ~F.col("type_instance").startswith(SKIPPED_INTERFACES)
    )
