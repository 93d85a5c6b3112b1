"""Gauges, bandwidth, host metrics and switch ports on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from opslog.catalog.base import (
    PLACES, VALUE, K, buckets, leveled, mean_units, places, prop_k, query, servers, six_digits, table,
    units, value_dec,
)
from opslog.functions.measures import mbps
from opslog.functions.text import pair_value, port_number
from opslog.operators.dims import by_levels, calendar, level_frame, span, zero_fill
from opslog.operators.gauge import (
    by_category, finish_columns, finish_gauge, gauge_parts, gauge_zeros, merge_port_parts,
    port_gauge, port_parts,
)
from opslog.operators.last_sample import EMPTY, last_sample
from opslog.operators.rollup import rollup_entity
from opslog.operators.sequence import newest
from opslog.spec import DAY, ENTITY_LEVELS, HOUR, gauge_rules

IDS = ["app_id", "site_id", "server_id"]
KEYS = ["bucket", *IDS]


def server_calendar(spark, sf_dir, events, grain):
    return calendar(servers(spark, sf_dir), *span(events, "ts", grain), grain)


def server_gauge(spark, sf_dir, samples, values, events, grain=HOUR):
    """Zero-filled gauge per server; samples are reduced per user before the lookup."""
    parts = gauge_parts(samples, [grain.bucket("ts").alias("bucket"), "user_id"], values)
    stats = finish_gauge(parts.join(places(spark, sf_dir), "user_id"), KEYS, list(values))
    frame = server_calendar(spark, sf_dir, events, grain)
    return zero_fill(stats, frame, KEYS, gauge_zeros(list(values)))


def show(df, grain, names):
    """Key as text, gauges as doubles."""
    cols = [F.col(f"{m}_{n}").cast("double").alias(f"{m}_{n}") for n in names for m in ("avg", "min", "max")]
    rest = [c for c in df.columns if c != "bucket" and not c.startswith(("avg_", "min_", "max_"))]
    return df.select(grain.key("bucket").alias("stat_key"), *rest, *cols)


def click_gauge(spark, sf_dir, digits=None):
    events = table(spark, sf_dir, "events")
    clicks = events.filter("event_type = 'click'")
    filled = server_gauge(spark, sf_dir, clicks, {"session": value_dec()}, events)
    return rollup_entity(filled, ENTITY_LEVELS, gauge_rules("session", digits=digits))


@query(
    "session_gauge",
    f"""WITH {PLACES}, {buckets('hour')},
s AS (SELECT date_trunc('hour', ts) AS bucket, app_id, site_id, server_id,
        CAST(sum({VALUE}) AS DOUBLE) / count(*) AS a, min(value) AS lo, max(value) AS hi
      FROM events JOIN places USING (user_id) WHERE event_type = 'click' GROUP BY ALL),
z AS (SELECT cal.bucket, dim.*, coalesce(a, 0) AS a, coalesce(lo, 0) AS lo, coalesce(hi, 0) AS hi
      FROM cal CROSS JOIN dim LEFT JOIN s USING (bucket, app_id, site_id, server_id)),
l AS {leveled(f'{mean_units(units("a"))} AS a, min(lo) AS lo, max(hi) AS hi', 'z')}
SELECT strftime(bucket, '%Y%m%d%H') AS stat_key, level, app_id, site_id, server_id,
       {six_digits('a')} AS avg_session, lo AS min_session, hi AS max_session FROM l""",
)
def session_gauge(spark, sf_dir):
    return show(click_gauge(spark, sf_dir, digits=6), HOUR, ["session"])


MBPS = "CAST(round(value * 1000000 * 8 / 60 / 1024 / 1024, 2) AS DECIMAL(18,2))"


def bandwidth_stats(spark, sf_dir, grain=HOUR):
    """Bandwidth of all levels over samples, not over server averages."""
    events = table(spark, sf_dir, "events")
    samples = events.filter("event_type = 'view'")
    speed = {"mbps": mbps(F.col("value") * 1000000)}
    parts = gauge_parts(samples, [grain.bucket("ts").alias("bucket"), "user_id"], speed)
    placed = parts.join(places(spark, sf_dir), "user_id")
    stats = by_levels(placed, ENTITY_LEVELS, finish_columns(["mbps"], digits=2), also=["bucket"])
    frame = calendar(
        level_frame(servers(spark, sf_dir), ENTITY_LEVELS), *span(events, "ts", grain), grain
    )
    return zero_fill(stats, frame, [*KEYS, "level"], gauge_zeros(["mbps"]))


BANDWIDTH = f"""f AS (SELECT date_trunc('hour', ts) AS bucket, app_id, site_id, server_id,
        CAST({MBPS} * 100 AS BIGINT) AS cents
      FROM events JOIN places USING (user_id) WHERE event_type = 'view'),
s AS {leveled('''((2 * sum(cents) + count(*)) // (2 * count(*))) / 100.0 AS a,
        min(cents) / 100.0 AS lo, max(cents) / 100.0 AS hi''', 'f')},
bw AS (SELECT level, bucket, app_id, site_id, server_id, coalesce(a, 0) AS avg_mbps,
         coalesce(lo, 0) AS min_mbps, coalesce(hi, 0) AS max_mbps
       FROM cal CROSS JOIN ent LEFT JOIN s USING (level, bucket, app_id, site_id, server_id))"""


@query(
    "bandwidth",
    f"""WITH {PLACES}, {buckets('hour')}, {BANDWIDTH}
SELECT strftime(bucket, '%Y%m%d%H') AS stat_key, level, app_id, site_id, server_id,
       CAST(avg_mbps AS DOUBLE) AS avg_mbps, CAST(min_mbps AS DOUBLE) AS min_mbps,
       CAST(max_mbps AS DOUBLE) AS max_mbps FROM bw""",
)
def bandwidth(spark, sf_dir):
    return show(bandwidth_stats(spark, sf_dir), HOUR, ["mbps"])


CATEGORIES = {"view": "user", "click": "system", "error": "idle"}


@query(
    "category_pivot",
    f"""WITH {PLACES}, {buckets('hour')},
s AS (SELECT date_trunc('hour', ts) AS bucket, app_id, site_id, server_id,
{','.join(f'''
        CAST(sum({VALUE}) FILTER (event_type = '{c}') AS DOUBLE)
          / count(*) FILTER (event_type = '{c}') AS avg_{n},
        min(value) FILTER (event_type = '{c}') AS min_{n},
        max(value) FILTER (event_type = '{c}') AS max_{n}''' for c, n in CATEGORIES.items())}
      FROM events JOIN places USING (user_id) GROUP BY ALL)
SELECT strftime(cal.bucket, '%Y%m%d%H') AS stat_key, dim.*,
{','.join(f'coalesce({m}_{n}, 0.0) AS {m}_{n}' for n in CATEGORIES.values() for m in ('avg', 'min', 'max'))}
FROM cal CROSS JOIN dim LEFT JOIN s USING (bucket, app_id, site_id, server_id)""",
)
def category_pivot(spark, sf_dir):
    """One gauge per category (host CPU: user, system, idle)."""
    events = table(spark, sf_dir, "events")
    wanted = events.filter(F.col("event_type").isin(*CATEGORIES))
    values = by_category("event_type", value_dec(), CATEGORIES)
    filled = server_gauge(spark, sf_dir, wanted, values, events)
    return show(filled, HOUR, list(CATEGORIES.values()))


@query(
    "memory_gauge",
    f"""WITH {PLACES}, {buckets('day')},
s AS (SELECT date_trunc('day', ts) AS bucket, app_id, site_id, server_id,
        CAST(sum({VALUE}) AS DOUBLE) / count(*) AS a, min(value) AS lo, max(value) AS hi
      FROM events JOIN places USING (user_id) WHERE event_type = 'purchase' GROUP BY ALL)
SELECT strftime(cal.bucket, '%Y%m%d') AS stat_key, dim.*, coalesce(a, 0) AS avg_used,
       coalesce(lo, 0) AS min_used, coalesce(hi, 0) AS max_used
FROM cal CROSS JOIN dim LEFT JOIN s USING (bucket, app_id, site_id, server_id)""",
)
def memory_gauge(spark, sf_dir):
    """A single category (host memory: used)."""
    events = table(spark, sf_dir, "events")
    used = events.filter("event_type = 'purchase'")
    filled = server_gauge(spark, sf_dir, used, {"used": value_dec()}, events, DAY)
    return show(filled, DAY, ["used"])


def disk_stats(spark, sf_dir, grain=HOUR):
    events = table(spark, sf_dir, "events")
    names = {"view": "free", "click": "used"}
    wanted = events.filter(F.col("event_type").isin(*names)).withColumn("bucket", grain.bucket("ts"))
    per_user = newest(
        wanted, ["bucket", "user_id", "event_type"], ["ts", "event_id"], ["value", "ts", "event_id"]
    )
    samples = per_user.join(places(spark, sf_dir), "user_id").withColumn(
        "mount", F.element_at(F.split("server_id", ":"), 2)
    )
    keys = ["bucket", "app_id", "site_id", "mount"]
    stats = last_sample(samples, keys, "event_type", "value", ["ts", "event_id"], names)
    hosts = servers(spark, sf_dir).select("app_id", "site_id").distinct()
    frame = calendar(hosts, *span(events, "ts", grain), grain)
    return frame.join(stats, ["bucket", "app_id", "site_id"], "left").select(
        "bucket",
        "app_id",
        "site_id",
        F.coalesce("mount", F.lit(EMPTY)).alias("mount"),
        F.coalesce("free", F.lit(0.0)).alias("free"),
        F.coalesce("used", F.lit(0.0)).alias("used"),
    )


DISK = """r AS (SELECT date_trunc('hour', ts) AS bucket, app_id, site_id,
        split_part(server_id, ':', 2) AS mount, event_type, value,
        row_number() OVER (PARTITION BY date_trunc('hour', ts), site_id,
          split_part(server_id, ':', 2), event_type ORDER BY ts DESC, event_id DESC) AS rn
      FROM events JOIN places USING (user_id) WHERE event_type IN ('view', 'click')),
l AS (SELECT bucket, app_id, site_id, mount,
        sum(value) FILTER (event_type = 'view') AS free,
        sum(value) FILTER (event_type = 'click') AS used
      FROM r WHERE rn = 1 GROUP BY ALL),
disk AS (SELECT cal.bucket, d.app_id, d.site_id, coalesce(mount, 'empty') AS mount,
           coalesce(free, 0) AS free, coalesce(used, 0) AS used
         FROM cal CROSS JOIN (SELECT DISTINCT app_id, site_id FROM dim) d
         LEFT JOIN l USING (bucket, app_id, site_id))"""


@query(
    "last_sample",
    f"""WITH {PLACES}, {buckets('hour')}, {DISK}
SELECT strftime(bucket, '%Y%m%d%H') AS stat_key, app_id, site_id, mount, free, used FROM disk""",
)
def last_sample_query(spark, sf_dir):
    out = disk_stats(spark, sf_dir)
    return out.select(HOUR.key("bucket").alias("stat_key"), *out.columns[1:])


# ---- switch ports -----------------------------------------------------------
# An event is a counter reading of one port of its user's nation; the label names
# the port in one of the three known forms.

LABEL = """CASE k % 3 WHEN 0 THEN 'Port ' || (k % 8) || ' up'
             WHEN 1 THEN 'GigabitEthernet1_0_' || (k % 8) ELSE 'Vlan' || k END"""


def port_readings(spark, sf_dir):
    k = prop_k()
    label = (
        F.when(k % 3 == 0, F.concat(F.lit("Port "), (k % 8).cast("string"), F.lit(" up")))
        .when(k % 3 == 1, F.concat(F.lit("GigabitEthernet1_0_"), (k % 8).cast("string")))
        .otherwise(F.concat(F.lit("Vlan"), k.cast("string")))
    )
    values = F.concat_ws(",", F.floor(F.col("value") * 100).cast("string"), (k * 1000).cast("string"))
    samples = table(spark, sf_dir, "events").select(
        DAY.bucket("ts").alias("bucket"),
        "user_id",
        port_number(label).alias("port_id"),
        pair_value(values, 0).alias("rx"),
        pair_value(values, 1).alias("tx"),
    )
    per_user = port_parts(samples, ["bucket", "user_id", "port_id"])
    return merge_port_parts(
        per_user.join(places(spark, sf_dir), "user_id"), ["bucket", "site_id", "port_id"]
    )


def port_calendar(spark, sf_dir, uplink: bool):
    """Eight ports per nation, the first two of them uplinks."""
    ports = F.sequence(F.lit(0), F.lit(1)) if uplink else F.sequence(F.lit(2), F.lit(7))
    dim = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("site_id"), F.explode(ports).alias("port_id")
    )
    return calendar(dim, *span(table(spark, sf_dir, "events"), "ts", DAY), DAY)


PORTS = f"""p AS (SELECT date_trunc('day', ts) AS bucket, site_id, {LABEL} AS label,
        CAST(floor(value * 100) AS BIGINT) AS rx, k * 1000 AS tx
      FROM (SELECT *, {K} AS k FROM events JOIN places USING (user_id))),
c AS (SELECT bucket, site_id, rx, tx,
        CASE WHEN label LIKE '%Port%' THEN CAST(split_part(label, ' ', 2) AS INTEGER)
             WHEN label LIKE '%GigabitEthernet1%' THEN CAST(split_part(label, '_', 3) AS INTEGER)
             ELSE -1 END AS port_id FROM p),
grid AS (SELECT bucket, n_name AS site_id, port_id FROM cal CROSS JOIN nation
         CROSS JOIN (SELECT unnest(range(8)) AS port_id)),
x AS (SELECT grid.*, coalesce(rx, 0) AS rx, coalesce(tx, 0) AS tx
      FROM grid LEFT JOIN c USING (bucket, site_id, port_id))"""
PORT_AGGS = """CAST(sum(rx) // count(*) AS BIGINT) AS avg_rx_bps, min(rx) AS min_rx_bps, max(rx) AS max_rx_bps,
       CAST(sum(tx) // count(*) AS BIGINT) AS avg_tx_bps, CAST(min(tx) AS BIGINT) AS min_tx_bps,
       CAST(max(tx) AS BIGINT) AS max_tx_bps"""


@query(
    "port_traffic",
    f"""WITH {PLACES}, {buckets('day')}, {PORTS}
SELECT strftime(bucket, '%Y%m%d') AS stat_key, site_id, CAST(port_id AS INTEGER) AS port_id, {PORT_AGGS}
FROM x WHERE port_id >= 2 GROUP BY bucket, site_id, port_id""",
)
def port_traffic(spark, sf_dir):
    keys = ["bucket", "site_id", "port_id"]
    out = port_gauge(port_readings(spark, sf_dir), keys, port_calendar(spark, sf_dir, False), keys)
    return out.select(DAY.key("bucket").alias("stat_key"), *out.columns[1:])


@query(
    "uplink_traffic",
    f"""WITH {PLACES}, {buckets('day')}, {PORTS}
SELECT strftime(bucket, '%Y%m%d') AS stat_key, site_id, {PORT_AGGS}
FROM x WHERE port_id < 2 GROUP BY bucket, site_id""",
)
def uplink_traffic(spark, sf_dir):
    keys = ["bucket", "site_id", "port_id"]
    frame = port_calendar(spark, sf_dir, True)
    out = port_gauge(port_readings(spark, sf_dir), keys, frame, keys[:2])
    return out.select(DAY.key("bucket").alias("stat_key"), *out.columns[1:])
