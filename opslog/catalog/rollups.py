"""Hour to day to month roll-ups on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from opslog.catalog.base import (
    PLACES, VALUE, buckets, leveled, mean_units, places, query, servers, six_digits, table, units, value_dec,
)
from opslog.catalog.concurrent import CAP, CAPPED, IDS, ccu_levels, capped_sessions, fill, leveled_iv, sweep
from opslog.catalog.gauges import (
    BANDWIDTH, DISK, PORTS, bandwidth_stats, click_gauge, disk_stats, port_calendar, port_readings,
)
from opslog.catalog.outcomes import (
    LONG, LONG_HIST, SHARES, WEB, hist_rules, long_histogram, sums_sql, web_stats,
)
from opslog.catalog.pairs import PAIR_RULES, RATES, ROUTE, ZEROED, route_site_stats
from opslog.catalog.uniques import UNIQUE, event_levels
from opslog.operators.gauge import gauge_parts, port_gauge
from opslog.operators.rate import rate_per_slot
from opslog.operators.rollup import rollup_entity, rollup_time, shares
from opslog.operators.outcomes import WEB_RULES
from opslog.spec import (
    APP, DAY, EXACT, HOUR, MINUTE, MONTH, SERVER, SITE, gauge_rules, high, low, mean, total, weighted,
)

LEVEL_KEYS = ["level", *IDS]


def keyed(df, grain, name=None):
    """Text key instead of the bucket, and the grain where several are shown."""
    extra = [F.lit(name).alias("grain")] if name else []
    rest = [c for c in df.columns if c != "bucket"]
    return df.select(*extra, grain.key("bucket").alias("stat_key"), *rest)


def day_and_month(day, month):
    return keyed(day, DAY, "day").unionByName(keyed(month, MONTH, "month"))


@query(
    "rollup_sum_rate",
    f"""WITH {PLACES}, {buckets('hour')}, {ROUTE},
s AS (SELECT bucket, answer_ip AS site_id, {RATES} FROM pairs WHERE answer_ip <> '' GROUP BY ALL),
z AS (SELECT cal.bucket, d.app_id, d.site_id, {ZEROED}
      FROM cal CROSS JOIN (SELECT DISTINCT app_id, site_id FROM dim) d LEFT JOIN s USING (bucket, site_id))
SELECT grain, stat_key, app_id, site_id, CAST(sum(req_cnt) AS BIGINT) AS req_cnt,
       CAST(sum(success_cnt) AS BIGINT) AS success_cnt, CAST(sum(fail_cnt) AS BIGINT) AS fail_cnt,
       coalesce(CAST(sum(success_cnt) AS DOUBLE) * 100 / nullif(sum(req_cnt), 0), 0) AS success_rate
FROM (SELECT 'day' AS grain, strftime(bucket, '%Y%m%d') AS stat_key, * FROM z
      UNION ALL SELECT 'month', strftime(bucket, '%Y%m'), * FROM z)
GROUP BY grain, stat_key, app_id, site_id""",
)
def rollup_sum_rate(spark, sf_dir):
    """Counts add up, the rate is recomputed: hour to day, day to month."""
    keys = ["app_id", "site_id"]
    day = rollup_time(route_site_stats(spark, sf_dir), DAY, keys, PAIR_RULES)
    return day_and_month(day, rollup_time(day, MONTH, keys, PAIR_RULES))


@query(
    "rollup_avg_min_max",
    f"""WITH {PLACES}, {buckets('hour')},
s AS (SELECT date_trunc('hour', ts) AS bucket, app_id, site_id, server_id,
        CAST(sum({VALUE}) AS DOUBLE) / count(*) AS a, min(value) AS lo, max(value) AS hi
      FROM events JOIN places USING (user_id) WHERE event_type = 'click' GROUP BY ALL),
z AS (SELECT cal.bucket, dim.*, coalesce(a, 0) AS a, coalesce(lo, 0) AS lo, coalesce(hi, 0) AS hi
      FROM cal CROSS JOIN dim LEFT JOIN s USING (bucket, app_id, site_id, server_id)),
l AS {leveled(f'{mean_units(units("a"))} AS a, min(lo) AS lo, max(hi) AS hi', 'z')},
day AS (SELECT date_trunc('day', bucket) AS bucket, level, app_id, site_id, server_id, {mean_units('a')} AS a,
          min(lo) AS lo, max(hi) AS hi FROM l GROUP BY ALL),
month AS (SELECT date_trunc('month', bucket) AS bucket, level, app_id, site_id, server_id, {mean_units('a')} AS a,
          min(lo) AS lo, max(hi) AS hi FROM day GROUP BY ALL)
SELECT 'day' AS grain, strftime(bucket, '%Y%m%d') AS stat_key, level, app_id, site_id, server_id,
  {six_digits('a')} AS avg_session, lo AS min_session, hi AS max_session FROM day
UNION ALL SELECT 'month', strftime(bucket, '%Y%m'), level, app_id, site_id, server_id, {six_digits('a')}, lo, hi
FROM month""",
)
def rollup_avg_min_max(spark, sf_dir):
    """Average of averages without weights, minimum of minima, maximum of maxima."""
    rules = gauge_rules("session")
    day = rollup_time(click_gauge(spark, sf_dir), DAY, LEVEL_KEYS, rules)
    out = day_and_month(day, rollup_time(day, MONTH, LEVEL_KEYS, rules))
    return out.withColumns(
        {
            "avg_session": F.round(F.col("avg_session").cast(EXACT), 6).cast("double"),
            "min_session": F.col("min_session").cast("double"),
            "max_session": F.col("max_session").cast("double"),
        }
    )


@query(
    "rollup_weighted",
    f"""SELECT strftime(date_trunc('day', ts), '%Y%m%d') AS stat_key, event_type,
  CAST(sum({VALUE}) AS DOUBLE) / count(*) AS avg_v, min(value) AS min_v, max(value) AS max_v
FROM events GROUP BY ALL""",
)
def rollup_weighted(spark, sf_dir):
    """Exact average over any grain, from stored sums and counts."""
    hourly = gauge_parts(
        table(spark, sf_dir, "events"), [HOUR.bucket("ts").alias("bucket"), "event_type"], {"v": value_dec()}
    )
    rules = [weighted("avg_v", "sum_v", "n_v"), low("min_v"), high("max_v")]
    out = keyed(rollup_time(hourly, DAY, ["event_type"], rules), DAY)
    return out.withColumns({c: F.col(c).cast("double") for c in ("min_v", "max_v")})


@query(
    "rollup_disk",
    f"""WITH {PLACES}, {buckets('hour')}, {DISK}
SELECT strftime(bucket, '%Y%m%d') AS stat_key, app_id, site_id, mount, min(free) AS free, max(used) AS used
FROM (SELECT * REPLACE (date_trunc('day', bucket) AS bucket) FROM disk)
GROUP BY bucket, app_id, site_id, mount""",
)
def rollup_disk(spark, sf_dir):
    """Least free and most used."""
    rules = [low("free"), high("used")]
    return keyed(rollup_time(disk_stats(spark, sf_dir), DAY, ["app_id", "site_id", "mount"], rules), DAY)


@query(
    "rollup_share",
    f"""WITH {PLACES}, {buckets('day')}, {LONG_HIST},
l AS {leveled(sums_sql(LONG), '(SELECT * REPLACE (date_trunc(' + "'month'" + ', bucket) AS bucket) FROM hist)')}
SELECT strftime(bucket, '%Y%m') AS stat_key, * EXCLUDE (bucket), {SHARES} FROM l""",
)
def rollup_share(spark, sf_dir):
    """Bin counts add up over a month, their shares are recomputed."""
    rules = hist_rules(LONG)
    month = rollup_time(long_histogram(spark, sf_dir), MONTH, IDS, rules)
    out = rollup_entity(month, [SERVER, SITE, APP], rules)
    return keyed(shares(out, [b.name for b in LONG], "total_cnt"), MONTH)


@query(
    "rollup_uvpv_sum",
    f"""WITH {PLACES}, {buckets('hour')},
f AS (SELECT date_trunc('hour', ts) AS bucket, user_id, app_id, site_id, server_id
      FROM events JOIN places USING (user_id)),
s AS {leveled(UNIQUE, 'f')},
z AS (SELECT cal.bucket, ent.*, coalesce(uv, 0) AS uv, coalesce(pv, 0) AS pv
      FROM cal CROSS JOIN ent LEFT JOIN s USING (bucket, level, app_id, site_id, server_id))
SELECT strftime(date_trunc('day', bucket), '%Y%m%d') AS stat_key, level, app_id, site_id, server_id,
       CAST(sum(uv) AS BIGINT) AS uv, CAST(sum(pv) AS BIGINT) AS pv
FROM z GROUP BY ALL""",
)
def rollup_uvpv_sum(spark, sf_dir):
    """Day views as the sum of hourly ones; uniques seen in two hours count twice."""
    hourly = event_levels(spark, sf_dir, HOUR)
    return keyed(rollup_time(hourly, DAY, LEVEL_KEYS, [total("uv"), total("pv")]), DAY)


@query(
    "rollup_ccu",
    f"""WITH {PLACES}, {buckets('hour')}, {CAPPED.format(cap=CAP)},
{sweep(3600, leveled_iv('sess', 'user_id'))},
z AS (SELECT cal.bucket, ent.*, coalesce(avg_ccu, 0) AS a, coalesce(min_ccu, 0) AS lo, coalesce(max_ccu, 0) AS hi
      FROM cal CROSS JOIN ent LEFT JOIN ccu USING (bucket, level, app_id, site_id, server_id))
SELECT strftime(date_trunc('day', bucket), '%Y%m%d') AS stat_key, level, app_id, site_id, server_id,
       {six_digits(mean_units(units('a')))} AS avg_ccu, min(lo) AS min_ccu, max(hi) AS max_ccu
FROM z GROUP BY date_trunc('day', bucket), level, app_id, site_id, server_id""",
)
def rollup_ccu(spark, sf_dir):
    placed = capped_sessions(spark, sf_dir).join(places(spark, sf_dir), "user_id")
    events = table(spark, sf_dir, "events")
    hourly = fill(ccu_levels(placed, "user_id", HOUR), servers(spark, sf_dir), events, HOUR)
    return keyed(
        rollup_time(hourly, DAY, LEVEL_KEYS, [mean("avg_ccu", 6), low("min_ccu"), high("max_ccu")]), DAY
    )


@query(
    "rollup_bandwidth",
    f"""WITH {PLACES}, {buckets('hour')}, {BANDWIDTH},
v AS (SELECT date_trunc('day', bucket) AS bucket, app_id, site_id, server_id,
        CAST(round(avg_mbps * 100) AS BIGINT) AS a, min_mbps, max_mbps FROM bw WHERE level = 'server'),
l AS {leveled('''((2 * sum(a) + count(*)) // (2 * count(*))) / 100.0 AS avg_mbps,
   min(min_mbps) AS min_mbps, max(max_mbps) AS max_mbps''', 'v')}
SELECT strftime(bucket, '%Y%m%d') AS stat_key, level, app_id, site_id, server_id,
  CAST(avg_mbps AS DOUBLE) AS avg_mbps, CAST(min_mbps AS DOUBLE) AS min_mbps, CAST(max_mbps AS DOUBLE) AS max_mbps
FROM l""",
)
def rollup_bandwidth(spark, sf_dir):
    """Every level from the server rows: average of averages with two digits."""
    hourly = bandwidth_stats(spark, sf_dir).filter("level = 'server'").drop("level")
    by_day = hourly.withColumn("bucket", DAY.bucket("bucket"))
    rules = [mean("avg_mbps", 2), low("min_mbps"), high("max_mbps")]
    out = keyed(rollup_entity(by_day, [SERVER, SITE, APP], rules), DAY)
    return out.withColumns({c: F.col(c).cast("double") for c in ("avg_mbps", "min_mbps", "max_mbps")})


@query(
    "rollup_web",
    f"""WITH {PLACES}, {buckets('hour')}, {WEB}
SELECT strftime(date_trunc('day', bucket), '%Y%m%d') AS stat_key, app_id, site_id, server_id,
  CAST(sum(req_cnt) AS BIGINT) AS req_cnt, CAST(sum(success_cnt) AS BIGINT) AS success_cnt,
  CAST(sum(c200_cnt) AS BIGINT) AS c200_cnt, CAST(sum(c304_cnt) AS BIGINT) AS c304_cnt,
  CAST(sum(fail_cnt) AS BIGINT) AS fail_cnt,
  coalesce(CAST(sum(success_cnt) AS DOUBLE) * 100 / nullif(sum(req_cnt), 0), 0) AS success_rate,
  CAST(sum(bytes) AS DOUBLE) / 1024 AS data_size
FROM web GROUP BY date_trunc('day', bucket), app_id, site_id, server_id""",
)
def rollup_web(spark, sf_dir):
    return keyed(rollup_time(web_stats(spark, sf_dir), DAY, IDS, WEB_RULES), DAY)


@query(
    "rollup_ports",
    f"""WITH {PLACES}, {buckets('day')}, {PORTS},
d AS (SELECT bucket, site_id, CAST(port_id AS INTEGER) AS port_id, sum(rx) // count(*) AS a, min(rx) AS lo,
        max(rx) AS hi FROM x WHERE port_id >= 2 GROUP BY ALL)
SELECT strftime(date_trunc('month', bucket), '%Y%m') AS stat_key, site_id, port_id,
  {six_digits(mean_units(units('a')))} AS avg_rx_bps, min(lo) AS min_rx_bps, max(hi) AS max_rx_bps
FROM d GROUP BY date_trunc('month', bucket), site_id, port_id""",
)
def rollup_ports(spark, sf_dir):
    keys = ["bucket", "site_id", "port_id"]
    daily = port_gauge(port_readings(spark, sf_dir), keys, port_calendar(spark, sf_dir, False), keys)
    rules = [mean("avg_rx_bps", 6), low("min_rx_bps"), high("max_rx_bps")]
    return keyed(rollup_time(daily, MONTH, ["site_id", "port_id"], rules), MONTH)


@query(
    "rollup_tps",
    f"""WITH slots AS (SELECT date_trunc('minute', ts) AS slot, event_type, count(*) AS n
               FROM events GROUP BY ALL),
h AS (SELECT date_trunc('hour', slot) AS bucket, event_type, CAST(sum(n) AS DOUBLE) / 60 AS a,
        CASE WHEN count(*) = 60 THEN min(n) ELSE 0 END AS lo, max(n) AS hi FROM slots GROUP BY ALL)
SELECT strftime(date_trunc('day', bucket), '%Y%m%d') AS stat_key, event_type, {six_digits(mean_units(units('a')))} AS avg_tps,
  min(lo) AS min_tps, max(hi) AS max_tps
FROM h GROUP BY date_trunc('day', bucket), event_type""",
)
def rollup_tps(spark, sf_dir):
    hourly = rate_per_slot(table(spark, sf_dir, "events"), "ts", ["event_type"], MINUTE, HOUR)
    rules = [mean("avg_tps", 6), low("min_tps"), high("max_tps")]
    return keyed(rollup_time(hourly, DAY, ["event_type"], rules), DAY)
