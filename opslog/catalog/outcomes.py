"""Outcome counters, rates and duration histograms on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from opslog.catalog.base import (
    PLACES, K, buckets, leveled, mean_units, places, prop_k, query, servers, six_digits, table, units,
)
from opslog.operators.dims import attach_dim, calendar, span, zero_fill
from opslog.operators.histogram import (
    closed_durations, duration_histogram, long_bins, next_event_durations, scaled, short_bins,
)
from opslog.operators.outcomes import WEB_RULES, probe_outcome, probe_rules, web_outcome
from opslog.operators.rate import rate_per_slot
from opslog.operators.rollup import rollup_entity, shares
from opslog.operators.sequence import minute_chunk
from opslog.spec import (
    APP, DAY, ENTITY_LEVELS, HOUR, MONTH, SECOND, SITE, high, low, mean, total,
)

IDS = ["app_id", "site_id", "server_id"]
KEYS = ["bucket", *IDS]

CAUSES = {"low_psnr": "URGENT", "no_codec": "HIGH", "no_video": "LOW", "connect_fail": "NOT"}


def regroup(stats, keys, rules):
    return stats.groupBy(*keys).agg(*[r.column() for r in rules])


@query(
    "probe_outcome",
    f"""WITH {PLACES}, {buckets('month', 'orders', 'o_orderdate')},
f AS (SELECT date_trunc('month', o_orderdate) AS bucket, app_id, site_id, server_id,
        CAST(o_orderstatus = 'F' AS INTEGER) AS ok, o_orderpriority AS detail
      FROM orders JOIN places ON o_custkey = user_id),
s AS (SELECT bucket, app_id, site_id, server_id, count(*) AS test_cnt, sum(ok) AS success_cnt,
{','.join(f"        count(*) FILTER (contains(detail, '{w}')) AS {c}" for c, w in CAUSES.items())}
      FROM f GROUP BY ALL),
z AS (SELECT cal.bucket, dim.*, {','.join(f'coalesce({c}, 0) AS {c}' for c in ['test_cnt', 'success_cnt', *CAUSES])}
      FROM cal CROSS JOIN dim LEFT JOIN s USING (bucket, app_id, site_id, server_id)),
l AS {leveled('''CAST(sum(test_cnt) AS BIGINT) AS test_cnt, CAST(sum(success_cnt) AS BIGINT) AS success_cnt,
   CAST(sum(test_cnt) - sum(success_cnt) AS BIGINT) AS fail_cnt,
   coalesce(CAST(sum(success_cnt) AS DOUBLE) * 100 / nullif(sum(test_cnt), 0), 0) AS success_rate,'''
   + ','.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in CAUSES), 'z')}
SELECT strftime(bucket, '%Y%m') AS stat_key, * EXCLUDE (bucket) FROM l""",
)
def probe_outcome_query(spark, sf_dir):
    """An order is a test of its customer's server, the priority its detail."""
    tests = table(spark, sf_dir, "orders").select(
        MONTH.bucket("o_orderdate").alias("bucket"),
        F.col("o_custkey").alias("user_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit("OK")).otherwise(F.lit("FAIL")).alias("result"),
        F.col("o_orderpriority").alias("detail"),
    )
    rules = probe_rules(tuple(CAUSES))
    per_user = probe_outcome(tests, ["bucket", "user_id"], causes=CAUSES)
    stats = regroup(per_user.join(places(spark, sf_dir), "user_id"), KEYS, rules)
    orders = table(spark, sf_dir, "orders")
    frame = calendar(servers(spark, sf_dir), *span(orders, "o_orderdate", MONTH), MONTH)
    filled = zero_fill(stats, frame, KEYS, {r.name: 0 for r in rules})
    out = rollup_entity(filled, ENTITY_LEVELS, rules)
    return out.select(MONTH.key("bucket").alias("stat_key"), *[c for c in out.columns if c != "bucket"])


@query(
    "probe_outcome_strict",
    """SELECT strftime(date_trunc('month', o_orderdate), '%Y%m') AS stat_key, count(*) AS test_cnt,
  count(*) FILTER (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS success_cnt,
  count(*) FILTER (NOT (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')) AS fail_cnt,
  CAST(count(*) FILTER (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS DOUBLE) * 100 / count(*) AS success_rate
FROM orders GROUP BY 1""",
)
def probe_outcome_strict(spark, sf_dir):
    """Strict form: a success also has an empty detail (here: urgent orders have none)."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    tests = table(spark, sf_dir, "orders").select(
        MONTH.bucket("o_orderdate").alias("bucket"),
        F.when(F.col("o_orderstatus") == "F", F.lit("OK")).otherwise(F.lit("FAIL")).alias("result"),
        F.when(urgent, F.lit("")).otherwise(F.col("o_orderpriority")).alias("detail"),
    )
    out = probe_outcome(tests, ["bucket"], causes={}, strict=True)
    return out.select(MONTH.key("bucket").alias("stat_key"), *out.columns[1:])


CODE = f"CASE WHEN {K} < 60 THEN '200' WHEN {K} < 80 THEN '304' WHEN {K} < 95 THEN '404' END"


def web_stats(spark, sf_dir, grain=HOUR):
    k = prop_k()
    events = table(spark, sf_dir, "events")
    requests = events.select(
        grain.bucket("ts").alias("bucket"),
        "user_id",
        F.when(k < 60, F.lit("200")).when(k < 80, F.lit("304")).when(k < 95, F.lit("404")).alias("ret_code"),
        F.floor(F.col("value") * 100).alias("bytes"),
    )
    per_user = web_outcome(requests, ["bucket", "user_id"])
    stats = regroup(per_user.join(places(spark, sf_dir), "user_id"), KEYS, WEB_RULES)
    frame = calendar(servers(spark, sf_dir), *span(events, "ts", grain), grain)
    return zero_fill(stats, frame, KEYS, {r.name: 0 for r in WEB_RULES})


WEB = f"""f AS (SELECT date_trunc('hour', ts) AS bucket, app_id, site_id, server_id,
        {CODE} AS code, CAST(floor(value * 100) AS BIGINT) AS bytes
      FROM events JOIN places USING (user_id)),
s AS (SELECT bucket, app_id, site_id, server_id, count(*) AS req_cnt,
        count(*) FILTER (code IN ('200', '304')) AS success_cnt,
        count(*) FILTER (code = '200') AS c200_cnt, count(*) FILTER (code = '304') AS c304_cnt,
        count(*) FILTER (code NOT IN ('200', '304')) AS fail_cnt, sum(bytes) AS bytes
      FROM f GROUP BY ALL),
web AS (SELECT cal.bucket, dim.*, coalesce(req_cnt, 0) AS req_cnt, coalesce(success_cnt, 0) AS success_cnt,
          coalesce(c200_cnt, 0) AS c200_cnt, coalesce(c304_cnt, 0) AS c304_cnt,
          coalesce(fail_cnt, 0) AS fail_cnt, coalesce(bytes, 0) AS bytes
        FROM cal CROSS JOIN dim LEFT JOIN s USING (bucket, app_id, site_id, server_id))"""
WEB_SUMS = """CAST(sum(req_cnt) AS BIGINT) AS req_cnt, CAST(sum(success_cnt) AS BIGINT) AS success_cnt,
   CAST(sum(c200_cnt) AS BIGINT) AS c200_cnt, CAST(sum(c304_cnt) AS BIGINT) AS c304_cnt,
   CAST(sum(fail_cnt) AS BIGINT) AS fail_cnt,
   coalesce(CAST(sum(success_cnt) AS DOUBLE) * 100 / nullif(sum(req_cnt), 0), 0) AS success_rate,
   CAST(sum(bytes) AS DOUBLE) / 1024 AS data_size"""


@query(
    "web_outcome",
    f"""WITH {PLACES}, {buckets('hour')}, {WEB}, l AS {leveled(WEB_SUMS, 'web')}
SELECT strftime(bucket, '%Y%m%d%H') AS stat_key, * EXCLUDE (bucket) FROM l""",
)
def web_outcome_query(spark, sf_dir):
    out = rollup_entity(web_stats(spark, sf_dir), ENTITY_LEVELS, WEB_RULES)
    return out.select(HOUR.key("bucket").alias("stat_key"), *[c for c in out.columns if c != "bucket"])


# ---- rates ------------------------------------------------------------------


@query(
    "rate_two_level",
    f"""WITH {PLACES}, {buckets('day')},
slots AS (SELECT date_trunc('hour', ts) AS slot, app_id, site_id, count(*) AS n
          FROM events JOIN places USING (user_id) GROUP BY ALL),
s AS (SELECT date_trunc('day', slot) AS bucket, app_id, site_id, CAST(sum(n) AS DOUBLE) / 24 AS avg_tps,
        CASE WHEN count(*) = 24 THEN min(n) ELSE 0 END AS min_tps, max(n) AS max_tps
      FROM slots GROUP BY ALL),
z AS (SELECT cal.bucket, d.app_id, d.site_id, coalesce(avg_tps, 0) AS avg_tps,
        coalesce(min_tps, 0) AS min_tps, coalesce(max_tps, 0) AS max_tps
      FROM cal CROSS JOIN (SELECT DISTINCT app_id, site_id FROM dim) d
      LEFT JOIN s USING (bucket, app_id, site_id))
SELECT 'site' AS level, strftime(bucket, '%Y%m%d') AS stat_key, app_id, site_id,
       {six_digits(units('avg_tps'))} AS avg_tps, min_tps, max_tps FROM z
UNION ALL
SELECT 'app', strftime(bucket, '%Y%m%d'), app_id, '*', {six_digits(mean_units(units('avg_tps')))},
       min(min_tps), max(max_tps)
FROM z GROUP BY bucket, app_id""",
)
def rate_two_level(spark, sf_dir):
    """Rows per hour of a day: average over all hours, minimum only for full days."""
    per_user = (
        table(spark, sf_dir, "events")
        .groupBy(HOUR.bucket("ts").alias("ts"), "user_id")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    located = per_user.join(places(spark, sf_dir), "user_id")
    stats = rate_per_slot(located, "ts", ["app_id", "site_id"], HOUR, DAY, count=F.col("n_rows"))
    sites = servers(spark, sf_dir).select("app_id", "site_id").distinct()
    frame = calendar(sites, *span(table(spark, sf_dir, "events"), "ts", DAY), DAY)
    zeros = {"avg_tps": 0, "min_tps": 0, "max_tps": 0}
    filled = zero_fill(stats, frame, ["bucket", "app_id", "site_id"], zeros)
    rules = [mean("avg_tps", 6), low("min_tps"), high("max_tps")]
    out = rollup_entity(filled, [SITE, APP], rules)
    return out.select("level", DAY.key("bucket").alias("stat_key"), "app_id", "site_id", *zeros)


@query(
    "rate_full_slots",
    """WITH slots AS (SELECT date_trunc('hour', ts) AS slot, event_type, count(*) AS n
               FROM events GROUP BY ALL)
SELECT strftime(date_trunc('day', slot), '%Y%m%d') AS stat_key, event_type,
       CAST(sum(n) AS DOUBLE) / 24 AS avg_tps,
       CASE WHEN count(*) = 24 THEN min(n) ELSE 0 END AS min_tps, max(n) AS max_tps
FROM slots GROUP BY 1, 2""",
)
def rate_full_slots(spark, sf_dir):
    """Rows per hour and type: dense enough for days whose every hour has a row."""
    events = table(spark, sf_dir, "events")
    out = rate_per_slot(events, "ts", ["event_type"], HOUR, DAY)
    return out.select(DAY.key("bucket").alias("stat_key"), *out.columns[1:])


@query(
    "rate_second_hour",
    """WITH slots AS (SELECT date_trunc('second', ts) AS slot, event_type, count(*) AS n
               FROM events GROUP BY ALL)
SELECT strftime(date_trunc('hour', slot), '%Y%m%d%H') AS stat_key, event_type,
       CAST(sum(n) AS DOUBLE) / 3600 AS avg_tps,
       CASE WHEN count(*) = 3600 THEN min(n) ELSE 0 END AS min_tps, max(n) AS max_tps
FROM slots GROUP BY 1, 2""",
)
def rate_second_hour(spark, sf_dir):
    """Hour rate straight from raw rows: per second, then per hour."""
    out = rate_per_slot(table(spark, sf_dir, "events"), "ts", ["event_type"], SECOND, HOUR)
    return out.select(HOUR.key("bucket").alias("stat_key"), *out.columns[1:])


# ---- durations --------------------------------------------------------------

SHORT = short_bins()
QUARTERS = scaled(SHORT, 900)  # these events are hours apart
LONG = long_bins()


def bin_sql(bins, value="seconds"):
    out = []
    for b in bins:
        upper = "" if b.upto is None else f" AND {value} <= {b.upto}"
        out.append(f"count(*) FILTER ({value} > {b.over}{upper}) AS {b.name}")
    return ", ".join(out)


def sums_sql(bins):
    return ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ["total_cnt", *[b.name for b in bins]])


def hist_rules(bins):
    return [total("total_cnt"), *[total(b.name) for b in bins]]


@query(
    "usetime_closed",
    f"""WITH {PLACES},
known AS (SELECT places.* FROM places JOIN customer ON user_id = c_custkey
          WHERE c_mktsegment <> 'BUILDING'),
f AS (SELECT date_trunc('hour', ts) AS bucket, user_id, {K} AS seconds FROM events),
s AS (SELECT bucket, coalesce(app_id, '999') AS app_id, coalesce(site_id, '999') AS site_id,
        coalesce(server_id, '999') AS server_id, count(*) AS total_cnt, {bin_sql(SHORT)}
      FROM f LEFT JOIN known USING (user_id) WHERE seconds > 0 GROUP BY ALL),
l AS {leveled(sums_sql(SHORT), 's')}
SELECT strftime(bucket, '%Y%m%d%H') AS stat_key, * EXCLUDE (bucket) FROM l""",
)
def usetime_closed(spark, sf_dir):
    """Closed sessions of k seconds; not zero-filled, unknown devices kept."""
    sessions = table(spark, sf_dir, "events").select(
        HOUR.bucket("ts").alias("bucket"),
        "user_id",
        F.col("ts").alias("on_at"),
        (F.col("ts") + F.make_dt_interval(secs=prop_k())).alias("off_at"),
    )
    per_user = duration_histogram(
        closed_durations(sessions, "on_at", "off_at"), ["bucket", "user_id"], SHORT
    )
    others = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
    known = places(spark, sf_dir).join(
        others.select(F.col("c_custkey").alias("user_id")), "user_id", "left_semi"
    )
    placed = attach_dim(per_user, known, ["user_id"], IDS)
    out = rollup_entity(placed, ENTITY_LEVELS, hist_rules(SHORT))
    return out.select(HOUR.key("bucket").alias("stat_key"), *[c for c in out.columns if c != "bucket"])


@query(
    "usetime_hist",
    f"""WITH {PLACES},
n AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nts FROM events),
f AS (SELECT date_trunc('day', ts) AS bucket, user_id,
        coalesce(CAST(floor(epoch(nts)) AS BIGINT) - CAST(floor(epoch(ts)) AS BIGINT), 999) AS seconds
      FROM n WHERE event_type = 'signup'),
s AS (SELECT bucket, app_id, site_id, server_id, count(*) AS total_cnt, {bin_sql(QUARTERS)}
      FROM f JOIN places USING (user_id) WHERE seconds > 0 GROUP BY ALL),
l AS {leveled(sums_sql(SHORT), 's')}
SELECT strftime(bucket, '%Y%m%d') AS stat_key, * EXCLUDE (bucket) FROM l""",
)
def usetime_hist(spark, sf_dir):
    """From a sign-up to the user's next event, in bins of quarter hours; no gap is too short to count."""
    events = table(spark, sf_dir, "events").select("ts", "event_id", "user_id", "event_type")
    gaps = next_event_durations(
        events, ["user_id"], "ts", ["ts", "event_id"], minute_chunk("ts"), F.col("event_type") == "signup"
    ).select(
        DAY.bucket("ts").alias("bucket"), "user_id", "seconds"
    )
    per_user = duration_histogram(gaps, ["bucket", "user_id"], QUARTERS)
    placed = per_user.join(places(spark, sf_dir), "user_id")
    out = rollup_entity(placed, ENTITY_LEVELS, hist_rules(SHORT))
    return out.select(DAY.key("bucket").alias("stat_key"), *[c for c in out.columns if c != "bucket"])


def long_histogram(spark, sf_dir, grain=DAY):
    """Zero-filled 18-bin histogram per server of sessions lasting 45 k seconds."""
    events = table(spark, sf_dir, "events")
    sessions = events.select(grain.bucket("ts").alias("bucket"), "user_id", (prop_k() * 45).alias("seconds"))
    per_user = duration_histogram(sessions, ["bucket", "user_id"], LONG)
    rules = hist_rules(LONG)
    stats = regroup(per_user.join(places(spark, sf_dir), "user_id"), KEYS, rules)
    frame = calendar(servers(spark, sf_dir), *span(events, "ts", grain), grain)
    return zero_fill(stats, frame, KEYS, {r.name: 0 for r in rules})


LONG_HIST = f"""f AS (SELECT date_trunc('day', ts) AS bucket, app_id, site_id, server_id, {K} * 45 AS seconds
      FROM events JOIN places USING (user_id)),
s AS (SELECT bucket, app_id, site_id, server_id, count(*) AS total_cnt, {bin_sql(LONG)}
      FROM f WHERE seconds > 0 GROUP BY ALL),
hist AS (SELECT cal.bucket, dim.*, {', '.join(f'coalesce({c}, 0) AS {c}' for c in ['total_cnt', *[b.name for b in LONG]])}
         FROM cal CROSS JOIN dim LEFT JOIN s USING (bucket, app_id, site_id, server_id))"""
SHARES = ", ".join(
    f"coalesce(CAST({b.name} AS DOUBLE) * 100 / nullif(total_cnt, 0), 0) AS share_{b.name}" for b in LONG
)


@query(
    "usetime_hist18_share",
    f"""WITH {PLACES}, {buckets('day')}, {LONG_HIST}, l AS {leveled(sums_sql(LONG), 'hist')}
SELECT strftime(bucket, '%Y%m%d') AS stat_key, * EXCLUDE (bucket), {SHARES} FROM l""",
)
def usetime_hist18_share(spark, sf_dir):
    out = rollup_entity(long_histogram(spark, sf_dir), ENTITY_LEVELS, hist_rules(LONG))
    out = shares(out, [b.name for b in LONG], "total_cnt")
    return out.select(DAY.key("bucket").alias("stat_key"), *[c for c in out.columns if c != "bucket"])
