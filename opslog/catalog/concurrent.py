"""Concurrent users on the given tables."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.catalog.base import (
    PLACES, K, buckets, leveled, mean_units, places, prop_k, query, servers, six_digits, table, units,
)
from opslog.functions.timekeys import instant
from opslog.operators.concurrency import clipped, concurrency, concurrency_vector, sessions_from_marks, still_open
from opslog.operators.dims import calendar, level_frame, span, zero_fill
from opslog.operators.rollup import rollup_entity
from opslog.operators.sequence import minute_chunk, next_row
from opslog.session import scratch_dir
from opslog.spec import APP, DAY, ENTITY_LEVELS, HOUR, MINUTE, SITE, gauge_rules

IDS = ["app_id", "site_id", "server_id"]
ZEROS = {"avg_ccu": 0, "min_ccu": 0, "max_ccu": 0}
CAP = 1800
LONG_CAP = 3 * 86400
CARRY_STEP = timedelta(days=8)


def capped_sessions(spark, sf_dir, cap=CAP):
    """From each event to the user's next one, at most ``cap`` seconds."""
    events = table(spark, sf_dir, "events").select("ts", "event_id", "user_id")
    linked = next_row(events, ["user_id"], ["ts", "event_id"], minute_chunk("ts"), ["ts"], "following")
    limit = F.col("ts") + F.expr(f"interval {cap} seconds")
    return linked.select(
        "user_id", F.col("ts").alias("on_at"), F.least(F.col("following.ts"), limit).alias("off_at")
    )


def per_level(sessions, levels=ENTITY_LEVELS):
    """Copy each session to every level, under the level's own entity."""
    variants = [
        F.struct(
            F.lit(level.name).alias("level"),
            *[F.col(c) if c in level.ids else F.lit("*").alias(c) for c in IDS],
        )
        for level in levels
    ]
    rest = [c for c in sessions.columns if c not in IDS]
    return sessions.select(*rest, F.explode(F.array(*variants)).alias("_e")).select(*rest, "_e.*")


def ccu_levels(sessions, client, grain, levels=ENTITY_LEVELS):
    return concurrency(
        per_level(sessions, levels), ["level", *IDS], [client], "on_at", "off_at", grain
    )


def fill(stats, dim, events, grain, levels=ENTITY_LEVELS):
    frame = calendar(level_frame(dim, levels), *span(events, "ts", grain), grain)
    ids = [c for c in IDS if c in frame.columns]
    return zero_fill(stats, frame, ["bucket", "level", *ids], ZEROS)


# Steps, running sums and bucket cuts in plain SQL.  ``iv(level, app_id, site_id,
# server_id, client, s, e)`` holds whole seconds; overlapping sessions of one client
# are merged by islands first.
E_IDS = "level, app_id, site_id, server_id"


def sweep(unit_seconds: int, iv: str) -> str:
    return f"""iv AS ({iv}),
reach AS (SELECT *, max(e) OVER (PARTITION BY {E_IDS}, client ORDER BY s, e
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM iv WHERE e > s),
isl AS (SELECT *, sum(CASE WHEN r IS NULL OR s > r THEN 1 ELSE 0 END)
          OVER (PARTITION BY {E_IDS}, client ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM reach),
merged AS (SELECT {E_IDS}, client, min(s) AS s, max(e) AS e FROM isl GROUP BY {E_IDS}, client, g),
d AS (SELECT {E_IDS}, s AS t, 1 AS d FROM merged UNION ALL SELECT {E_IDS}, e, -1 FROM merged
      UNION ALL SELECT DISTINCT {E_IDS}, b * {unit_seconds}, 0
      FROM (SELECT {E_IDS}, unnest(range(s // {unit_seconds}, e // {unit_seconds} + 2)) AS b FROM merged)),
net AS (SELECT {E_IDS}, t, sum(d) AS d FROM d GROUP BY {E_IDS}, t),
seg AS (SELECT {E_IDS}, t, sum(d) OVER w AS c, lead(t) OVER w AS nt FROM net
        WINDOW w AS (PARTITION BY {E_IDS} ORDER BY t ROWS UNBOUNDED PRECEDING)),
ccu AS (SELECT {E_IDS}, make_timestamp((t // {unit_seconds}) * {unit_seconds} * 1000000) AS bucket,
          CAST(sum(c * least(nt - t, {unit_seconds})) AS DOUBLE) / {unit_seconds} AS avg_ccu,
          CAST(min(c) AS BIGINT) AS min_ccu, CAST(max(c) AS BIGINT) AS max_ccu
        FROM seg GROUP BY {E_IDS}, t // {unit_seconds} HAVING max(c) > 0)"""


def leveled_iv(source: str, client: str) -> str:
    cols = f"{client} AS client, s, e FROM {source}"
    return f"""SELECT 'server' AS level, app_id, site_id, server_id, {cols}
   UNION ALL SELECT 'site', app_id, site_id, '*', {cols}
   UNION ALL SELECT 'app', app_id, '*', '*', {cols}"""


SEC = "CAST(floor(epoch({})) AS BIGINT)"
CAPPED = f"""raw AS (SELECT user_id, ts, least(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id),
                 ts + INTERVAL {{cap}} SECOND) AS off FROM events),
sess AS (SELECT user_id, {SEC.format('ts')} AS s, {SEC.format('off')} AS e, app_id, site_id, server_id
         FROM raw JOIN places USING (user_id))"""


@query(
    "concurrency_hour",
    f"""WITH {PLACES}, {buckets('hour')}, {CAPPED.format(cap=CAP)},
{sweep(3600, leveled_iv('sess', 'user_id'))}
SELECT strftime(cal.bucket, '%Y%m%d%H') AS stat_key, ent.*, coalesce(avg_ccu, 0) AS avg_ccu,
       coalesce(min_ccu, 0) AS min_ccu, coalesce(max_ccu, 0) AS max_ccu
FROM cal CROSS JOIN ent LEFT JOIN ccu USING (bucket, level, app_id, site_id, server_id)""",
)
def concurrency_hour(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    placed = capped_sessions(spark, sf_dir).join(places(spark, sf_dir), "user_id")
    stats = ccu_levels(placed, "user_id", HOUR)
    out = fill(stats, servers(spark, sf_dir), events, HOUR)
    return out.select(HOUR.key("bucket").alias("stat_key"), "level", *IDS, *ZEROS)


@query(
    "concurrency_carried",
    f"""WITH {PLACES}, {CAPPED.format(cap=LONG_CAP)},
{sweep(3600, leveled_iv('sess', 'user_id'))}
SELECT strftime(bucket, '%Y%m%d%H') AS stat_key, {E_IDS}, avg_ccu, min_ccu, max_ccu FROM ccu""",
)
def concurrency_carried(spark, sf_dir):
    """Sessions of up to three days, window by window: each reads what begins in it and the sessions still open at its border."""
    placed = capped_sessions(spark, sf_dir, LONG_CAP).join(places(spark, sf_dir), "user_id")
    low, high = table(spark, sf_dir, "events").agg(
        F.date_format(F.min("ts"), "yyyyMMdd"), F.date_format(F.max("ts"), "yyyyMMdd")
    ).first()
    begin, last = (datetime.strptime(d, "%Y%m%d") for d in (low, high))
    parts, carried = [], placed.limit(0)
    while begin <= last + timedelta(seconds=LONG_CAP):  # sessions that are open at the end need one more
        end = begin + CARRY_STEP
        first, border = instant(begin), instant(end)
        rows = placed.filter((F.col("on_at") >= first) & (F.col("on_at") < border)).unionByName(carried)
        parts.append(ccu_levels(clipped(rows, first, border), "user_id", HOUR))
        path = scratch_dir(spark, "carried")
        still_open(rows, border).write.parquet(path)
        carried, begin = spark.read.schema(placed.schema).parquet(path), end
    out = reduce(DataFrame.unionByName, parts).filter("max_ccu > 0")
    return out.select(HOUR.key("bucket").alias("stat_key"), "level", *IDS, *ZEROS)


@query(
    "concurrency_overlap",
    f"""WITH {PLACES}, sess AS (
  SELECT event_type, {SEC.format('ts')} AS s, {SEC.format('ts')} + {K} * 60 AS e, app_id, site_id, server_id
  FROM events JOIN places USING (user_id)),
{sweep(60, leveled_iv('sess', 'event_type'))}
SELECT strftime(bucket, '%Y%m%d%H%M') AS stat_key, {E_IDS}, avg_ccu, min_ccu, max_ccu
FROM ccu WHERE level = 'app'""",
)
def concurrency_overlap(spark, sf_dir):
    """Overlapping sessions of one client count once: k minutes, client = type, per minute."""
    sessions = table(spark, sf_dir, "events").select(
        "user_id",
        "event_type",
        F.date_trunc("second", "ts").alias("on_at"),
        (F.date_trunc("second", "ts") + F.make_dt_interval(mins=prop_k())).alias("off_at"),
    )
    placed = sessions.join(places(spark, sf_dir), "user_id")
    out = ccu_levels(placed, "event_type", MINUTE, [APP]).filter("max_ccu > 0")
    return out.select(MINUTE.key("bucket").alias("stat_key"), "level", *IDS, *ZEROS)


@query(
    "concurrency_day",
    f"""WITH {PLACES}, {buckets('day')}, {CAPPED.format(cap=CAP)},
{sweep(86400, leveled_iv('sess', 'user_id'))}
SELECT strftime(cal.bucket, '%Y%m%d') AS stat_key, ent.*, coalesce(avg_ccu, 0) AS avg_ccu,
       coalesce(min_ccu, 0) AS min_ccu, coalesce(max_ccu, 0) AS max_ccu
FROM cal CROSS JOIN ent LEFT JOIN ccu USING (bucket, level, app_id, site_id, server_id)""",
)
def concurrency_day(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    placed = capped_sessions(spark, sf_dir).join(places(spark, sf_dir), "user_id")
    out = fill(ccu_levels(placed, "user_id", DAY), servers(spark, sf_dir), events, DAY)
    return out.select(DAY.key("bucket").alias("stat_key"), "level", *IDS, *ZEROS)


@query(
    "concurrency_from_servers",
    f"""WITH {PLACES}, {buckets('day')}, {CAPPED.format(cap=CAP)},
{sweep(86400, leveled_iv('sess', 'user_id'))},
z AS (SELECT cal.bucket, dim.*, coalesce(avg_ccu, 0) AS a, coalesce(min_ccu, 0) AS lo, coalesce(max_ccu, 0) AS hi
      FROM cal CROSS JOIN dim LEFT JOIN (SELECT * FROM ccu WHERE level = 'server')
      USING (bucket, app_id, site_id, server_id)),
l AS {leveled(f'{six_digits(mean_units(units("a")))} AS avg_ccu, min(lo) AS min_ccu, max(hi) AS max_ccu', 'z')}
SELECT strftime(bucket, '%Y%m%d') AS stat_key, * EXCLUDE (bucket) FROM l""",
)
def concurrency_from_servers(spark, sf_dir):
    """Site and app as average, minimum and maximum of their servers' rows."""
    placed = capped_sessions(spark, sf_dir).join(places(spark, sf_dir), "user_id")
    stats = concurrency(placed, IDS, ["user_id"], "on_at", "off_at", DAY)
    frame = calendar(servers(spark, sf_dir), *span(table(spark, sf_dir, "events"), "ts", DAY), DAY)
    filled = zero_fill(stats, frame, ["bucket", *IDS], ZEROS)
    out = rollup_entity(filled, ENTITY_LEVELS, gauge_rules("ccu", digits=6))
    return out.select(DAY.key("bucket").alias("stat_key"), "level", *IDS, *ZEROS)


@query(
    "concurrency_minute_vector",
    f"""WITH {PLACES}, {CAPPED.format(cap=90)},
secs AS (SELECT DISTINCT app_id, user_id, unnest(range(s, e)) AS t FROM sess WHERE e > s),
cnt AS (SELECT app_id, t, count(*) AS c FROM secs GROUP BY ALL),
mins AS (SELECT DISTINCT app_id, t // 60 AS m FROM cnt),
grid AS (SELECT app_id, m, unnest(range(60)) AS i FROM mins),
v AS (SELECT grid.app_id, m, i, coalesce(c, 0) AS c
      FROM grid LEFT JOIN cnt ON cnt.app_id = grid.app_id AND cnt.t = m * 60 + i)
SELECT strftime(make_timestamp(m * 60000000), '%Y%m%d%H%M') AS stat_key, app_id,
       string_agg(CAST(c AS VARCHAR), ',' ORDER BY i) AS css_ccu,
       CAST(sum(c) AS DOUBLE) / 60 AS avg_ccu, min(c) AS min_ccu, max(c) AS max_ccu
FROM v GROUP BY app_id, m""",
)
def concurrency_minute_vector(spark, sf_dir):
    """The 60 counts of each minute, as the text the statistics table stores."""
    placed = capped_sessions(spark, sf_dir, cap=90).join(places(spark, sf_dir), "user_id")
    out = concurrency_vector(placed, ["app_id"], ["user_id"], "on_at", "off_at")
    return out.select(
        MINUTE.key("bucket").alias("stat_key"),
        "app_id",
        F.array_join(F.col("seconds").cast("array<string>"), ",").alias("css_ccu"),
        "avg_ccu",
        F.col("min_ccu").cast("bigint").alias("min_ccu"),
        F.col("max_ccu").cast("bigint").alias("max_ccu"),
    )


@query(
    "concurrency_from_onoff",
    f"""WITH {PLACES},
m AS (SELECT user_id, ts, event_type = 'signup' AS is_on, lead(ts) OVER w AS nts,
        lead(event_type = 'signup') OVER w AS non, lag(ts) OVER w AS pts,
        lag(event_type = 'signup') OVER w AS pon
      FROM events WHERE event_type IN ('signup', 'error')
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
x AS (SELECT user_id,
        CASE WHEN is_on THEN ts ELSE greatest(pts, ts - INTERVAL 7200 SECOND) END AS a,
        CASE WHEN NOT is_on THEN ts WHEN NOT non THEN nts
             ELSE least(nts, ts + INTERVAL 7200 SECOND) END AS b
      FROM m WHERE is_on OR pon IS NULL OR NOT pon),
sess AS (SELECT user_id, {SEC.format('a')} AS s, {SEC.format('b')} AS e, app_id, site_id, server_id
         FROM x JOIN places USING (user_id)),
{sweep(3600, leveled_iv('sess', 'user_id'))}
SELECT strftime(bucket, '%Y%m%d%H') AS stat_key, {E_IDS}, avg_ccu, min_ccu, max_ccu
FROM ccu WHERE level <> 'server'""",
)
def concurrency_from_onoff(spark, sf_dir):
    """Sign-up as ON and error as OFF, two hours where the other end is missing."""
    marks = table(spark, sf_dir, "events").filter(F.col("event_type").isin("signup", "error"))
    sessions = sessions_from_marks(
        marks.select("ts", "event_id", "user_id", "event_type"), ["user_id"], "ts", ["ts", "event_id"],
        minute_chunk("ts"), F.col("event_type") == "signup", timeout=7200,
    )
    placed = sessions.join(places(spark, sf_dir), "user_id")
    out = ccu_levels(placed, "user_id", HOUR, [SITE, APP]).filter("max_ccu > 0")
    return out.select(HOUR.key("bucket").alias("stat_key"), "level", *IDS, *ZEROS)
