"""The statistics jobs from raw lines to hour, day and month tables, on the given events.

A month of events is played thirty times faster, so that it fills one day of five-minute slots.  Each query
renders them as log lines, parses them into a new lake, runs the job's backfill in quarter days, and rolls
its tables up; the SQL states from the events alone what the tables of all four grains must hold.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import functions as F

from opslog.catalog.base import K, mean_units, prop_k, query, table, units
from opslog.catalog.concurrent import leveled_iv, sweep
from opslog.catalog.ingests import SQL_MAC, STAMP, envelope, source
from opslog.ingest.envelope import accepted
from opslog.ingest.router import parse_route, parse_status
from opslog.ingest.sessions import parse_probe, parse_session
from opslog.ingest.web import parse_router_web, parse_web
from opslog.plans.lake import Lake
from opslog.plans.rollups import ROLLUPS
from opslog.plans.run import backfill, publish_dashboard, run_day, run_rollup
from opslog.session import scratch_dir
from opslog.sinks.tables import save, save_snapshot
from opslog.spec import DAY, HOUR, MINUTE, MONTH

BEGIN, END = datetime(2024, 1, 1), datetime(2024, 1, 2)
STEP = timedelta(hours=6)
ZERO = 1704067200000000  # BEGIN in microseconds
PACE = 30
SECOND_STAMP = "yyyy-MM-dd HH:mm:ss"
GRAINS = {"minute": MINUTE, "hour": HOUR, "day": DAY, "month": MONTH}


def played(spark, sf_dir):
    """Events on the faster clock, with what every line kind needs."""
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - ZERO
    rows = source(spark, sf_dir).withColumn("ts", F.timestamp_micros(F.call_function("div", micros, F.lit(PACE)) + ZERO))
    return rows.withColumns(
        {
            "k": prop_k(),
            "stamp": F.date_format("ts", STAMP),
            "second": F.date_format("ts", SECOND_STAMP),
            "server": F.concat(F.lit("198.51.100."), (prop_k() % 30).cast("string")),
            "router": F.concat(F.lit("router0"), (F.col("user_id") % 5).cast("string")),
        }
    )


def new_lake(spark, sf_dir, **raw) -> Lake:
    """A lake with its dimensions and the accepted rows of the given raw tables."""
    lake = Lake(spark, scratch_dir(spark, "lake"))
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    place = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    servers = place.select(
        F.col("r_name").alias("app_id"),
        F.col("n_name").alias("site_id"),
        F.col("n_nationkey").cast("string").alias("host_id"),
        F.concat(F.lit("h"), F.col("n_nationkey").cast("string")).alias("host_name"),
        F.concat(F.lit("198.51.100."), F.col("n_nationkey").cast("string")).alias("server_ip"),
        F.explode(F.array(F.lit("CSS"), F.lit("WEB"))).alias("role"),
    )
    number = F.col("r_regionkey").cast("string")
    routers = region.select(
        F.col("r_name").alias("site_id"),
        F.concat(F.lit("ROUTER0"), number).alias("router_host"),
        F.lit("8080").alias("router_port"),
        F.concat(F.lit("R"), number).alias("router_id"),
    )
    save_snapshot(servers, lake.dim_path("servers"))
    save_snapshot(routers, lake.dim_path("routers"))
    for name, rows in raw.items():
        save(accepted(rows), lake.raw_path(name))
    return lake


def all_grains(lake: Lake, job: str, name: str):
    """Backfill of the day, its roll-ups, and the rows of every grain."""
    backfill(lake, job, BEGIN, END, STEP)
    run_rollup(lake, name, HOUR, BEGIN, END)
    run_day(lake, END, [name])
    run_rollup(lake, name, MONTH, BEGIN, END)
    return stored(lake, name)


def stored(lake: Lake, name: str):
    keys, rules = ROLLUPS[name]
    parts = [
        lake.stat(name, grain, BEGIN, END).select(
            F.lit(shown).alias("grain"), "stat_key", *keys, *[F.col(r.name) for r in rules]
        )
        for shown, grain in GRAINS.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


# ---- SQL ----------------------------------------------------------------------

LINES = f"""e AS (SELECT event_id, user_id, event_type, value, {K} AS k, {SQL_MAC} AS mac,
  '198.51.100.' || ({K} % 30) AS server_ip,
  make_timestamp({ZERO} + (epoch_us(ts) - {ZERO}) // {PACE}) AS t FROM events),
dim AS (SELECT r_name AS app_id, n_name AS site_id, '198.51.100.' || n_nationkey AS server_ip
  FROM nation JOIN region ON n_regionkey = r_regionkey),
cal AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-01 23:59:00',
  INTERVAL 1 MINUTE)) AS bucket),
win AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-01 18:00:00',
  INTERVAL 6 HOUR)) AS opens)"""
FORMATS = {"minute": "%Y%m%d%H%M", "hour": "%Y%m%d%H", "day": "%Y%m%d", "month": "%Y%m"}
SETS = """GROUP BY GROUPING SETS ((grain, stat_key, app_id, site_id, server_ip),
  (grain, stat_key, app_id, site_id), (grain, stat_key, app_id))"""
LEVELED = """grain, stat_key,
  CASE GROUPING(site_id, server_ip) WHEN 0 THEN 'server' WHEN 1 THEN 'site' ELSE 'app' END AS level,
  app_id, coalesce(site_id, '*') AS site_id, coalesce(server_ip, '*') AS server_ip"""


def every_grain(rows: str, grains=tuple(FORMATS)) -> str:
    """``rows`` (with a minute ``bucket``) once per grain, with the grain's key."""
    return " UNION ALL ".join(
        f"SELECT '{g}' AS grain, strftime(bucket, '{FORMATS[g]}') AS stat_key, * EXCLUDE (bucket) FROM {rows}" for g in grains
    )


def filled(stats: str, counts: list[str]) -> str:
    """Counts per minute of every server, zero where there is nothing."""
    shown = ", ".join(f"coalesce({c}, 0) AS {c}" for c in counts)
    return f"""SELECT cal.bucket, dim.*, {shown} FROM cal CROSS JOIN dim LEFT JOIN {stats} USING (bucket, server_ip)"""


def added(counts: list[str], part: str = "success_cnt", whole: str | None = None) -> str:
    sums = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in counts)
    if whole is None:
        return sums
    return f"{sums}, coalesce(CAST(sum({part}) AS DOUBLE) * 100 / nullif(sum({whole}), 0), 0) AS success_rate"


PAIR_COUNTS = ["req_cnt", "success_cnt", "fail_cnt"]
PAIRED = "count(*) AS req_cnt, sum(success) AS success_cnt, count(*) - sum(success) AS fail_cnt"


def next_sql(session: str, answer_ip: str) -> str:
    """CTE ``pairs``: requests with their next row, as a window of six hours and a minute sees it."""
    order = f"ms, mode, {answer_ip}, result"
    return f"""seen AS (SELECT log.*, opens FROM log JOIN win
  ON ms >= opens AND ms < opens + INTERVAL 6 HOUR + INTERVAL 1 MINUTE),
nxt AS (SELECT *, lead({answer_ip}) OVER w AS next_ip, lead(result) OVER w AS next_result,
    lead(mode) OVER w AS next_mode
  FROM seen WINDOW w AS (PARTITION BY opens, {session} ORDER BY {order})),
pairs AS (SELECT *, date_trunc('minute', ms) AS bucket, CAST(next_result = '0' AS INTEGER) AS success
  FROM nxt WHERE mode = 'Request' AND next_mode IS NOT NULL AND ms < opens + INTERVAL 6 HOUR)"""


ROUTE_LOG = """log AS (SELECT date_trunc('millisecond', t) AS ms, user_id, user_id % 5 AS router,
  CASE WHEN event_type IN ('view', 'click') THEN 'Request' ELSE 'Response' END AS mode,
  CASE WHEN event_type IN ('view', 'click') THEN '' ELSE server_ip END AS server_ip,
  CASE WHEN event_type IN ('view', 'click') THEN '' ELSE CAST(k % 2 AS VARCHAR) END AS result FROM e WHERE k < 90)"""


def route_log(spark, sf_dir):
    asks = F.col("event_type").isin("view", "click")
    request = F.format_string("{%s}, INIT, A%d, S%d", "mac", F.col("k") % 5, F.col("k") % 25)
    response = F.format_string("%d, TEXT, {%s}, 7000, 640, 360, 0, 0", F.col("k") % 2, "server")
    line = F.format_string(
        "[ INFO ] %s [u%d_#{%s}_192.0.2.7[5000]]  -  %s Route Msg : ( %s )",
        "stamp", "user_id", "mac", F.when(asks, F.lit("Request")).otherwise(F.lit("Response")),
        F.when(F.col("k") >= 90, F.lit("x")).when(asks, request).otherwise(response),
    )
    lines = played(spark, sf_dir).select(envelope(line, host=F.col("router"), type=F.lit("csr: 8080")))
    return parse_route(lines)


@query(
    "job_route",
    f"""WITH {LINES}, {ROUTE_LOG}, {next_sql("user_id", "server_ip")},
s AS (SELECT bucket, next_ip AS server_ip, {PAIRED} FROM pairs WHERE next_ip <> '' GROUP BY ALL),
z AS ({filled("s", PAIR_COUNTS)}), g AS ({every_grain("z")})
SELECT {LEVELED}, {added(PAIR_COUNTS, whole="req_cnt")} FROM g {SETS}""",
)
def job_route(spark, sf_dir):
    """Success of routing requests per server, site and app."""
    return all_grains(new_lake(spark, sf_dir, route_log=route_log(spark, sf_dir)), "route", "route")


@query(
    "job_route_router",
    f"""WITH {LINES}, {ROUTE_LOG}, {next_sql("user_id", "server_ip")},
s AS (SELECT bucket, 'R' || router AS router_id, {PAIRED} FROM pairs WHERE next_ip <> '' GROUP BY ALL),
z AS (SELECT bucket, router_id, coalesce(req_cnt, 0) AS req_cnt, coalesce(success_cnt, 0) AS success_cnt,
    coalesce(fail_cnt, 0) AS fail_cnt
  FROM cal CROSS JOIN (SELECT 'R' || r_regionkey AS router_id FROM region) LEFT JOIN s USING (bucket, router_id)),
g AS ({every_grain("z")})
SELECT grain, stat_key, router_id, {added(PAIR_COUNTS, whole="req_cnt")} FROM g GROUP BY ALL""",
)
def job_route_router(spark, sf_dir):
    """The same pairs by the router that took the request."""
    return all_grains(new_lake(spark, sf_dir, route_log=route_log(spark, sf_dir)), "route", "route_router")


STATUS_LOG = """log AS (SELECT date_trunc('millisecond', t) AS ms, user_id, k,
  CASE WHEN event_type IN ('view', 'click') THEN 'Request' ELSE 'Response' END AS mode,
  CASE WHEN event_type IN ('view', 'click') THEN server_ip ELSE '' END AS server_ip,
  CASE WHEN event_type IN ('view', 'click') THEN '' ELSE CAST(k % 2 AS VARCHAR) END AS result FROM e WHERE k < 90)"""


def status_log(spark, sf_dir):
    asks = F.col("event_type").isin("view", "click")
    word = F.when(F.col("k") % 3 == 0, F.lit("CLOSE")).otherwise(F.lit("OPEN"))
    request = F.format_string("{%s}, %d, S%d, %s, {%s}, , ", "server", "k", "event_id", word, "mac")
    line = F.format_string(
        "[ INFO ] %s [198.51.100.3[%d]]  -  %s Status Msg : ( %s )",
        "stamp", "user_id", F.when(asks, F.lit("Request")).otherwise(F.lit("Response")),
        F.when(F.col("k") >= 90, F.lit("x")).when(asks, request).otherwise(F.format_string("%d, TEXT", F.col("k") % 2)),
    )
    lines = played(spark, sf_dir).select(envelope(line, host=F.col("router"), type=F.lit("csr: 8080")))
    return parse_status(lines)


@query(
    "job_status",
    f"""WITH {LINES}, {STATUS_LOG}, {next_sql("user_id", "server_ip")},
s AS (SELECT bucket, server_ip, {PAIRED} FROM pairs GROUP BY ALL),
z AS ({filled("s", PAIR_COUNTS)}), g AS ({every_grain("z")})
SELECT {LEVELED}, {added(PAIR_COUNTS, whole="req_cnt")} FROM g {SETS}""",
)
def job_status(spark, sf_dir):
    """Success of status requests by the server that the request names."""
    return all_grains(new_lake(spark, sf_dir, status_log=status_log(spark, sf_dir)), "status", "status")


MOTION_OF = {"signup": "ON", "error": "OFF", "purchase": "OFF", "view": "BW", "click": "BW"}


def session_log(spark, sf_dir):
    off = F.date_format(F.col("ts") + F.make_dt_interval(secs=F.col("k")), SECOND_STAMP)
    motion = F.element_at(F.create_map(*[F.lit(x) for pair in MOTION_OF.items() for x in pair]), F.col("event_type"))
    line = F.format_string(
        "at=%s,sid=%d,kind=info,server=%s,menu=m4,motion=%s,amount=%d,client=#{%s},site=%d,end=%s",
        "second", "event_id", "server", motion, F.col("k").cast("bigint") * 1000000,
        F.when(F.col("k") >= 90, F.lit("short")).otherwise(F.col("mac")), F.col("k") % 25, off,
    )
    return parse_session(played(spark, sf_dir).select(envelope(line, host=F.lit("h"))))


OFFS = """f AS (SELECT date_trunc('second', t) AS s, k, mac, server_ip FROM e
  WHERE k < 90 AND event_type IN ('error', 'purchase'))"""


@query(
    "job_uvpv",
    f"""WITH {LINES}, {OFFS},
v AS (SELECT date_trunc('minute', s) AS bucket, mac, dim.* FROM f JOIN dim USING (server_ip)),
g AS ({every_grain("v", ("minute", "hour"))}),
u AS (SELECT {LEVELED}, count(DISTINCT mac) AS uv, count(*) AS pv FROM g {SETS}),
ent AS (SELECT 'server' AS level, * FROM dim UNION SELECT 'site', app_id, site_id, '*' FROM dim
  UNION SELECT 'app', app_id, '*', '*' FROM dim),
keys AS (SELECT DISTINCT grain, stat_key FROM ({every_grain("cal", ("minute", "hour"))})),
z AS (SELECT grain, stat_key, ent.*, coalesce(uv, 0) AS uv, coalesce(pv, 0) AS pv
  FROM keys CROSS JOIN ent LEFT JOIN u USING (grain, stat_key, level, app_id, site_id, server_ip))
SELECT * FROM z
UNION ALL SELECT 'day', '20240101', level, app_id, site_id, server_ip, CAST(sum(uv) AS BIGINT), CAST(sum(pv) AS BIGINT)
FROM z WHERE grain = 'hour' GROUP BY ALL
UNION ALL SELECT 'month', '202401', level, app_id, site_id, server_ip, CAST(sum(uv) AS BIGINT), CAST(sum(pv) AS BIGINT)
FROM z WHERE grain = 'hour' GROUP BY ALL""",
)
def job_uvpv(spark, sf_dir):
    """Unique clients and views: hours from raw rows, days and months from hours."""
    return all_grains(new_lake(spark, sf_dir, session_log=session_log(spark, sf_dir)), "uvpv", "uvpv")


SHORT = {"c10_sec": (0, 10), "c20_sec": (10, 20), "c30_sec": (20, 30), "c40_sec": (30, 40), "c50_sec": (40, 50), "c60_sec": (50, 60), "other": (60, 100)}
BINS = ", ".join(f"count(*) FILTER (k > {lo} AND k <= {hi}) AS {name}" for name, (lo, hi) in SHORT.items())


@query(
    "job_usetime",
    f"""WITH {LINES}, {OFFS},
p AS (SELECT date_trunc('minute', s) AS bucket, k, server_ip, coalesce(app_id, '999') AS app_id,
    coalesce(site_id, '999') AS site_id FROM f LEFT JOIN dim USING (server_ip) WHERE k > 0),
g AS ({every_grain("p")})
SELECT {LEVELED}, count(*) AS total_cnt, {BINS} FROM g {SETS}""",
)
def job_usetime(spark, sf_dir):
    """Histogram of session lengths; servers that the dimension lacks stay as unknown."""
    return all_grains(new_lake(spark, sf_dir, session_log=session_log(spark, sf_dir)), "usetime", "usetime")


CENTS = "CAST(round(k * 1000000 * 8 / 60 / 1024 / 1024, 2) * 100 AS BIGINT)"
HALF_UP = "((2 * sum({c}) + count(*)) // (2 * count(*)))"


@query(
    "job_bandwidth",
    f"""WITH {LINES},
f AS (SELECT 'minute' AS grain, strftime(t, '%Y%m%d%H%M') AS stat_key, dim.*, {CENTS} AS c
  FROM e JOIN dim USING (server_ip) WHERE k < 90 AND event_type IN ('view', 'click')),
m AS (SELECT {LEVELED}, {HALF_UP.format(c="c")} AS a, min(c) AS lo, max(c) AS hi FROM f {SETS}),
ent AS (SELECT 'server' AS level, * FROM dim UNION SELECT 'site', app_id, site_id, '*' FROM dim
  UNION SELECT 'app', app_id, '*', '*' FROM dim),
z AS (SELECT 'minute' AS grain, strftime(bucket, '%Y%m%d%H%M') AS stat_key, ent.*, coalesce(a, 0) AS a,
    coalesce(lo, 0) AS lo, coalesce(hi, 0) AS hi
  FROM cal CROSS JOIN ent LEFT JOIN m ON m.stat_key = strftime(bucket, '%Y%m%d%H%M') AND m.level = ent.level
    AND m.app_id = ent.app_id AND m.site_id = ent.site_id AND m.server_ip = ent.server_ip),
hz AS (SELECT 'hour' AS grain, stat_key[1:10] AS stat_key, app_id, site_id, server_ip, a, lo, hi FROM z WHERE level = 'server'),
h AS (SELECT {LEVELED}, {HALF_UP.format(c="a")} AS a, min(lo) AS lo, max(hi) AS hi FROM hz {SETS}),
d AS (SELECT 'day' AS grain, stat_key[1:8] AS stat_key, level, app_id, site_id, server_ip, {HALF_UP.format(c="a")} AS a,
  min(lo) AS lo, max(hi) AS hi FROM h GROUP BY ALL),
r AS (SELECT * FROM z UNION ALL SELECT * FROM h UNION ALL SELECT * FROM d
  UNION ALL SELECT 'month', stat_key[1:6], level, app_id, site_id, server_ip, a, lo, hi FROM d)
SELECT * EXCLUDE (a, lo, hi), CAST(a / 100.0 AS DOUBLE) AS avg_mbps, CAST(lo / 100.0 AS DOUBLE) AS min_mbps,
  CAST(hi / 100.0 AS DOUBLE) AS max_mbps FROM r""",
)
def job_bandwidth(spark, sf_dir):
    """Mbit/s: minutes over samples, hours over servers' minutes, days over hours."""
    return all_grains(new_lake(spark, sf_dir, session_log=session_log(spark, sf_dir)), "bandwidth", "bandwidth")


CAUSES = {"low_psnr": "Low PSNR", "no_codec": "No Codec", "no_video": "Video lost", "connect_fail": "Connect refused"}
PROBE_COUNTS = ["test_cnt", "success_cnt", "fail_cnt", *CAUSES]
CAUSE_SQL = ", ".join(f"count(*) FILTER (event_type = 'error' AND k % 4 = {i}) AS {c}" for i, c in enumerate(CAUSES))


@query(
    "job_probe",
    f"""WITH {LINES},
s AS (SELECT date_trunc('minute', t) AS bucket, server_ip, count(*) AS test_cnt,
    count(*) FILTER (event_type <> 'error') AS success_cnt, count(*) FILTER (event_type = 'error') AS fail_cnt, {CAUSE_SQL}
  FROM e GROUP BY ALL),
z AS ({filled("s", PROBE_COUNTS)}), g AS ({every_grain("z")})
SELECT {LEVELED}, {added(PROBE_COUNTS, whole="test_cnt")} FROM g {SETS}""",
)
def job_probe(spark, sf_dir):
    """Outcome of quality tests with a counter per cause."""
    bad = F.col("event_type") == "error"
    cause = F.element_at(F.array(*[F.lit(c) for c in CAUSES.values()]), F.col("k") % 4 + 1)
    line = F.format_string(
        '%d,"%s",9,%s,{%s},%s,20.5,%d,0,%s,5', "event_id", "second", "server", "mac",
        F.when(bad, F.lit("FAIL")).otherwise(F.lit("OK")), "k", F.when(bad, cause).otherwise(F.lit("")),
    )
    rows = parse_probe(played(spark, sf_dir).select(envelope(line)))
    return all_grains(new_lake(spark, sf_dir, probe_log=rows), "probe", "probe")


WEB_COUNTS = ["req_cnt", "success_cnt", "c200_cnt", "c304_cnt", "fail_cnt"]


@query(
    "job_web",
    f"""WITH {LINES},
s AS (SELECT date_trunc('minute', t) AS bucket, server_ip, count(*) AS req_cnt,
    count(*) FILTER (k < 75) AS success_cnt, count(*) FILTER (k < 60) AS c200_cnt,
    count(*) FILTER (k >= 60 AND k < 75) AS c304_cnt, count(*) FILTER (k >= 75) AS fail_cnt, sum(k * 100) AS size
  FROM e WHERE k < 90 GROUP BY ALL),
z AS ({filled("s", [*WEB_COUNTS, "size"])}), g AS ({every_grain("z")})
SELECT {LEVELED}, {added(WEB_COUNTS, whole="req_cnt")}, CAST(sum(size) AS DOUBLE) / 1024 AS data_size FROM g {SETS}""",
)
def job_web(spark, sf_dir):
    """Web requests by response code; lines without a time are refused."""
    hit = F.format_string(
        '192.0.2.%d - - [%s +0900] "GET / HTTP/1.1" 200 512', "k", F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss")
    )
    code = F.when(F.col("k") < 60, F.lit("200")).when(F.col("k") < 75, F.lit("304")).when(F.col("k") < 85, F.lit("500"))
    lines = played(spark, sf_dir).select(
        envelope(
            F.when(F.col("k") >= 90, F.lit("no time here")).otherwise(hit),
            host=F.concat(F.lit("h"), (F.col("k") % 30).cast("string")),
            type=F.lit("web: 80"), css_ip=F.col("server"), ret_code=code, bytes=(F.col("k") * 100).cast("string"),
        )
    )
    return all_grains(new_lake(spark, sf_dir, web_log=parse_web(lines)), "web", "web")


# ---- averages of averages, in whole units of 1e-12 ------------------------------

ENT = """ent AS (SELECT 'server' AS level, * FROM dim UNION SELECT 'site', app_id, site_id, '*' FROM dim
  UNION SELECT 'app', app_id, '*', '*' FROM dim)"""


def chained(name: str, keys: str, minute: str = "CAST(a AS DOUBLE) / 1000000000000") -> str:
    """Hours, days and months of CTE ``m(stat_key, keys, a, lo, hi)``; ``minute`` is the average its own rows show."""
    step = f"{keys}, {mean_units('a')} AS a, min(lo) AS lo, max(hi) AS hi"
    shown = f"{keys}, CAST(a AS DOUBLE) / 1000000000000 AS avg_{name}, lo AS min_{name}, hi AS max_{name}"
    return f"""hourly AS (SELECT stat_key[1:10] AS stat_key, {step} FROM m GROUP BY stat_key[1:10], {keys}),
daily AS (SELECT stat_key[1:8] AS stat_key, {step} FROM hourly GROUP BY stat_key[1:8], {keys})
SELECT 'minute' AS grain, stat_key, {keys}, {minute} AS avg_{name}, lo AS min_{name}, hi AS max_{name} FROM m
UNION ALL SELECT 'hour', stat_key, {shown} FROM hourly
UNION ALL SELECT 'day', stat_key, {shown} FROM daily
UNION ALL SELECT 'month', stat_key[1:6], {shown} FROM daily"""


ID_KEYS = "level, app_id, site_id, server_ip"
MINUTE_KEY = "strftime(bucket, '%Y%m%d%H%M')"


@query(
    "job_session",
    f"""WITH {LINES},
s AS (SELECT date_trunc('minute', t) AS bucket, server_ip, CAST(sum(k) AS DOUBLE) / count(*) AS a, min(k) AS lo, max(k) AS hi
  FROM e WHERE k < 90 AND k % 3 > 0 AND event_type IN ('view', 'click') GROUP BY ALL),
z AS ({filled("s", ["a", "lo", "hi"])}), g AS ({every_grain("z", ("minute",))}),
m AS (SELECT * EXCLUDE (grain) FROM (SELECT {LEVELED}, {mean_units(units("a"))} AS a, min(lo) AS lo, max(hi) AS hi FROM g {SETS})),
{chained("session", ID_KEYS)}""",
)
def job_session(spark, sf_dir):
    """Users that open sessions report, averaged over servers, then over time."""
    return all_grains(new_lake(spark, sf_dir, status_log=status_log(spark, sf_dir)), "session", "session")


# Sessions as ``sweep`` reads them: its server column is called server_id.
RUNNING = f"""ses AS (SELECT mac, app_id, site_id, server_ip AS server_id, epoch_us(s) // 1000000 AS s,
    epoch_us(s) // 1000000 + k AS e
  FROM (SELECT date_trunc('second', t) AS s, k, mac, dim.* FROM e JOIN dim USING (server_ip)
        WHERE k < 90 AND event_type IN ('error', 'purchase')))"""
CCU = f"""{ENT}, {RUNNING}, {sweep(60, leveled_iv("ses", "mac"))},
m AS (SELECT strftime(cal.bucket, '%Y%m%d%H%M') AS stat_key, ent.*, coalesce(avg_ccu, 0) AS own,
    coalesce({units("avg_ccu")}, 0) AS a, coalesce(min_ccu, 0) AS lo,
    coalesce(max_ccu, 0) AS hi
  FROM cal CROSS JOIN ent LEFT JOIN ccu ON ccu.bucket = cal.bucket AND ccu.level = ent.level
    AND ccu.app_id = ent.app_id AND ccu.site_id = ent.site_id AND ccu.server_id = ent.server_ip)"""


@query("job_ccu", f"WITH {LINES}, {CCU}, {chained('ccu', ID_KEYS, 'own')}")
def job_ccu(spark, sf_dir):
    """Concurrent users at every level; sessions that run over a window's border count on both sides."""
    return all_grains(new_lake(spark, sf_dir, session_log=session_log(spark, sf_dir)), "ccu", "ccu")


RATE = """CAST(sum(n) AS DOUBLE) / 60 AS a, CASE WHEN count(*) = 60 THEN min(n) ELSE 0 END AS lo, max(n) AS hi"""


def rate_sql(entity: str, device: str, frame: str) -> str:
    """CTE ``m``: requests per second of devices and, averaged, of their sites."""
    return f"""p AS (SELECT date_trunc('second', t) AS sec, {entity} AS {device}, count(*) AS n FROM e WHERE k < 90 GROUP BY ALL),
s AS (SELECT date_trunc('minute', sec) AS bucket, {device}, {RATE} FROM p GROUP BY ALL),
z AS (SELECT {MINUTE_KEY} AS stat_key, site_id, {device}, coalesce(a, 0) AS a, coalesce(lo, 0) AS lo, coalesce(hi, 0) AS hi
  FROM cal CROSS JOIN ({frame}) LEFT JOIN s USING (bucket, {device})),
m AS (SELECT stat_key, CASE WHEN GROUPING({device}) = 1 THEN 'site' ELSE '{device.split("_")[0]}' END AS level, site_id,
    coalesce({device}, '*') AS {device}, {mean_units(units("a"))} AS a, min(lo) AS lo, max(hi) AS hi
  FROM z GROUP BY GROUPING SETS ((stat_key, site_id, {device}), (stat_key, site_id)))"""


def hits(spark, sf_dir, host):
    hit = F.format_string(
        '192.0.2.%d - - [%s +0900] "GET / HTTP/1.1" 200 512', "k", F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss")
    )
    text = F.when(F.col("k") >= 90, F.lit("no time here")).otherwise(hit)
    return played(spark, sf_dir).select(
        envelope(text, host=host, type=F.lit("csr: 8080"), css_ip=F.col("server"), ret_code=F.lit("200"), bytes=F.lit("1"))
    )


def rates(spark, sf_dir, name):
    router = hits(spark, sf_dir, F.col("router"))
    web = hits(spark, sf_dir, F.concat(F.lit("h"), (F.col("k") % 30).cast("string")))
    lake = new_lake(spark, sf_dir, router_web_log=parse_router_web(router), web_log=parse_web(web))
    return all_grains(lake, "tps", name)


@query(
    "job_tps_router",
    f"""WITH {LINES}, {rate_sql("'R' || (user_id % 5)", "router_id",
    "SELECT r_name AS site_id, 'R' || r_regionkey AS router_id FROM region")},
{chained("tps", "level, site_id, router_id")}""",
)
def job_tps_router(spark, sf_dir):
    """Requests per second of routers."""
    return rates(spark, sf_dir, "tps_router")


@query(
    "job_tps_web",
    f"""WITH {LINES}, {rate_sql("'H' || (k % 30)", "host_name",
    "SELECT n_name AS site_id, 'H' || n_nationkey AS host_name FROM nation")},
{chained("tps", "level, site_id, host_name")}""",
)
def job_tps_web(spark, sf_dir):
    """Requests per second of web hosts."""
    return rates(spark, sf_dir, "tps_web")


@query(
    "job_dashboard",
    f"""WITH {LINES}, {CCU}, {OFFS},
lst AS (SELECT max(bucket) AS bucket FROM cal),
c AS (SELECT app_id, site_id, hi AS ccu FROM m, lst WHERE level = 'site' AND stat_key = strftime(bucket, '%Y%m%d%H%M')),
v AS (SELECT app_id, site_id, count(DISTINCT mac) AS uv, count(*) AS pv FROM f JOIN dim USING (server_ip), lst
  WHERE date_trunc('minute', s) = bucket GROUP BY ALL),
b AS (SELECT app_id, site_id, CAST(floor(max({CENTS}) / 100.0) AS BIGINT) AS traffic FROM e JOIN dim USING (server_ip), lst
  WHERE k < 90 AND event_type IN ('view', 'click') AND date_trunc('minute', t) = bucket GROUP BY ALL),
snap AS (SELECT d.app_id, d.site_id, coalesce(ccu, 0) AS ccu, coalesce(uv, 0) AS uv, coalesce(pv, 0) AS pv,
    coalesce(traffic, 0) AS traffic
  FROM (SELECT DISTINCT app_id, site_id FROM dim) d LEFT JOIN c USING (app_id, site_id)
  LEFT JOIN v USING (app_id, site_id) LEFT JOIN b USING (app_id, site_id))
SELECT app_id || '_' || site_id AS id, CAST(ccu AS BIGINT) AS ccu, CAST(uv AS BIGINT) AS uv, CAST(pv AS BIGINT) AS pv,
  CAST(traffic AS BIGINT) AS traffic FROM snap
UNION ALL SELECT app_id, CAST(sum(ccu) AS BIGINT), CAST(sum(uv) AS BIGINT), CAST(sum(pv) AS BIGINT),
  CAST(sum(traffic) AS BIGINT) FROM snap GROUP BY app_id""",
)
def job_dashboard(spark, sf_dir):
    """The newest minute of three job tables side by side, published and read back."""
    lake = new_lake(spark, sf_dir, session_log=session_log(spark, sf_dir))
    for job in ("ccu", "uvpv", "bandwidth"):
        backfill(lake, job, BEGIN, END, STEP)
    path = scratch_dir(spark, "dashboard")
    for hour in (22, 23):  # the second upserts the first
        at = BEGIN + timedelta(hours=hour)
        publish_dashboard(lake, at, at + timedelta(hours=1), path, at)
    shown = spark.read.csv(
        f"{path}/version={BEGIN + timedelta(hours=23):%Y%m%d%H%M%S}", sep="|",
        schema="id STRING, ccu BIGINT, uv BIGINT, pv BIGINT, traffic BIGINT, chg_date TIMESTAMP",
    )
    return shown.drop("chg_date")
