"""Parsers on the given tables: every event is rendered as a log line and parsed back.

The SQL side never sees the lines; it states the columns the parser must recover.
Events with ``k`` of 90 and more make lines that the parser must refuse.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from opslog.catalog.base import K, prop_k, query, table
from opslog.ingest.envelope import accepted, rejected
from opslog.ingest.metrics import host_metrics, parse_samples, switch_metrics
from opslog.ingest.router import parse_route, parse_status
from opslog.ingest.sessions import parse_probe, parse_session
from opslog.ingest.web import alerts, parse_router_web, parse_web

STAMP = "yyyy-MM-dd HH:mm:ss.SSS"
SQL_STAMP = "strftime(ts, '%Y-%m-%d %H:%M:%S.%g')"
SQL_SECOND = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
SQL_PARTS = "strftime(ts, '%Y%m%d') AS dt, strftime(ts, '%H') AS hh"
SQL_MAC = "printf('02:00:00:%02d:%02d:%02d', (user_id // 10000) % 100, (user_id // 100) % 100, user_id % 100)"
E = f"e AS (SELECT *, {K} AS k, {SQL_MAC} AS mac FROM events)"


def source(spark, sf_dir):
    u = F.col("user_id")
    pair = [F.call_function("div", u, F.lit(d)) % 100 for d in (10000, 100, 1)]
    return (
        table(spark, sf_dir, "events")
        .withColumn("k", prop_k())
        .withColumn("mac", F.format_string("02:00:00:%02d:%02d:%02d", *pair))
        .withColumn("stamp", F.date_format("ts", STAMP))
    )


def envelope(message, **fields):
    return F.to_json(F.struct(message.alias("message"), *[c.alias(n) for n, c in fields.items()])).alias("value")


def text_time(df, *cols, fmt=STAMP):
    return df.withColumns({c: F.date_format(c, fmt) for c in cols})


def route_lines(spark, sf_dir):
    request = F.format_string("{%s}, INIT, A%d, S%d", "mac", F.col("k") % 5, F.col("k") % 25)
    response = F.format_string("%d, TEXT, {198.51.100.%d}, 7000, 640, 360, 0, 0", F.col("k") % 2, "k")
    arguments = F.when(F.col("event_type") == "view", request).otherwise(response)
    mode = F.when(F.col("event_type") == "view", F.lit("Request")).otherwise(F.lit("Response"))
    line = F.format_string(
        "[ INFO ] %s [%06d_#{%s}_192.0.2.%d[5000]]  -  %s Route Msg : ( %s )",
        "stamp", "event_id", "mac", "k", mode, F.when(F.col("k") >= 90, F.lit("x")).otherwise(arguments),
    )
    return source(spark, sf_dir).select(envelope(line, host=F.lit("router01"), type=F.lit("csr: 8080")))


# `#{mac}` loses its mark first and its braces second.
ROUTE_COLS = f"""'ROUTER01' AS router_id, '8080' AS router_port, {SQL_STAMP} AS log_time,
  printf('%06d', event_id) AS session_id, mac AS client_mac, '192.0.2.' || k AS client_ip,
  '5000' AS client_port"""


@query(
    "parse_route",
    f"""WITH {E}
SELECT {ROUTE_COLS}, CASE WHEN q THEN 'Request' ELSE 'Response' END AS mode,
  CASE WHEN q THEN '' ELSE '198.51.100.' || k END AS server_ip,
  CASE WHEN q THEN 'A' || (k % 5) ELSE '' END AS app_id, CASE WHEN q THEN 'S' || (k % 25) ELSE '' END AS site_id,
  CASE WHEN q THEN 'INIT' ELSE '' END AS method, CASE WHEN q THEN '' ELSE CAST(k % 2 AS VARCHAR) END AS result,
  CASE WHEN q THEN '' ELSE 'TEXT' END AS result_text, CASE WHEN q THEN NULL ELSE 7000 END AS server_port,
  CASE WHEN q THEN NULL ELSE 640 END AS width, CASE WHEN q THEN NULL ELSE 360 END AS height,
  CASE WHEN q THEN '' ELSE '0' END AS va, CASE WHEN q THEN '' ELSE '0' END AS loading, {SQL_PARTS}
FROM (SELECT *, event_type = 'view' AS q FROM e WHERE k < 90)""",
)
def parse_route_query(spark, sf_dir):
    return text_time(accepted(parse_route(route_lines(spark, sf_dir))), "log_time")


@query(
    "parse_rejects",
    f"""WITH {E} SELECT 'arguments' AS reject, count(*) AS n FROM e WHERE k >= 90""",
)
def parse_rejects(spark, sf_dir):
    """The quarantine keeps the line and says what is wrong with it."""
    refused = rejected(parse_route(route_lines(spark, sf_dir)))
    return refused.groupBy("reject").agg(F.count("value").alias("n"))


def status_lines(spark, sf_dir):
    request = F.format_string(
        "{198.51.100.%d}, %d, S%d, OPEN, {%s}, ,  ", F.col("k"), F.col("k"), "event_id", "mac"
    )
    response = F.format_string("%d, TEXT", F.col("k") % 2)
    asks = F.col("event_type") == "view"
    line = F.format_string(
        "[ INFO ] %s [198.51.100.%d[77]]  -  %s Status Msg : ( %s )",
        "stamp", "k", F.when(asks, F.lit("Request")).otherwise(F.lit("Response")),
        F.when(F.col("k") >= 90, F.lit("x")).when(asks, request).otherwise(response),
    )
    return source(spark, sf_dir).select(envelope(line, host=F.lit("router01"), type=F.lit("csr:8080")))


@query(
    "parse_status",
    f"""WITH {E}
SELECT 'ROUTER01' AS router_host, '8080' AS router_port, {SQL_STAMP} AS log_time,
  CASE WHEN q THEN mac ELSE '' END AS client_mac, CASE WHEN q THEN '198.51.100.' || k ELSE '' END AS server_ip,
  '77' AS router_session, CASE WHEN q THEN 'Request' ELSE 'Response' END AS mode,
  CASE WHEN q THEN k END AS users, CASE WHEN q THEN 'S' || event_id ELSE '' END AS session_id,
  CASE WHEN q THEN 'OPEN' ELSE '' END AS session_status, CASE WHEN q THEN '' ELSE CAST(k % 2 AS VARCHAR) END AS result,
  CASE WHEN q THEN '' ELSE 'TEXT' END AS result_text, {SQL_PARTS}
FROM (SELECT *, event_type = 'view' AS q FROM e WHERE k < 90)""",
)
def parse_status_query(spark, sf_dir):
    return text_time(accepted(parse_status(status_lines(spark, sf_dir))), "log_time")


MOTIONS = {"signup": "ON", "error": "OFF", "view": "BW", "click": "20", "purchase": "SESSION_USE"}


def session_lines(spark, sf_dir):
    motion = F.lit(None).cast("string")
    for kind, name in MOTIONS.items():
        motion = F.when(F.col("event_type") == kind, F.lit(name)).otherwise(motion)
    off = F.date_format(F.col("ts") + F.make_dt_interval(secs=F.col("k")), "yyyy-MM-dd HH:mm:ss")
    client = F.when(F.col("k") >= 90, F.lit("short")).otherwise(F.col("mac"))
    line = F.format_string(
        "at=%s,sid=%d,kind=info,server=198.51.100.%d,menu=m4,motion=%s,"
        "amount=%d,client=#{%s},site=%d,end=%s",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "event_id", "k", motion, "k", client, F.col("k") % 25, off,
    )
    return source(spark, sf_dir).select(envelope(line, host=F.lit("h")))


SESSION_SQL = f"""SELECT {SQL_SECOND} AS registered_at, CAST(event_id AS VARCHAR) AS session_id, 'info' AS log_type,
  '198.51.100.' || k AS server_ip, 'm4' AS menu_path,
  CASE event_type WHEN 'signup' THEN 'ON' WHEN 'error' THEN 'OFF' ELSE 'BW' END AS motion,
  CAST(k AS DOUBLE) AS motion_value, mac AS client_id, CAST(k % 25 AS VARCHAR) AS site_id,
  CASE WHEN event_type = 'error' THEN strftime(ts + k * INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') END AS off_at,
  {SQL_PARTS}
FROM e WHERE k < 90 AND event_type IN ('signup', 'error', 'view')"""


@query("parse_session", f"WITH {E} {SESSION_SQL}")
def parse_session_query(spark, sf_dir):
    parsed = accepted(parse_session(session_lines(spark, sf_dir)))
    return text_time(parsed, "registered_at", "off_at", fmt="yyyy-MM-dd HH:mm:ss")


@query(
    "parse_probe",
    f"""WITH {E}
SELECT CAST(event_id AS VARCHAR) AS test_no, {SQL_SECOND} AS test_time, '9' AS probe_id,
  '198.51.100.' || k AS server_ip, mac AS client_id, CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'OK' END AS result,
  CASE WHEN k >= 90 THEN NULL ELSE value END AS psnr, k AS err_cnt, 0 AS nv_err_cnt,
  CASE WHEN event_type = 'error' THEN 'Low PSNR' ELSE '' END AS detail, '5' AS sub_app_id, {SQL_PARTS}
FROM e""",
)
def parse_probe_query(spark, sf_dir):
    """A number that is none becomes null, the row stays."""
    bad = F.col("event_type") == "error"
    line = F.format_string(
        '%d,"%s",9, 198.51.100.%d ,{%s},%s,%s,%d,0,%s,5',
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "k", "mac",
        F.when(bad, F.lit("FAIL")).otherwise(F.lit("OK")),
        F.when(F.col("k") >= 90, F.lit("n/a")).otherwise(F.col("value").cast("string")),
        "k", F.when(bad, F.lit("Low PSNR")).otherwise(F.lit("")),
    )
    lines = source(spark, sf_dir).select(envelope(line))
    return text_time(accepted(parse_probe(lines)), "test_time", fmt="yyyy-MM-dd HH:mm:ss")


def sample_lines(spark, sf_dir, plugin, category, values, dsnames):
    line = F.format_string(
        '[{"values":[%s],"dstypes":["gauge"],"dsnames":[%s],"time":%d,"interval":10,"host":"h%d",'
        '"plugin":"%s","plugin_instance":"var-log","type":"percent","type_instance":"%s"}]',
        values, dsnames, F.unix_seconds(F.col("ts").cast("timestamp")), "k", plugin, category,
    )
    headed = F.when(F.col("k") % 2 == 0, F.concat(F.lit("<13>2024-01-01 "), line)).otherwise(line)
    return source(spark, sf_dir).select(headed.alias("value"))


PLUGINS = {"view": "cpu", "click": "memory", "error": "df", "purchase": "cpu", "signup": "load"}
KINDS = {"view": "user", "click": "used", "error": "free", "purchase": "nice", "signup": "used"}


def choose(mapping):
    out = F.lit(None).cast("string")
    for kind, name in mapping.items():
        out = F.when(F.col("event_type") == kind, F.lit(name)).otherwise(out)
    return out


@query(
    "parse_agent",
    f"""WITH {E}
SELECT CASE event_type WHEN 'view' THEN 'cpu' WHEN 'click' THEN 'mem' ELSE 'disk' END AS metric_table,
  CAST(k AS VARCHAR) AS "values", 'gauge' AS ds_types, 'value' AS ds_names, {SQL_SECOND} AS sample_time,
  '10' AS "interval", 'H' || k AS host,
  CASE event_type WHEN 'view' THEN 'cpu' WHEN 'click' THEN 'memory' ELSE 'df' END AS plugin,
  CASE WHEN event_type = 'error' THEN 'var/log' ELSE 'var-log' END AS plugin_instance, 'percent' AS type,
  CASE event_type WHEN 'view' THEN 'user' WHEN 'click' THEN 'used' ELSE 'free' END AS type_instance,
  '' AS meta, {SQL_PARTS}
FROM e WHERE event_type IN ('view', 'click', 'error')""",
)
def parse_agent(spark, sf_dir):
    """One parse, three tables; categories no table keeps are left out."""
    lines = sample_lines(spark, sf_dir, choose(PLUGINS), choose(KINDS), F.col("k").cast("string"), F.lit('"value"'))
    tables = host_metrics(accepted(parse_samples(lines)))
    out = None
    for name, rows in tables.items():
        rows = rows.withColumn("metric_table", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return text_time(out, "sample_time", fmt="yyyy-MM-dd HH:mm:ss")


@query(
    "parse_snmp",
    f"""WITH {E}
SELECT k || ',' || (k * 2) AS "values", 'rx,tx' AS ds_names, {SQL_SECOND} AS sample_time, 'H' || k AS host,
  'Port ' || (k % 8) AS type_instance, {SQL_PARTS}
FROM e WHERE k < 90""",
)
def parse_snmp(spark, sf_dir):
    label = F.when(F.col("k") >= 90, F.lit("Link aggregate")).otherwise(
        F.concat(F.lit("Port "), (F.col("k") % 8).cast("string"))
    )
    values = F.concat_ws(",", F.col("k").cast("string"), (F.col("k") * 2).cast("string"))
    lines = sample_lines(spark, sf_dir, F.lit("snmp"), label, values, F.lit('"rx","tx"'))
    rows = switch_metrics(accepted(parse_samples(lines)))
    return text_time(rows, "sample_time", fmt="yyyy-MM-dd HH:mm:ss").select(
        "values", "ds_names", "sample_time", "host", "type_instance", "dt", "hh"
    )


def web_lines(spark, sf_dir):
    line = F.format_string(
        '192.0.2.%d - - [%s +0900] "GET / HTTP/1.1" 200 512', "k", F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss")
    )
    return source(spark, sf_dir).select(
        envelope(
            F.when(F.col("k") >= 90, F.lit("no time here")).otherwise(line),
            host=F.lit("web01"),
            type=F.lit("web: 80"),
            css_ip=F.concat(F.lit("198.51.100."), F.col("k").cast("string")),
            ret_code=F.when(F.col("k") < 60, F.lit("200")),
            bytes=(F.col("k") * 100).cast("string"),
        )
    )


@query(
    "parse_web",
    f"""WITH {E}
SELECT {SQL_SECOND} AS log_time, 'WEB01' AS host, '198.51.100.' || k AS server_ip,
  CASE WHEN k < 60 THEN '200' ELSE '' END AS ret_code, CAST(k * 100 AS BIGINT) AS bytes, {SQL_PARTS}
FROM e WHERE k < 90""",
)
def parse_web_query(spark, sf_dir):
    parsed = accepted(parse_web(web_lines(spark, sf_dir)))
    return text_time(parsed, "log_time", fmt="yyyy-MM-dd HH:mm:ss")


@query(
    "parse_router_web",
    f"""WITH {E}
SELECT {SQL_SECOND} AS log_time, 'WEB01' AS host, '80' AS port, {SQL_PARTS} FROM e WHERE k < 90""",
)
def parse_router_web_query(spark, sf_dir):
    parsed = accepted(parse_router_web(web_lines(spark, sf_dir)))
    return text_time(parsed, "log_time", fmt="yyyy-MM-dd HH:mm:ss")


@query(
    "parse_web_zoned",
    f"""WITH {E}
SELECT event_id % 2 AS host_kind, {SQL_SECOND} AS log_time, count(*) AS n, {SQL_PARTS}
FROM e GROUP BY ALL""",
)
def parse_web_zoned(spark, sf_dir):
    """Hosts of two zones: each line lands in the second and hour of its instant."""
    east = F.col("event_id") % 2 == 0
    wall = F.when(east, F.col("ts") + F.expr("interval 9 hours")).otherwise(F.col("ts") - F.expr("interval 210 minutes"))
    line = F.format_string(
        '192.0.2.%d - - [%s %s] "GET / HTTP/1.1" 200 512',
        "k", F.date_format(wall, "dd/MMM/yyyy:HH:mm:ss"), F.when(east, F.lit("+0900")).otherwise(F.lit("-0330")),
    )
    lines = source(spark, sf_dir).select(envelope(line, host=(F.col("event_id") % 2).cast("string")))
    parsed = accepted(parse_web(lines, {"host": "host"}, zoned=True))
    counted = parsed.groupBy(F.col("host").cast("bigint").alias("host_kind"), "log_time", "dt", "hh").agg(F.count("*").alias("n"))
    return text_time(counted, "log_time", fmt="yyyy-MM-dd HH:mm:ss")


@query(
    "alert_filter",
    "SELECT event_id FROM events WHERE event_type = 'error'",
)
def alert_filter(spark, sf_dir):
    """Lines whose field has the alert value go on untouched."""
    lines = table(spark, sf_dir, "events").select(
        F.to_json(F.struct("event_id", F.col("event_type").alias("response"))).alias("value")
    )
    found = alerts(lines, "response", "error")
    return found.select(F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"))
