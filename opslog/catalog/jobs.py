"""Streams, sinks and upkeep on the given tables.

Each query writes its rows to a new folder of the shared scratch space and reads
the result back.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from opslog.catalog.base import K, VALUE, places, prop_k, query, table, value_dec
from opslog.catalog.ingests import E, SESSION_SQL, choose, route_lines, sample_lines, session_lines
from opslog.functions.timekeys import day_part, hour_part
from opslog.ingest.envelope import accepted
from opslog.ingest.metrics import parse_samples
from opslog.ingest.sessions import parse_session
from opslog.ingest.web import alerts
from opslog.operators.uniques import client_visits
from opslog.plans.upkeep import delete_range, drop_old_days, layout
from opslog.session import scratch_dir
from opslog.sinks.tables import export_csv, index_rows, merge_snapshot, save, save_raw, save_snapshot
from opslog.sources.logs import import_router_log, import_session_log, read_stream, refused_router_log, refused_session_log
from opslog.sources.tables import read_window
from opslog.spec import DAY, HOUR
from opslog.streaming.aggregates import windowed
from opslog.streaming.ingest import agent_tables, append, fan_out, forward, ingest


def event_stream(spark, sf_dir):
    """The events file as a stream (the glob makes it a file-stream source)."""
    schema = table(spark, sf_dir, "events").schema
    return read_stream(spark, "parquet", {"path": f"{sf_dir}/events.parque*"}, schema)


def finished(stream):
    stream.awaitTermination()
    if stream.exception() is not None:
        raise stream.exception()


CLOSED = """closed AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events)"""


@query(
    "stream_pv",
    f"""WITH {CLOSED}
SELECT strftime(date_trunc('hour', ts), '%Y%m%d%H') AS stat_key, event_type, count(*) AS pv
FROM events, closed WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark GROUP BY 1, 2""",
)
def stream_pv(spark, sf_dir):
    """Views per hour and type from a stream, for the hours the watermark has closed."""
    out = scratch_dir(spark, "stream-pv")
    counts = windowed(
        event_stream(spark, sf_dir), "ts", "1 hour", "1 hour", ["event_type"], [F.count(F.lit(1)).alias("pv")]
    )
    finished(append(counts, f"{out}/data", f"{out}/state", True, partition_by=()))
    rows = spark.read.schema(counts.schema).parquet(f"{out}/data")
    return rows.select(HOUR.key("bucket").alias("stat_key"), "event_type", "pv")


@query(
    "stream_gauge",
    f"""WITH {CLOSED}
SELECT strftime(date_trunc('hour', ts), '%Y%m%d%H') AS stat_key, event_type,
  CAST(sum({VALUE}) AS DOUBLE) / count(*) AS avg_value, min(value) AS min_value, max(value) AS max_value
FROM events, closed WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark GROUP BY 1, 2""",
)
def stream_gauge(spark, sf_dir):
    out = scratch_dir(spark, "stream-gauge")
    v = value_dec()
    measures = [
        (F.sum(v).cast("double") / F.count(v)).alias("avg_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    ]
    stats = windowed(event_stream(spark, sf_dir), "ts", "1 hour", "1 hour", ["event_type"], measures)
    finished(append(stats, f"{out}/data", f"{out}/state", True, partition_by=()))
    rows = spark.read.schema(stats.schema).parquet(f"{out}/data")
    return rows.select(HOUR.key("bucket").alias("stat_key"), "event_type", "avg_value", "min_value", "max_value")


def line_files(spark, lines, label):
    """Log lines as text files, the input of a line stream or an import."""
    path = scratch_dir(spark, label)
    lines.select("value").write.text(path)
    return path


@query("stream_ingest", f"WITH {E} {SESSION_SQL}")
def stream_ingest(spark, sf_dir):
    """Session lines through a stream into a table partitioned by day and hour."""
    source = line_files(spark, session_lines(spark, sf_dir), "session-lines")
    out = scratch_dir(spark, "stream-ingest")
    rows = accepted(parse_session(read_stream(spark, "text", {"path": source})))
    finished(ingest(rows, f"{out}/data", f"{out}/state", "sessions", True))
    stored = spark.read.schema(rows.schema).parquet(f"{out}/data")
    second = "yyyy-MM-dd HH:mm:ss"
    return stored.drop("batch").withColumns({c: F.date_format(c, second) for c in ("registered_at", "off_at")})


@query(
    "stream_fanout",
    f"""WITH {E}
SELECT CASE event_type WHEN 'view' THEN 'cpu' WHEN 'click' THEN 'mem' ELSE 'disk' END AS metric_table,
  strftime(ts, '%Y%m%d') AS dt, count(*) AS n, CAST(sum(k) AS DOUBLE) AS total
FROM e WHERE event_type IN ('view', 'click', 'error') GROUP BY 1, 2""",
)
def stream_fanout(spark, sf_dir):
    """Agent lines parsed once per micro-batch and written to three tables."""
    plugins = {"view": "cpu", "click": "memory", "error": "df", "purchase": "cpu", "signup": "load"}
    kinds = {"view": "user", "click": "used", "error": "free", "purchase": "nice", "signup": "used"}
    lines = sample_lines(
        spark, sf_dir, choose(plugins), choose(kinds), F.col("k").cast("string"), F.lit('"value"')
    )
    source = line_files(spark, lines, "agent-lines")
    out = scratch_dir(spark, "stream-fanout")
    stream = read_stream(spark, "text", {"path": source})
    finished(fan_out(stream, parse_samples, agent_tables, f"{out}/raw", f"{out}/state", "agents", True))
    return metric_days(spark, f"{out}/raw")


def metric_days(spark, root):
    """Rows and totals per metric table and day."""
    result = None
    for name in ("cpu", "mem", "disk"):
        rows = spark.read.parquet(f"{root}/{name}")
        rows = rows.groupBy(F.col("dt").cast("string").alias("dt")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("values").cast("double")).alias("total")
        )
        rows = rows.withColumn("metric_table", F.lit(name))
        result = rows if result is None else result.unionByName(rows)
    return result


METRIC_DAYS = f"""WITH {E}
SELECT CASE event_type WHEN 'view' THEN 'cpu' WHEN 'click' THEN 'mem' ELSE 'disk' END AS metric_table,
  strftime(ts, '%Y%m%d') AS dt, count(*) AS n, CAST(sum(k) AS DOUBLE) AS total
FROM e WHERE event_type IN ('view', 'click', 'error') GROUP BY 1, 2"""


def metric_lines(spark, sf_dir):
    plugins = {"view": "cpu", "click": "memory", "error": "df"}
    kinds = {"view": "user", "click": "used", "error": "free"}
    return sample_lines(spark, sf_dir, choose(plugins), choose(kinds), F.col("k").cast("string"), F.lit('"value"'))


@query("stream_two_topics", METRIC_DAYS)
def stream_two_topics(spark, sf_dir):
    """Two topics of agent lines feed the same tables: no batch of one replaces a batch of the other."""
    lines = metric_lines(spark, sf_dir)
    out = scratch_dir(spark, "stream-two-topics")
    odd = F.pmod(F.xxhash64("value"), F.lit(2))
    for topic in (0, 1):
        source = line_files(spark, lines.filter(odd == topic), f"topic-{topic}")
        stream = read_stream(spark, "text", {"path": source})
        finished(fan_out(stream, parse_samples, agent_tables, f"{out}/raw", f"{out}/state-{topic}", f"topic{topic}", True))
    return metric_days(spark, f"{out}/raw")


@query("stream_replay", METRIC_DAYS)
def stream_replay(spark, sf_dir):
    """All lines again under a new checkpoint replace the first run's rows: none is lost or there twice."""
    source = line_files(spark, metric_lines(spark, sf_dir), "replayed-lines")
    out = scratch_dir(spark, "stream-replay")
    stream = read_stream(spark, "text", {"path": source})
    for run in ("first", "second"):
        finished(fan_out(stream, parse_samples, agent_tables, f"{out}/raw", f"{out}/{run}", "agents", True, "replace"))
    return metric_days(spark, f"{out}/raw")


@query(
    "stream_retention",
    f"""SELECT strftime(ts, '%Y%m%d') AS dt, count(*) AS n, CAST(sum({VALUE}) AS DOUBLE) AS total FROM events
WHERE strftime(ts, '%Y%m%d') > '20240110' OR strftime(ts, '%Y%m%d') = '20240103' GROUP BY 1""",
)
def stream_retention(spark, sf_dir):
    """A streamed table after old days were dropped and one of them was loaded again by a batch job."""
    out = scratch_dir(spark, "stream-retention")
    stream = event_stream(spark, sf_dir).withColumns({"dt": day_part("ts"), "hh": hour_part("ts")})
    finished(ingest(stream, f"{out}/data", f"{out}/state", "events", True))
    drop_old_days(spark, f"{out}/data", datetime(2024, 1, 30), 20)
    save_raw(raw_events(spark, sf_dir).filter("dt = '20240103'"), f"{out}/data", "reload")
    return day_counts(spark.read.parquet(f"{out}/data"))


@query("stream_alert", "SELECT event_id FROM events WHERE event_type = 'error'")
def stream_alert(spark, sf_dir):
    """Alert lines forwarded by a stream."""
    lines = table(spark, sf_dir, "events").select(
        F.to_json(F.struct("event_id", F.col("event_type").alias("response"))).alias("value")
    )
    source = line_files(spark, lines, "alert-lines")
    out = scratch_dir(spark, "stream-alert")
    found = alerts(read_stream(spark, "text", {"path": source}), "response", "error")
    finished(forward(found, "text", {"path": f"{out}/data"}, f"{out}/state", True))
    stored = spark.read.text(f"{out}/data")
    return stored.select(F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"))


# ---- tables -----------------------------------------------------------------


def raw_events(spark, sf_dir):
    """Events with the partition columns of a raw table, one partition per day and hour."""
    return table(spark, sf_dir, "events").withColumns({"dt": day_part("ts"), "hh": hour_part("ts")})


COUNTS = "strftime(ts, '%Y%m%d') AS dt, count(*) AS n, CAST(sum(" + VALUE + ") AS DOUBLE) AS total"


def day_counts(df):
    return df.groupBy(F.col("dt").cast("string").alias("dt")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value_dec()).cast("double").alias("total")
    )


@query(
    "partition_scan",
    """SELECT event_id, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-02 22:30:00' AND ts < TIMESTAMP '2024-01-05 03:10:00'""",
)
def partition_scan(spark, sf_dir):
    """A time range over a partitioned table reads only the hours it touches."""
    out = scratch_dir(spark, "partition-scan")
    save(raw_events(spark, sf_dir), out)
    rows = read_window(spark, out, "ts", datetime(2024, 1, 2, 22, 30), datetime(2024, 1, 5, 3, 10))
    return rows.select("event_id", "event_type")


@query(
    "retention",
    f"""SELECT {COUNTS} FROM events
WHERE strftime(ts, '%Y%m%d') > '20240110' GROUP BY 1""",
)
def retention_query(spark, sf_dir):
    """Day partitions up to a limit are dropped as folders, the rest stays."""
    out = scratch_dir(spark, "retention")
    save(raw_events(spark, sf_dir), out, ["dt"])
    drop_old_days(spark, out, datetime(2024, 1, 30), 20)
    return day_counts(spark.read.parquet(out))


@query(
    "range_delete",
    """SELECT strftime(ts, '%Y%m%d%H') AS stat_key, count(*) AS pv FROM events
WHERE strftime(ts, '%Y%m%d%H') NOT BETWEEN '2024010520' AND '2024010703' GROUP BY 1""",
)
def range_delete(spark, sf_dir):
    """Hour keys of a range are deleted from a roll-up table."""
    out = scratch_dir(spark, "range-delete")
    hourly = table(spark, sf_dir, "events").groupBy(HOUR.bucket("ts").alias("bucket")).agg(
        F.count(F.lit(1)).alias("pv")
    )
    keyed = hourly.withColumn("stat_key", HOUR.key("bucket"))
    save(layout(keyed, HOUR), out, ["dt", "hh"])
    delete_range(spark, out, "hour", "2024010520", "2024010703")
    return spark.read.parquet(out).select("stat_key", "pv")


@query(
    "backfill_idempotent",
    """SELECT strftime(ts, '%Y%m%d') AS stat_key, event_type, count(*) AS pv, count(DISTINCT user_id) AS uv
FROM events GROUP BY ALL""",
)
def backfill_idempotent(spark, sf_dir):
    """Writing all days and then some of them again leaves every day once."""
    out = scratch_dir(spark, "backfill")
    visits = client_visits(table(spark, sf_dir, "events"), "ts", DAY, "user_id", ["event_type"])
    daily = visits.groupBy("bucket", "event_type").agg(
        F.sum("views").alias("pv"), F.count(F.lit(1)).alias("uv")
    )
    stats = layout(daily.withColumn("stat_key", DAY.key("bucket")), DAY)
    save(stats, out, ["dt"])
    save(stats.filter((F.col("dt") >= "20240110") & (F.col("dt") < "20240113")), out, ["dt"])
    return spark.read.parquet(out).select("stat_key", "event_type", "pv", "uv")


@query(
    "export_csv",
    "SELECT event_id, user_id, event_type, value, strftime(ts, '%Y%m%d') AS dt, strftime(ts, '%H') AS hh FROM events",
)
def export_csv_query(spark, sf_dir):
    """Backup with a header, per day and hour, read back."""
    out = scratch_dir(spark, "export")
    rows = raw_events(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "dt", "hh")
    export_csv(rows, out)
    return spark.read.schema(rows.schema).csv(out, sep="|", header=True)


@query(
    "snapshot_file",
    """SELECT n_nationkey AS site_id, r_name AS app_id FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def snapshot_file(spark, sf_dir):
    """A dimension snapshot as one delimited file, read back with its schema."""
    out = scratch_dir(spark, "snapshot")
    dim = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_nationkey").alias("site_id"), F.col("r_name").alias("app_id"))
    )
    save_snapshot(dim, out)
    return spark.read.csv(out, sep="|", schema="site_id INT, app_id STRING")


@query(
    "snapshot_merge",
    """SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type,
  strftime(max(ts), '%Y%m%d%H%M%S') AS at FROM events GROUP BY user_id""",
)
def snapshot_merge(spark, sf_dir):
    """Upsert by id: two snapshots merge to the newest row of each id."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    first = index_rows(events.filter("event_type IN ('view', 'click')"), ["user_id"], "ts").drop("id")
    second = index_rows(events.filter("event_type NOT IN ('view', 'click')"), ["user_id"], "ts").drop("id")
    merged = merge_snapshot(first, second, ["user_id"], "ts")
    return merged.select("user_id", "event_type", F.date_format("ts", "yyyyMMddHHmmss").alias("at"))


@query(
    "index_rows",
    """SELECT app_id || '_' || site_id AS id, app_id, site_id, latest FROM (
  SELECT r_name AS app_id, n_name AS site_id, max(ts) AS m, strftime(max(ts), '%Y%m%d%H%M%S') AS latest
  FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2)""",
)
def index_rows_query(spark, sf_dir):
    """What goes to a search index: no partition columns, one row per composite id."""
    per_user = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("ts"))
    rows = per_user.join(places(spark, sf_dir), "user_id").select("app_id", "site_id", "ts", day_part("ts"))
    out = index_rows(rows, ["app_id", "site_id"], newest_by="ts")
    return out.select("id", "app_id", "site_id", F.date_format("ts", "yyyyMMddHHmmss").alias("latest"))


def plain_lines(lines):
    """The message of an envelope, as the log file itself has it."""
    return lines.select(F.get_json_object("value", "$.message").alias("value"))


@query(
    "import_router_log",
    f"""WITH {E}
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS log_time, mac AS client_mac,
  '192.0.2.' || k || '[5000]' AS client_ip, CASE WHEN q THEN 'Request' ELSE 'Response' END AS mode, 'Route' AS kind,
  CASE WHEN q THEN '' ELSE '198.51.100.' || k END AS server_ip, CASE WHEN q THEN 'A' || (k % 5) ELSE '' END AS app_id,
  CASE WHEN q THEN 'S' || (k % 25) ELSE '' END AS site_id
FROM (SELECT *, event_type = 'view' AS q FROM e WHERE k < 90)""",
)
def import_router_log_query(spark, sf_dir):
    """Plain router log files (their names, which give the router id, are Spark's own here)."""
    path = line_files(spark, plain_lines(route_lines(spark, sf_dir)), "router-files")
    rows = import_router_log(spark, path)
    return rows.withColumn("log_time", F.date_format("log_time", "yyyy-MM-dd HH:mm:ss.SSS")).drop("arguments", "router_id")


@query(
    "import_session_log",
    f"""WITH e AS (SELECT *, {K} AS k FROM events)
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS log_time, CAST(event_id AS VARCHAR) AS session_id,
  'info' AS log_type, '198.51.100.' || k AS server_ip, 'm' || (k % 3) AS menu_path, CASE WHEN event_id % 2 = 0 THEN 'ON' ELSE 'OFF' END AS motion,
  CAST(k AS VARCHAR) AS motion_value, CAST(user_id AS VARCHAR) AS client_id, CAST(k % 25 AS VARCHAR) AS site_id,
  CASE WHEN event_id % 2 = 1 THEN strftime(ts + INTERVAL 90 SECOND, '%Y-%m-%d %H:%M:%S') END AS off_at
FROM e""",
)
def import_session_log_query(spark, sf_dir):
    """Session log files: closed sessions carry their end as a tenth value."""
    second, closed = "yyyy-MM-dd HH:mm:ss", F.col("event_id") % 2 == 1
    line = F.format_string(
        "[%s] at=x,session=%d,kind=info,server=198.51.100.%d,menu=m%d,motion=%s,amount=%d,client={%d},site=%d%s",
        F.date_format("ts", second), "event_id", "k", F.col("k") % 3, F.when(closed, F.lit("OFF")).otherwise(F.lit("ON")),
        "k", "user_id", F.col("k") % 25,
        F.when(closed, F.concat(F.lit(",end="), F.date_format(F.col("ts") + F.expr("interval 90 seconds"), second))).otherwise(F.lit("")),
    )
    events = table(spark, sf_dir, "events").withColumn("k", prop_k())
    path = line_files(spark, events.select(line.alias("value")), "session-files")
    rows = import_session_log(spark, path).drop("router_id")
    return rows.withColumns({c: F.date_format(c, second) for c in ("log_time", "off_at")})


@query(
    "import_rejects",
    f"""WITH e AS (SELECT *, {K} AS k FROM events)
SELECT 'router' AS log, 'arguments' AS reject, printf('%06d', event_id) AS line FROM e WHERE k >= 90
UNION ALL SELECT 'router', 'line', 'restarted ' || event_id FROM e WHERE k % 10 = 3
UNION ALL SELECT 'session', CASE k % 4 WHEN 0 THEN 'line' WHEN 1 THEN 'arguments' ELSE 'time' END,
  CASE k % 4 WHEN 0 THEN 'restarted ' || event_id
    WHEN 1 THEN strftime(ts, '[%Y-%m-%d %H:%M:%S]') || ' at=' || event_id
    ELSE '[2024-13-01 00:00:00] ' || repeat('v=1,', 8) || 'v=' || event_id END
FROM e WHERE k % 4 < 3""",
)
def import_rejects(spark, sf_dir):
    """Lines that an import refuses, each once, with the reason (of a router's line its session number)."""
    events = table(spark, sf_dir, "events").withColumn("k", prop_k())
    k, noise = F.col("k"), F.format_string("restarted %d", "event_id")
    router = plain_lines(route_lines(spark, sf_dir)).unionAll(events.filter(k % 10 == 3).select(noise))
    kinds = [
        noise,
        F.format_string("%s at=%d", F.date_format("ts", "'['yyyy-MM-dd HH:mm:ss']'"), "event_id"),
        F.format_string("[2024-13-01 00:00:00] " + "v=1," * 8 + "v=%d", "event_id"),
        F.format_string("[%s] " + "v=1," * 8 + "v=%d", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "event_id"),
    ]
    session = events.select(F.element_at(F.array(*kinds), k % 4 + 1).alias("value"))
    refused = [
        ("router", refused_router_log(spark, line_files(spark, router, "router-refused"))),
        ("session", refused_session_log(spark, line_files(spark, session, "session-refused"))),
    ]
    number = F.regexp_extract("value", r"\[(\d+)_", 1)
    line = F.when(number != "", number).otherwise(F.col("value")).alias("line")
    parts = [rows.select(F.lit(log).alias("log"), "reject", line) for log, rows in refused]
    return parts[0].unionAll(parts[1])
