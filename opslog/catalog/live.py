"""Stateful statistics of streams on the given tables, each against SQL over the buckets that are closed."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from opslog.catalog.base import PLACES, places, query, servers, table
from opslog.catalog.ingests import E, SESSION_SQL, session_lines
from opslog.catalog.jobs import CLOSED, event_stream, finished, line_files
from opslog.catalog.pairs import RATES, ROUTE, as_route_log
from opslog.ingest.envelope import accepted
from opslog.ingest.sessions import parse_session
from opslog.operators.pairing import PAIR_ZEROS
from opslog.plans.compaction import compact, sweep
from opslog.session import scratch_dir
from opslog.sources.logs import read_stream
from opslog.sources.tables import read_window
from opslog.spec import DAY, ENTITY_LEVELS, HOUR
from opslog.streaming.aggregates import windowed
from opslog.streaming.ingest import append, ingest
from opslog.streaming.progress import ProgressTable, recorded
from opslog.streaming.stateful import fill_closed, filled, pair_rate_stream, pair_stream, rate_stream, unique_stream

HORIZON = 6 * 3600  # these events are hours apart


def stored(spark, stats, label):
    """A stream's final rows, read back from where the file sink put them."""
    out = scratch_dir(spark, label)
    finished(append(stats, f"{out}/data", f"{out}/state", True, partition_by=()))
    return spark.read.schema(stats.schema).parquet(f"{out}/data")


@query(
    "stream_pairing",
    f"""WITH {ROUTE}, {CLOSED},
answered AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS half_day, success, answer_ip AS site_id
  FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS answer_ts,
          lead(server_ip) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ip,
          CAST(lead(result) OVER (PARTITION BY user_id ORDER BY ts, event_id) = '0' AS INTEGER) AS success,
          lead(server_ip) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS answer_ip FROM log)
  WHERE event_type = 'view' AND ip <> '' AND answer_ts <= ts + INTERVAL 6 HOUR)
SELECT strftime(half_day, '%Y%m%d%H') AS stat_key, site_id, {RATES}
FROM answered, closed WHERE half_day + INTERVAL 12 HOUR <= mark GROUP BY 1, 2""",
)
def stream_pairing(spark, sf_dir):
    """Requests and the next row of their user within six hours, from a stream, for the buckets that are settled."""
    log = as_route_log(event_stream(spark, sf_dir))
    pairs = pair_stream(log, ["user_id"], ["ts", "event_id"], HORIZON, "1 hour")
    rates = pair_rate_stream(pairs.withColumnRenamed("server_ip", "site_id"), ["site_id"], HORIZON)
    out = stored(spark, rates, "stream-pairing")
    return out.select(HOUR.key("bucket").alias("stat_key"), "site_id", *PAIR_ZEROS)


@query(
    "stream_uv",
    f"""WITH {PLACES}, {CLOSED},
f AS (SELECT date_trunc('hour', ts) AS bucket, user_id, app_id, site_id, server_id
      FROM events JOIN places USING (user_id), closed WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark)
SELECT 'server' AS level, strftime(bucket, '%Y%m%d%H') AS stat_key, app_id, site_id, server_id, count(DISTINCT user_id) AS uv, count(*) AS pv
FROM f GROUP BY bucket, app_id, site_id, server_id
UNION ALL SELECT 'site', strftime(bucket, '%Y%m%d%H'), app_id, site_id, '*', count(DISTINCT user_id), count(*) FROM f GROUP BY bucket, app_id, site_id
UNION ALL SELECT 'app', strftime(bucket, '%Y%m%d%H'), app_id, '*', '*', count(DISTINCT user_id), count(*) FROM f GROUP BY bucket, app_id""",
)
def stream_uv(spark, sf_dir):
    """Unique and total views per closed hour at three levels, from a stream."""
    placed = event_stream(spark, sf_dir).select("ts", "user_id").join(places(spark, sf_dir), "user_id")
    out = stored(spark, unique_stream(placed, "ts", "1 hour", "1 hour", ENTITY_LEVELS, "user_id"), "stream-uv")
    return out.select("level", HOUR.key("bucket").alias("stat_key"), "app_id", "site_id", "server_id", "uv", "pv")


@query(
    "stream_tps",
    f"""WITH {CLOSED}, slots AS (SELECT date_trunc('hour', ts) AS slot, event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT strftime(date_trunc('day', slot), '%Y%m%d') AS stat_key, event_type, CAST(sum(n) AS DOUBLE) / 24 AS avg_tps,
  CASE WHEN count(*) = 24 THEN min(n) ELSE 0 END AS min_tps, max(n) AS max_tps
FROM slots, closed WHERE date_trunc('day', slot) + INTERVAL 1 DAY <= mark GROUP BY 1, 2""",
)
def stream_tps(spark, sf_dir):
    """Rows per hour and type, averaged over the closed days: two aggregations in a row on a stream."""
    events = event_stream(spark, sf_dir).select("ts", "event_type")
    out = stored(spark, rate_stream(events, "ts", "1 hour", ["event_type"], HOUR, DAY), "stream-tps")
    return out.select(DAY.key("bucket").alias("stat_key"), *out.columns[1:])


@query(
    "stream_zero_fill",
    f"""WITH {PLACES}, {CLOSED},
f AS (SELECT date_trunc('hour', ts) AS bucket, site_id, count(*) AS pv
      FROM events JOIN places USING (user_id), closed WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark GROUP BY 1, 2),
cal AS (SELECT unnest(generate_series(min(bucket), max(bucket), INTERVAL 1 HOUR)) AS bucket FROM f)
SELECT strftime(cal.bucket, '%Y%m%d%H') AS stat_key, d.site_id, coalesce(pv, 0) AS pv
FROM cal CROSS JOIN (SELECT DISTINCT site_id FROM dim) d LEFT JOIN f USING (bucket, site_id)""",
)
def stream_zero_fill(spark, sf_dir):
    """Views of every site in every closed hour from a stream, zeros where there were none."""
    placed = event_stream(spark, sf_dir).select("ts", "user_id").join(places(spark, sf_dir), "user_id")
    counts = windowed(placed, "ts", "1 hour", "1 hour", ["site_id"], [F.count(F.lit(1)).alias("pv")])
    sites = servers(spark, sf_dir).select("site_id").distinct()
    out = scratch_dir(spark, "stream-zero-fill")
    finished(fill_closed(counts, sites, ["site_id"], {"pv": 0}, HOUR, f"{out}/data", f"{out}/state", "views", True))
    return filled(spark, f"{out}/data").select(HOUR.key("bucket").alias("stat_key"), "site_id", "pv")


def session_stream(spark, sf_dir, label, files=4):
    """Session lines in some files, one of which is a micro-batch."""
    lines = session_lines(spark, sf_dir).select("value")
    source = line_files(spark, lines.repartition(files, F.xxhash64("value")), label)
    return accepted(parse_session(read_stream(spark, "text", {"path": source, "maxFilesPerTrigger": "1"})))


@query("stream_compaction", f"WITH {E} {SESSION_SQL}")
def stream_compaction(spark, sf_dir):
    """A streamed table after its closed hours were put together and the folders of the micro-batches removed."""
    rows = session_stream(spark, sf_dir, "compacted-lines", 2)
    out = scratch_dir(spark, "stream-compaction")
    finished(ingest(rows, f"{out}/data", f"{out}/state", "sessions", True))
    first, last = _days(spark, sf_dir)
    compact(spark, f"{out}/data", "sessions", first, last)
    sweep(spark, f"{out}/data", first, last, grace=0)
    stored = read_window(spark, f"{out}/data", "registered_at", first, last)
    second = "yyyy-MM-dd HH:mm:ss"
    return stored.drop("batch").withColumns({c: F.date_format(c, second) for c in ("registered_at", "off_at")})


def _days(spark, sf_dir) -> tuple[datetime, datetime]:
    """The whole days that the events span, and one more for sessions that were registered earlier or later."""
    low, high = table(spark, sf_dir, "events").agg(F.date_format(F.min("ts"), "yyyyMMdd"), F.date_format(F.max("ts"), "yyyyMMdd")).first()
    day = timedelta(days=1)
    return datetime.strptime(low, "%Y%m%d") - day, datetime.strptime(high, "%Y%m%d") + 2 * day


@query("stream_progress", "SELECT count(*) AS n_rows, true AS each_batch_once, true AS all_timed FROM events")
def stream_progress(spark, sf_dir):
    """What a listener recorded of a stream of several micro-batches."""
    rows = session_stream(spark, sf_dir, "counted-lines")
    out = scratch_dir(spark, "stream-progress")
    with ProgressTable(spark, f"{out}/progress") as progress:
        progress.wait(append(rows, f"{out}/data", f"{out}/state", True, partition_by=()))
    return recorded(spark, f"{out}/progress").agg(
        F.sum("n_rows").alias("n_rows"),
        (F.count("batch") == F.count_distinct("batch")).alias("each_batch_once"),
        F.bool_and(F.col("batch_millis") >= F.col("write_millis")).alias("all_timed"),
    )
