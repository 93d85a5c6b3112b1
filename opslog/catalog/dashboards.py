"""Dashboard snapshots and dimension builds on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from opslog.catalog.base import PLACES, buckets, places, query, servers, table
from opslog.catalog.concurrent import CAP, CAPPED, ccu_levels, capped_sessions, fill, leveled_iv, sweep
from opslog.catalog.gauges import BANDWIDTH, MBPS, bandwidth_stats
from opslog.catalog.uniques import UNIQUE, event_levels
from opslog.functions.measures import mbps
from opslog.operators.concurrency import concurrency
from opslog.operators.dims import (
    calendar, port_dimension, router_dimension, server_dimension, span,
)
from opslog.operators.gauge import finish_gauge, gauge_parts
from opslog.operators.rollup import rollup_entity
from opslog.operators.sequence import newest, oldest
from opslog.operators.snapshot import at_latest_bucket, combine, flagged, latest_per_key
from opslog.operators.uniques import client_visits, unique_total
from opslog.spec import APP, DAY, HOUR, MONTH, SITE, total

KEYS = ["app_id", "site_id"]
SNAP = ["ccu", "uv", "pv", "traffic"]


def site_metrics(spark, sf_dir):
    """Hourly concurrency, views and bandwidth of every site."""
    events = table(spark, sf_dir, "events")
    placed = capped_sessions(spark, sf_dir).join(places(spark, sf_dir), "user_id")
    ccu = fill(ccu_levels(placed, "user_id", HOUR, [SITE]), servers(spark, sf_dir), events, HOUR, [SITE])
    views = event_levels(spark, sf_dir, HOUR).filter("level = 'site'")
    speed = bandwidth_stats(spark, sf_dir).filter("level = 'site'")
    return (
        ccu.select("bucket", *KEYS, F.col("max_ccu").cast("bigint").alias("ccu")),
        views.select("bucket", *KEYS, "uv", "pv"),
        speed.select("bucket", *KEYS, F.col("max_mbps").cast("bigint").alias("traffic")),
    )


@query(
    "dashboard_union",
    f"""WITH {PLACES}, {buckets('hour')}, {CAPPED.format(cap=CAP)},
{sweep(3600, leveled_iv('sess', 'user_id'))}, {BANDWIDTH},
fv AS (SELECT date_trunc('hour', ts) AS bucket, user_id, app_id, site_id, server_id
      FROM events JOIN places USING (user_id)),
v AS (SELECT bucket, app_id, site_id, {UNIQUE} FROM fv GROUP BY ALL),
lst AS (SELECT max(bucket) AS bucket FROM cal),
u AS (SELECT app_id, site_id, max_ccu AS ccu, 0 AS uv, 0 AS pv, 0 AS traffic
      FROM ccu JOIN lst USING (bucket) WHERE level = 'site'
      UNION ALL SELECT app_id, site_id, 0, uv, pv, 0 FROM v JOIN lst USING (bucket)
      UNION ALL SELECT app_id, site_id, 0, 0, 0, CAST(floor(max_mbps) AS BIGINT)
      FROM bw JOIN lst USING (bucket) WHERE level = 'site'),
snap AS (SELECT app_id, site_id, sum(ccu) AS ccu, sum(uv) AS uv, sum(pv) AS pv, sum(traffic) AS traffic
      FROM u GROUP BY ALL)
SELECT 'site' AS level, app_id, site_id, CAST(ccu AS BIGINT) AS ccu, CAST(uv AS BIGINT) AS uv,
  CAST(pv AS BIGINT) AS pv, CAST(traffic AS BIGINT) AS traffic FROM snap
UNION ALL SELECT 'app', app_id, '*', CAST(sum(ccu) AS BIGINT), CAST(sum(uv) AS BIGINT),
  CAST(sum(pv) AS BIGINT), CAST(sum(traffic) AS BIGINT) FROM snap GROUP BY app_id""",
)
def dashboard_union(spark, sf_dir):
    """The latest hour of three metrics side by side, per site and per app."""
    latest = [at_latest_bucket(m).drop("bucket") for m in site_metrics(spark, sf_dir)]
    snapshot = combine(latest, KEYS)
    return rollup_entity(snapshot, [SITE, APP], [total(c) for c in SNAP], keep=[])


@query(
    "dashboard_latest_rows",
    f"""WITH {PLACES},
f AS (SELECT date_trunc('hour', ts) AS bucket, event_type, user_id, value, app_id, site_id
      FROM events JOIN places USING (user_id)),
v AS (SELECT bucket, app_id, site_id, count(DISTINCT user_id) AS uv, count(*) AS pv FROM f GROUP BY ALL),
t AS (SELECT bucket, app_id, site_id, CAST(floor(max({MBPS})) AS BIGINT) AS traffic
      FROM f WHERE event_type = 'view' GROUP BY ALL),
u AS (SELECT app_id, site_id, arg_max(uv, bucket) AS uv, arg_max(pv, bucket) AS pv, 0 AS traffic
      FROM v GROUP BY ALL
      UNION ALL SELECT app_id, site_id, 0, 0, arg_max(traffic, bucket) FROM t GROUP BY ALL)
SELECT app_id, site_id, CAST(sum(uv) AS BIGINT) AS uv, CAST(sum(pv) AS BIGINT) AS pv,
       CAST(sum(traffic) AS BIGINT) AS traffic FROM u GROUP BY ALL""",
)
def dashboard_latest_rows(spark, sf_dir):
    """Each site's own newest row of each metric, whatever hour it is from."""
    events, where = table(spark, sf_dir, "events"), places(spark, sf_dir)
    visits = client_visits(events, "ts", HOUR, "user_id").join(where, "user_id")
    views = unique_total(visits, [SITE], "user_id")
    parts = gauge_parts(
        events.filter("event_type = 'view'"),
        [HOUR.bucket("ts").alias("bucket"), "user_id"],
        {"mbps": mbps(F.col("value") * 1000000)},
    ).join(where, "user_id")
    speed = finish_gauge(parts, ["bucket", *KEYS], ["mbps"]).withColumn(
        "traffic", F.col("max_mbps").cast("bigint")
    )
    return combine(
        [latest_per_key(views, KEYS, ["uv", "pv"]), latest_per_key(speed, KEYS, ["traffic"])], KEYS
    )


@query(
    "dashboard_now",
    f"""WITH {PLACES}, {CAPPED.format(cap=CAP)},
w AS (SELECT CAST(floor(epoch(date_trunc('hour', max(ts)))) AS BIGINT) AS b FROM events),
near AS (SELECT sess.* FROM sess, w WHERE s >= b - 300 AND s < b + 3600 AND e >= b),
{sweep(3600, leveled_iv('near', 'user_id'))},
c AS (SELECT app_id, site_id, avg_ccu, min_ccu, max_ccu FROM ccu, w
      WHERE level = 'site' AND bucket = make_timestamp(b * 1000000))
SELECT d.app_id, d.site_id, coalesce(avg_ccu, 0) AS avg_ccu, coalesce(min_ccu, 0) AS min_ccu,
       coalesce(max_ccu, 0) AS max_ccu
FROM (SELECT DISTINCT app_id, site_id FROM dim) d LEFT JOIN c USING (app_id, site_id)""",
)
def dashboard_now(spark, sf_dir):
    """Concurrency of the last window with a short look-back, over the plain dimension."""
    events = table(spark, sf_dir, "events")
    begin, end = span_of_last_hour(events)
    sessions = capped_sessions(spark, sf_dir).filter(
        (F.col("on_at").cast("timestamp") >= F.date_trunc("second", begin) - F.expr("interval 300 seconds"))
        & (F.col("on_at").cast("timestamp") < end)
        & (F.date_trunc("second", "off_at") >= begin)
    )
    placed = sessions.join(places(spark, sf_dir), "user_id")
    stats = concurrency(placed, KEYS, ["user_id"], "on_at", "off_at", HOUR)
    now = stats.filter(F.col("bucket") == begin).drop("bucket")
    sites = servers(spark, sf_dir).select(*KEYS).distinct()
    zero = {"avg_ccu": F.lit(0.0), "min_ccu": F.lit(0), "max_ccu": F.lit(0)}
    out = sites.join(now, KEYS, "left")
    return out.withColumns({c: F.coalesce(F.col(c), z) for c, z in zero.items()})


def span_of_last_hour(events):
    """Begin and end of the newest hour, as scalar sub-queries."""
    last = events.select(F.max(HOUR.bucket("ts")).alias("b"))
    return last.scalar(), last.select((F.col("b") + HOUR.step).alias("e")).scalar()


@query(
    "slices_flag",
    """WITH w AS (SELECT date_trunc('day', min(ts)) + INTERVAL 10 DAY AS b,
                  date_trunc('day', min(ts)) + INTERVAL 20 DAY AS e FROM events),
pre AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, max(ts) AS ts
        FROM events, w WHERE ts < b GROUP BY user_id),
pos AS (SELECT user_id, arg_min(event_type, (ts, event_id)) AS event_type, min(ts) AS ts
        FROM events, w WHERE ts >= e GROUP BY user_id)
SELECT user_id, strftime(ts, '%Y%m%d%H%M%S') AS at, event_type, 'pre' AS flag FROM pre WHERE event_type = 'signup'
UNION ALL SELECT user_id, strftime(ts, '%Y%m%d%H%M%S'), event_type, 'cur' FROM events, w WHERE ts >= b AND ts < e
UNION ALL SELECT user_id, strftime(ts, '%Y%m%d%H%M%S'), event_type, 'pos' FROM pos WHERE event_type = 'error'""",
)
def slices_flag(spark, sf_dir):
    """State before, events inside, state after a window, told apart by a flag."""
    events = table(spark, sf_dir, "events").select("ts", "event_id", "user_id", "event_type")
    first = events.select(F.min(DAY.bucket("ts")).alias("b"))
    begin = first.select((F.col("b") + F.expr("interval 10 days")).alias("b")).scalar()
    end = first.select((F.col("b") + F.expr("interval 20 days")).alias("e")).scalar()
    ts = F.col("ts").cast("timestamp")
    cols, order = ["event_type", "ts"], ["ts", "event_id"]
    parts = {
        "pre": newest(events.filter(ts < begin), ["user_id"], order, cols).filter("event_type = 'signup'"),
        "cur": events.filter((ts >= begin) & (ts < end)).select("user_id", *cols),
        "pos": oldest(events.filter(ts >= end), ["user_id"], order, cols).filter("event_type = 'error'"),
    }
    out = flagged(parts)
    return out.select("user_id", F.date_format("ts", "yyyyMMddHHmmss").alias("at"), "event_type", "flag")


# ---- dimensions -------------------------------------------------------------


@query(
    "dim_lookup",
    f"WITH {PLACES} SELECT app_id, site_id, server_id FROM dim",
)
def dim_lookup(spark, sf_dir):
    return servers(spark, sf_dir)


@query(
    "dim_server_build",
    """WITH hosts AS (SELECT s_suppkey, s_name, s_nationkey, s_acctbal >= 1000 AS in_use,
    s_nationkey AS app_key, CASE WHEN s_acctbal >= 5000 THEN 'CSS' ELSE 'WEB' END AS role FROM supplier),
addr AS (SELECT DISTINCT l_suppkey, 'net-' || l_returnflag AS server_ip FROM lineitem)
SELECT coalesce(CAST(a.r_name AS VARCHAR), '999') AS app_id, s.r_name AS site_id,
  CAST(s_suppkey AS VARCHAR) AS host_id, s_name AS host_name, server_ip, role
FROM hosts JOIN nation ON s_nationkey = n_nationkey JOIN region s ON n_regionkey = s.r_regionkey
LEFT JOIN region a ON app_key = a.r_regionkey JOIN addr ON l_suppkey = s_suppkey WHERE in_use""",
)
def dim_server_build(spark, sf_dir):
    """Suppliers as hosts, nations as groups, regions as sites and apps."""
    region = table(spark, sf_dir, "region")
    hosts = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("host_id"),
        F.col("s_name").alias("host_name"),
        F.col("s_nationkey").alias("group_id"),
        F.col("s_nationkey").alias("app_key"),
        F.when(F.col("s_acctbal") >= 5000, F.lit("CSS")).otherwise(F.lit("WEB")).alias("role"),
        (F.col("s_acctbal") >= 1000).alias("in_use"),
    )
    addresses = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("host_id"),
        F.concat(F.lit("net-"), "l_returnflag").alias("server_ip"),
    )
    return server_dimension(
        hosts,
        nation_groups(spark, sf_dir),
        region.select(F.col("r_regionkey").alias("site_key"), F.col("r_name").alias("site_id")),
        region.select(F.col("r_regionkey").alias("app_key"), F.col("r_name").alias("app_id")),
        addresses,
    )


def nation_groups(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("group_id"), F.col("n_regionkey").alias("site_key")
    )


def region_sites(spark, sf_dir):
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("site_key"), F.col("r_name").alias("site_id")
    )


@query(
    "dim_port_build",
    """SELECT r_name AS site_id, CAST(s_suppkey AS VARCHAR) AS switch_id, s_name AS switch_name,
  CAST(p_partkey AS VARCHAR) AS port_id, CASE WHEN p_retailprice >= 1000 THEN 'U' ELSE 'D' END AS port_type
FROM part JOIN supplier ON p_size = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
)
def dim_port_build(spark, sf_dir):
    """Parts as ports of supplier switches."""
    ports = table(spark, sf_dir, "part").select(
        F.col("p_size").cast("bigint").alias("switch_id"),
        F.col("p_partkey").alias("port_id"),
        F.when(F.col("p_retailprice") >= 1000, F.lit("U")).otherwise(F.lit("D")).alias("port_type"),
    )
    switches = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("switch_id"),
        F.col("s_name").alias("switch_name"),
        F.col("s_nationkey").alias("group_id"),
    )
    return port_dimension(ports, switches, nation_groups(spark, sf_dir), region_sites(spark, sf_dir))


@query(
    "dim_router_build",
    """SELECT DISTINCT r_name AS site_id, upper(c_name) AS router_host, o_orderstatus AS router_port,
  o_orderpriority AS router_id
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE o_orderstatus <> 'P'""",
)
def dim_router_build(spark, sf_dir):
    """Orders as router registrations on customer hosts."""
    routers = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("router_id"),
        F.col("o_custkey").alias("host_id"),
        F.col("o_orderstatus").alias("router_port"),
        (F.col("o_orderstatus") != "P").alias("in_use"),
    )
    hosts = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("host_id"),
        F.col("c_name").alias("host_name"),
        F.col("c_nationkey").alias("group_id"),
    )
    return router_dimension(routers, hosts, nation_groups(spark, sf_dir), region_sites(spark, sf_dir))


@query(
    "calendar_server",
    f"""WITH {PLACES}, {buckets('hour')}
SELECT strftime(bucket, '%Y%m%d%H') AS stat_key, dim.* FROM cal CROSS JOIN dim""",
)
def calendar_server(spark, sf_dir):
    out = calendar(servers(spark, sf_dir), *span(table(spark, sf_dir, "events"), "ts", HOUR), HOUR)
    return out.select(HOUR.key("bucket").alias("stat_key"), "app_id", "site_id", "server_id")


@query(
    "calendar_role",
    f"""WITH {buckets('month', 'orders', 'o_orderdate')}
SELECT strftime(bucket, '%Y%m') AS stat_key, s_suppkey, 'CSS' AS role
FROM cal CROSS JOIN supplier WHERE s_acctbal >= 5000""",
)
def calendar_role(spark, sf_dir):
    """Months of the orders times the suppliers of one role."""
    role = F.when(F.col("s_acctbal") >= 5000, F.lit("CSS")).otherwise(F.lit("WEB"))
    hosts = table(spark, sf_dir, "supplier").select("s_suppkey", role.alias("role"))
    window = span(table(spark, sf_dir, "orders"), "o_orderdate", MONTH)
    out = calendar(hosts, *window, MONTH, role="CSS")
    return out.select(MONTH.key("bucket").alias("stat_key"), "s_suppkey", "role")
