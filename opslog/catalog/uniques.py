"""Unique and total views on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from opslog.catalog.base import PLACES, buckets, leveled, places, query, servers, table
from opslog.operators.dims import attach_dim, calendar, level_frame, lookup_side, span, zero_fill
from opslog.operators.rollup import rollup_time
from opslog.operators.uniques import client_visits, estimated, unique_sketch, unique_total
from opslog.spec import DAY, ENTITY_LEVELS, HOUR, MINUTE, MONTH, SERVER, sketch, total

IDS = ["app_id", "site_id", "server_id"]
UNIQUE = "count(DISTINCT user_id) AS uv, count(*) AS pv"


def event_levels(spark, sf_dir, grain):
    """uv/pv of all levels, zero-filled; bucket still a timestamp."""
    events = table(spark, sf_dir, "events")
    visits = client_visits(events, "ts", grain, "user_id")
    stats = unique_total(visits.join(places(spark, sf_dir), "user_id"), ENTITY_LEVELS, "user_id")
    frame = calendar(
        level_frame(servers(spark, sf_dir), ENTITY_LEVELS), *span(events, "ts", grain), grain
    )
    return zero_fill(stats, frame, ["bucket", "level", *IDS], {"uv": 0, "pv": 0})


def level_sql(unit, fmt):
    return f"""WITH {PLACES}, {buckets(unit)},
f AS (SELECT date_trunc('{unit}', ts) AS bucket, user_id, app_id, site_id, server_id
      FROM events JOIN places USING (user_id)),
s AS {leveled(UNIQUE, 'f')}
SELECT ent.level, strftime(cal.bucket, '{fmt}') AS stat_key, ent.app_id, ent.site_id,
       ent.server_id, coalesce(uv, 0) AS uv, coalesce(pv, 0) AS pv
FROM cal CROSS JOIN ent LEFT JOIN s ON s.level = ent.level AND s.bucket = cal.bucket
 AND s.app_id = ent.app_id AND s.site_id = ent.site_id AND s.server_id = ent.server_id"""


def keyed(df, grain):
    return df.select(grain.key("bucket").alias("stat_key"), "*").drop("bucket")


@query("uvpv_hour_levels", level_sql("hour", "%Y%m%d%H"))
def uvpv_hour_levels(spark, sf_dir):
    return keyed(event_levels(spark, sf_dir, HOUR), HOUR)


@query("uvpv_day_exact", level_sql("day", "%Y%m%d"))
def uvpv_day_exact(spark, sf_dir):
    return keyed(event_levels(spark, sf_dir, DAY), DAY)


@query(
    "uvpv_minute",
    f"""WITH {PLACES}
SELECT strftime(ts, '%Y%m%d%H%M') AS stat_key, app_id, site_id, server_id, {UNIQUE},
       strftime(ts, '%Y%m%d') AS dt, strftime(ts, '%H') AS hh
FROM events JOIN places USING (user_id) GROUP BY ALL""",
)
def uvpv_minute(spark, sf_dir):
    """Minute grain, not zero-filled, with the partition columns of the table."""
    visits = client_visits(table(spark, sf_dir, "events"), "ts", MINUTE, "user_id")
    stats = unique_total(visits.join(places(spark, sf_dir), "user_id"), [SERVER], "user_id")
    return stats.select(
        MINUTE.key("bucket").alias("stat_key"),
        *IDS,
        "uv",
        "pv",
        F.date_format("bucket", "yyyyMMdd").alias("dt"),
        F.date_format("bucket", "HH").alias("hh"),
    )


KEYS = ["level", *IDS]


@query(
    "uvpv_sketch",
    f"""WITH {PLACES},
f AS (SELECT date_trunc('month', ts) AS bucket, user_id, app_id, site_id, server_id FROM events JOIN places USING (user_id))
SELECT level, strftime(bucket, '%Y%m') AS stat_key, app_id, site_id, server_id, uv, pv, true AS within_bound
FROM {leveled(UNIQUE, 'f')}""",
)
def uvpv_sketch(spark, sf_dir):
    """Minute sketches merged to hours, days and months without the raw rows, beside the exact month.

    The estimate must be within three percent (one client, where there are few) of the exact count.
    """
    events, where = table(spark, sf_dir, "events"), places(spark, sf_dir)
    visits = client_visits(events, "ts", MINUTE, "user_id")
    stats = unique_sketch(visits.join(where, "user_id"), ENTITY_LEVELS, "user_id")
    for grain in (HOUR, DAY, MONTH):
        stats = rollup_time(stats, grain, KEYS, [sketch("uv_sketch"), total("pv")])
    guess = estimated(stats).select("bucket", *KEYS, F.col("uv").alias("guess"), "pv")
    months = client_visits(events, "ts", MONTH, "user_id").join(where, "user_id")
    exact = unique_total(months, ENTITY_LEVELS, "user_id").select("bucket", *KEYS, "uv")
    both = guess.join(exact, ["bucket", *KEYS], "full")
    close = F.abs(F.col("guess") - F.col("uv")) <= F.greatest(F.lit(1.0), F.col("uv") * 0.03)
    return both.select("level", MONTH.key("bucket").alias("stat_key"), *IDS, "uv", "pv", close.alias("within_bound"))


SUPPLIERS = """dim AS (
  SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) AS server_id, n_name AS site_id, r_name AS app_id
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""


def supplier_dim(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    where = (
        supplier.join(lookup_side(nation), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(lookup_side(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "s_suppkey",
            F.col("s_suppkey").cast("string").alias("server_id"),
            F.col("n_name").alias("site_id"),
            F.col("r_name").alias("app_id"),
        )
    )
    return lookup_side(where, supplier)


@query(
    "uvpv_month_parts",
    f"""WITH {SUPPLIERS},
ent AS (
  SELECT 'server' AS level, app_id, site_id, server_id FROM dim
  UNION SELECT 'site', app_id, site_id, '*' FROM dim
  UNION SELECT 'app', app_id, '*', '*' FROM dim),
{buckets('month', 'lineitem', 'l_shipdate')},
f AS (SELECT date_trunc('month', l_shipdate) AS bucket, l_partkey AS user_id, app_id, site_id, server_id
      FROM lineitem JOIN dim ON l_suppkey = s_suppkey),
s AS {leveled(UNIQUE, 'f')}
SELECT ent.level, strftime(cal.bucket, '%Y%m') AS stat_key, ent.app_id, ent.site_id,
       ent.server_id, coalesce(uv, 0) AS uv, coalesce(pv, 0) AS pv
FROM cal CROSS JOIN ent LEFT JOIN s ON s.level = ent.level AND s.bucket = cal.bucket
 AND s.app_id = ent.app_id AND s.site_id = ent.site_id AND s.server_id = ent.server_id""",
)
def uvpv_month_parts(spark, sf_dir):
    """Suppliers as servers and parts as clients: month grain on the largest table."""
    lines = table(spark, sf_dir, "lineitem")
    dim = supplier_dim(spark, sf_dir)
    visits = client_visits(lines, "l_shipdate", MONTH, "l_partkey", ["l_suppkey"])
    placed = visits.join(dim, F.col("l_suppkey") == F.col("s_suppkey"))
    stats = unique_total(placed, ENTITY_LEVELS, "l_partkey")
    frame = calendar(level_frame(dim, ENTITY_LEVELS), *span(lines, "l_shipdate", MONTH), MONTH)
    return keyed(zero_fill(stats, frame, ["bucket", "level", *IDS], {"uv": 0, "pv": 0}), MONTH)


@query(
    "unknown_member",
    f"""WITH {PLACES},
known AS (SELECT places.* FROM places JOIN customer ON user_id = c_custkey
          WHERE c_mktsegment = 'BUILDING')
SELECT coalesce(app_id, '999') AS app_id, coalesce(site_id, '999') AS site_id, {UNIQUE}
FROM events LEFT JOIN known USING (user_id)
GROUP BY 1, 2""",
)
def unknown_member(spark, sf_dir):
    """Facts whose device the dimension lacks are kept under the unknown id."""
    segment = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'")
    known = places(spark, sf_dir).join(
        segment.select(F.col("c_custkey").alias("user_id")), "user_id", "left_semi"
    )
    per_user = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("views"))
    placed = attach_dim(per_user, known, ["user_id"], ["app_id", "site_id"])
    return placed.groupBy("app_id", "site_id").agg(
        F.count_distinct("user_id").alias("uv"), F.sum("views").alias("pv")
    )
