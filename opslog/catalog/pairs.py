"""Request/response pairing on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from opslog.catalog.base import PLACES, K, buckets, places, prop_k, query, servers, table
from opslog.operators.dims import calendar, span, zero_fill
from opslog.operators.pairing import PAIR_ZEROS, REQUEST, assume_answered, pair_rate, pair_requests
from opslog.operators.rollup import rollup_entity
from opslog.operators.sequence import minute_chunk
from opslog.spec import APP, HOUR, SITE, ratio, total

PAIR_RULES = [
    total("req_cnt"),
    total("success_cnt"),
    total("fail_cnt"),
    ratio("success_rate", "success_cnt", "req_cnt"),
]
COLUMNS = ["req_cnt", "success_cnt", "fail_cnt", "success_rate"]
RATES = """count(*) AS req_cnt, CAST(sum(success) AS BIGINT) AS success_cnt,
  CAST(count(*) - sum(success) AS BIGINT) AS fail_cnt,
  CAST(sum(success) AS DOUBLE) * 100 / count(*) AS success_rate"""
ZEROED = """coalesce(req_cnt, 0) AS req_cnt, coalesce(success_cnt, 0) AS success_cnt,
  coalesce(fail_cnt, 0) AS fail_cnt, coalesce(success_rate, 0) AS success_rate"""


def route_log(spark, sf_dir):
    """Events as a router log: a view asks, the user's next event answers.

    Answers of type error name no server; a purchase is a success.
    """
    return as_route_log(table(spark, sf_dir, "events"))


def as_route_log(events):
    answer = F.col("event_type") != "view"
    nation_key = (prop_k() % 25).cast("string")
    return events.select(
        "ts",
        "event_id",
        "user_id",
        F.when(answer, F.lit("Response")).otherwise(F.lit(REQUEST)).alias("mode"),
        F.when(answer & (F.col("event_type") != "error"), F.concat(F.lit("NATION_"), nation_key))
        .otherwise(F.lit(""))
        .alias("server_ip"),
        F.when(F.col("event_type") == "purchase", F.lit("0")).otherwise(F.lit("1")).alias("result"),
    )


def route_pairs(spark, sf_dir, **options):
    log = route_log(spark, sf_dir)
    return pair_requests(log, ["user_id"], ["ts", "event_id"], minute_chunk("ts"), **options)


ROUTE = f"""log AS (SELECT ts, event_id, user_id, event_type,
    CASE WHEN event_type = 'view' OR event_type = 'error' THEN ''
         ELSE 'NATION_' || ({K} % 25) END AS server_ip,
    CASE WHEN event_type = 'purchase' THEN '0' ELSE '1' END AS result FROM events),
nxt AS (SELECT *, lead(server_ip) OVER w AS answer_ip, lead(result) OVER w AS answer
        FROM log WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
pairs AS (SELECT *, date_trunc('hour', ts) AS bucket, CAST(answer = '0' AS INTEGER) AS success
          FROM nxt WHERE event_type = 'view' AND answer IS NOT NULL)"""


def route_site_stats(spark, sf_dir):
    pairs = route_pairs(spark, sf_dir).withColumn("bucket", HOUR.bucket("ts"))
    stats = pair_rate(pairs, ["bucket", "server_ip"]).withColumnRenamed("server_ip", "site_id")
    sites = servers(spark, sf_dir).select("app_id", "site_id").distinct()
    frame = calendar(sites, *span(table(spark, sf_dir, "events"), "ts", HOUR), HOUR)
    return zero_fill(stats, frame, ["bucket", "site_id"], PAIR_ZEROS)


@query(
    "pair_rate_user",
    f"""WITH {PLACES}, {buckets('hour')}, {ROUTE},
s AS (SELECT bucket, answer_ip AS site_id, {RATES} FROM pairs WHERE answer_ip <> '' GROUP BY ALL),
z AS (SELECT cal.bucket, d.app_id, d.site_id, {ZEROED}
      FROM cal CROSS JOIN (SELECT DISTINCT app_id, site_id FROM dim) d
      LEFT JOIN s USING (bucket, site_id))
SELECT 'site' AS level, strftime(bucket, '%Y%m%d%H') AS stat_key, app_id, site_id, req_cnt,
       success_cnt, fail_cnt, success_rate FROM z
UNION ALL
SELECT 'app', strftime(bucket, '%Y%m%d%H'), app_id, '*', CAST(sum(req_cnt) AS BIGINT),
       CAST(sum(success_cnt) AS BIGINT), CAST(sum(fail_cnt) AS BIGINT),
       coalesce(CAST(sum(success_cnt) AS DOUBLE) * 100 / nullif(sum(req_cnt), 0), 0)
FROM z GROUP BY bucket, app_id""",
)
def pair_rate_user(spark, sf_dir):
    """Success of requests by the server that answered, zero-filled, then per app."""
    out = rollup_entity(route_site_stats(spark, sf_dir), [SITE, APP], PAIR_RULES)
    return out.select("level", HOUR.key("bucket").alias("stat_key"), "app_id", "site_id", *COLUMNS)


@query(
    "pair_rate_router",
    f"""WITH {PLACES}, {ROUTE}, {buckets('hour')},
s AS (SELECT bucket, c_mktsegment AS router_id, {RATES}
      FROM pairs JOIN customer ON user_id = c_custkey WHERE answer_ip <> '' GROUP BY ALL)
SELECT strftime(cal.bucket, '%Y%m%d%H') AS stat_key, r.router_id, {ZEROED}
FROM cal CROSS JOIN (SELECT DISTINCT c_mktsegment AS router_id FROM customer) r
LEFT JOIN s USING (bucket, router_id)""",
)
def pair_rate_router(spark, sf_dir):
    """The same pairs by the router that took the request (the user's segment)."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("router_id")
    )
    pairs = route_pairs(spark, sf_dir).withColumn("bucket", HOUR.bucket("ts"))
    per_user = pair_rate(pairs, ["bucket", "user_id"]).join(customer, "user_id")
    stats = per_user.groupBy("bucket", "router_id").agg(*[r.column() for r in PAIR_RULES])
    frame = calendar(
        customer.select("router_id").distinct(),
        *span(table(spark, sf_dir, "events"), "ts", HOUR),
        HOUR,
    )
    out = zero_fill(stats, frame, ["bucket", "router_id"], PAIR_ZEROS)
    return out.select(HOUR.key("bucket").alias("stat_key"), "router_id", *COLUMNS)


@query(
    "pair_status_user",
    f"""WITH {PLACES}, {ROUTE}
SELECT strftime(bucket, '%Y%m%d%H') AS stat_key, app_id, site_id, {RATES}
FROM pairs JOIN places USING (user_id) GROUP BY ALL""",
)
def pair_status_user(spark, sf_dir):
    """Status form: the server is the request's, and an answer need not name one."""
    pairs = route_pairs(spark, sf_dir, entity_from="request", require_entity=False)
    per_user = pair_rate(pairs.withColumn("bucket", HOUR.bucket("ts")), ["bucket", "user_id"])
    placed = per_user.join(places(spark, sf_dir), "user_id")
    out = placed.groupBy("bucket", "app_id", "site_id").agg(*[r.column() for r in PAIR_RULES])
    return out.select(HOUR.key("bucket").alias("stat_key"), "app_id", "site_id", *COLUMNS)


@query(
    "pair_assumed",
    f"""WITH {PLACES}
SELECT strftime(ts, '%Y%m%d%H') AS stat_key, app_id, count(*) AS req_cnt, count(*) AS success_cnt,
  CAST(0 AS BIGINT) AS fail_cnt, CAST(100 AS DOUBLE) AS success_rate
FROM events JOIN places USING (user_id) WHERE event_type = 'view' GROUP BY 1, 2""",
)
def pair_assumed(spark, sf_dir):
    """Requests counted as answered, for logs without answers."""
    asked = assume_answered(route_log(spark, sf_dir)).withColumn("bucket", HOUR.bucket("ts"))
    placed = pair_rate(asked, ["bucket", "user_id"]).join(places(spark, sf_dir), "user_id")
    out = placed.groupBy("bucket", "app_id").agg(*[r.column() for r in PAIR_RULES])
    return out.select(HOUR.key("bucket").alias("stat_key"), "app_id", *COLUMNS)


@query(
    "pair_rate_conv",
    f"""WITH nxt AS (SELECT *, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS answer
             FROM conversations),
p AS (SELECT turn, CAST(answer = 'assistant' AS INTEGER) AS success
      FROM nxt WHERE role = 'user' AND answer IS NOT NULL)
SELECT turn, {RATES} FROM p GROUP BY turn""",
)
def pair_rate_conv(spark, sf_dir):
    """User turns and the turn after them; only the key columns are read."""
    log = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "user", F.lit(REQUEST)).otherwise(F.lit("Response")).alias("mode"),
        F.col("role").alias("server_ip"),
        F.when(F.col("role") == "assistant", F.lit("0")).otherwise(F.lit("1")).alias("result"),
    )
    chunk = F.call_function("div", F.col("turn"), F.lit(1000))
    return pair_rate(pair_requests(log, ["conv_id"], ["turn"], chunk), ["turn"])
