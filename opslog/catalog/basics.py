"""Scalar functions, filters, aggregates, set operations and neighbours on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from opslog.catalog.base import K, VALUE, prop_k, query, table, value_dec
from opslog.functions.measures import count_when, exact_mean, mbps, percent
from opslog.functions.text import client_mark, pair_value, part, port_number, unwrap
from opslog.functions.timekeys import (
    day_part, from_epoch_text, hour_part, minute_key, parts_from_key, seconds_between,
)
from opslog.operators.sequence import both_neighbours, minute_chunk, newest, next_row, oldest


@query(
    "scalar_functions",
    f"""WITH e AS (SELECT *, {K} AS k FROM events)
SELECT event_id, strftime(ts, '%Y%m%d%H%M') AS minute, strftime(ts, '%Y%m%d') AS dt, strftime(ts, '%H') AS hh,
  strftime(ts, '%Y%m%d') AS key_dt, strftime(ts, '%H') AS key_hh, substr(event_type, 1, 3) AS head,
  event_type || '_' || user_id AS composite, user_id || ':' || k AS joined, CAST(k AS VARCHAR) AS second_part,
  CAST(NULL AS VARCHAR) AS third_part, instr(props, 'k') AS at_k, coalesce(nullif(event_type, 'error'), 'none') AS kind,
  CASE WHEN event_type = 'view' THEN NULL ELSE k END AS tried, round(value / 3, 2) AS rounded,
  CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS coded,
  CAST(k AS BIGINT) AS gap, strftime(make_timestamp(k * 1000000), '%Y-%m-%d %H:%M:%S.%g') AS from_epoch,
  CAST(CAST(round(value * 1000000 * 8 / 60 / 1024 / 1024, 2) AS DECIMAL(18,2)) AS DOUBLE) AS mbps,
  CASE WHEN k % 3 = 0 THEN k % 8 WHEN k % 3 = 1 THEN k % 8 ELSE -1 END AS port_no,
  CAST(k AS BIGINT) AS rx, CAST(k * 2 AS BIGINT) AS tx, upper(event_type) AS upped, 'a/b' AS mount,
  CAST(user_id AS VARCHAR) AS client, greatest(user_id, CAST(k AS BIGINT)) AS later,
  coalesce(CAST(k AS DOUBLE) * 100 / nullif(user_id, 0), 0) AS pct
FROM e""",
)
def scalar_functions(spark, sf_dir):
    """Every scalar helper of the engine on every event."""
    k, user = F.col("k"), F.col("user_id").cast("string")
    label = (
        F.when(k % 3 == 0, F.concat(F.lit("Port "), (k % 8).cast("string"), F.lit(" up")))
        .when(k % 3 == 1, F.concat(F.lit("GigabitEthernet1_0_"), (k % 8).cast("string")))
        .otherwise(F.lit("Vlan"))
    )
    joined = F.concat_ws(":", user, k.cast("string"))
    pair = F.concat_ws(",", k.cast("string"), (k * 2).cast("string"))
    key_dt, key_hh = parts_from_key(minute_key("ts"))
    return table(spark, sf_dir, "events").withColumn("k", prop_k()).select(
        "event_id",
        minute_key("ts").alias("minute"),
        day_part("ts"),
        hour_part("ts"),
        key_dt.alias("key_dt"),
        key_hh.alias("key_hh"),
        F.substring("event_type", 1, 3).alias("head"),
        F.concat_ws("_", "event_type", user).alias("composite"),
        joined.alias("joined"),
        part(joined, ":", 1).alias("second_part"),
        part(joined, ":", 2).alias("third_part"),
        F.instr("props", "k").alias("at_k"),
        F.coalesce(F.nullif(F.col("event_type"), F.lit("error")), F.lit("none")).alias("kind"),
        F.when(F.col("event_type") == "view", F.lit("eth0")).otherwise(k.cast("string")).try_cast("int").alias("tried"),
        F.round(F.col("value") / 3, 2).alias("rounded"),
        F.when(F.col("event_type") == "view", 1).when(F.col("event_type") == "click", 2).otherwise(3).alias("coded"),
        seconds_between("ts", F.col("ts") + F.make_dt_interval(secs=k)).alias("gap"),
        from_epoch_text(k).alias("from_epoch"),
        mbps(F.col("value") * 1000000).cast("double").alias("mbps"),
        port_number(label).alias("port_no"),
        pair_value(pair, 0).alias("rx"),
        pair_value(pair, 1).alias("tx"),
        F.upper("event_type").alias("upped"),
        F.translate(F.lit("a-b"), "-", "/").alias("mount"),
        client_mark(F.concat(F.lit("#{"), user, F.lit("}"))).alias("client"),
        F.greatest(F.col("user_id"), k.cast("bigint")).alias("later"),
        percent(k, F.col("user_id")).alias("pct"),
    )


@query(
    "filter_counts",
    f"""WITH e AS (SELECT *, {K} AS k, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt
           FROM events)
SELECT strftime(ts, '%Y%m%d') AS dt, count(*) FILTER (ts >= '2024-01-10' AND ts < '2024-01-20') AS in_range,
  count(*) FILTER (event_type = 'view') AS equal, count(*) FILTER (event_type <> 'view') AS unequal,
  count(*) FILTER (nxt IS NULL) AS last_ones, count(*) FILTER (nxt IS NOT NULL) AS linked,
  count(*) FILTER (instr(props, ':') > 1) AS has_colon, count(*) FILTER (props <> '' AND event_type = 'click') AS both_tests,
  count(*) FILTER (k > 0) AS positive, count(*) FILTER (event_type LIKE 'vi%') AS prefixed
FROM e GROUP BY 1""",
)
def filter_counts(spark, sf_dir):
    """How many rows each kind of predicate keeps, per day."""
    events = table(spark, sf_dir, "events")
    linked = next_row(events, ["user_id"], ["ts", "event_id"], minute_chunk("ts"), ["event_type"], "nxt")
    kind, ts = F.col("event_type"), F.col("ts")
    return linked.groupBy(day_part("ts")).agg(
        count_when((ts >= F.lit("2024-01-10").cast("timestamp_ntz")) & (ts < F.lit("2024-01-20").cast("timestamp_ntz"))).alias("in_range"),
        count_when(kind == "view").alias("equal"),
        count_when(kind != "view").alias("unequal"),
        count_when(F.col("nxt").isNull()).alias("last_ones"),
        count_when(F.col("nxt").isNotNull()).alias("linked"),
        count_when(F.instr("props", ":") > 1).alias("has_colon"),
        count_when((F.col("props") != "") & (kind == "click")).alias("both_tests"),
        count_when(prop_k() > 0).alias("positive"),
        count_when(kind.startswith("vi")).alias("prefixed"),
    )


@query(
    "aggregate_kinds",
    f"""WITH e AS (SELECT *, {K} AS k FROM events)
SELECT event_type, count(*) AS n, count(nullif(k, 0)) AS n_nonzero, CAST(sum({VALUE}) AS DOUBLE) AS total,
  CAST(sum({VALUE}) AS DOUBLE) / count(*) AS average, min(value) AS least, max(value) AS most,
  count(DISTINCT user_id) AS uniques, count(CASE WHEN k < 50 THEN 1 END) AS small,
  CAST(sum(k) AS DOUBLE) * 100 / sum(user_id) AS pct, min(event_type) AS same
FROM e GROUP BY event_type""",
)
def aggregate_kinds(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("k", prop_k())
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.nullif(F.col("k"), F.lit(0))).alias("n_nonzero"),
        F.sum(value_dec()).cast("double").alias("total"),
        exact_mean(value_dec()).alias("average"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
        F.count_distinct("user_id").alias("uniques"),
        count_when(F.col("k") < 50).alias("small"),
        percent(F.sum("k"), F.sum("user_id")).alias("pct"),
        F.first("event_type").alias("same"),
    )


@query(
    "set_operations",
    """SELECT kind, id, count(*) AS n FROM (
  SELECT 'customer' AS kind, c_nationkey AS id FROM customer
  UNION ALL SELECT 'supplier', s_nationkey FROM supplier
  UNION ALL SELECT DISTINCT 'distinct', c_nationkey FROM customer) GROUP BY ALL""",
)
def set_operations(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_nationkey").alias("id"))
    supplier = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_nationkey").alias("id"))
    once = customer.select(F.lit("distinct").alias("kind"), "id").distinct()
    return customer.unionByName(supplier).unionByName(once).groupBy("kind", "id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "neighbours",
    """SELECT event_id, lead(event_id) OVER w AS next_id, lead(event_type) OVER w AS next_type,
  lag(event_id) OVER w AS previous_id, lag(event_type) OVER w AS previous_type
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def neighbours(spark, sf_dir):
    """Next and previous event of each event's user."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    out = both_neighbours(
        events, ["user_id"], ["ts", "event_id"], minute_chunk("ts"), ["event_id", "event_type"], "nxt", "prev"
    )
    return out.select(
        "event_id",
        F.col("nxt.event_id").alias("next_id"),
        F.col("nxt.event_type").alias("next_type"),
        F.col("prev.event_id").alias("previous_id"),
        F.col("prev.event_type").alias("previous_type"),
    )


@query(
    "edge_rows",
    """SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS last_id, arg_max(value, (ts, event_id)) AS last_value,
  arg_min(event_id, (ts, event_id)) AS first_id, arg_min(value, (ts, event_id)) AS first_value
FROM events GROUP BY ALL""",
)
def edge_rows(spark, sf_dir):
    """First and last row of each user and type."""
    events = table(spark, sf_dir, "events")
    args = (["user_id", "event_type"], ["ts", "event_id"], ["event_id", "value"])
    names = ["user_id", "event_type"]
    last = newest(events, *args).toDF(*names, "last_id", "last_value")
    first = oldest(events, *args).toDF(*names, "first_id", "first_value")
    return last.join(first, names)


@query(
    "unwrapped",
    "SELECT o_orderkey, o_orderpriority AS priority, o_orderstatus AS status FROM orders",
)
def unwrapped(spark, sf_dir):
    """Stripping of quotes and braces on every order."""
    wrapped = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit('"'), "o_orderpriority", F.lit('"')).alias("priority"),
        F.concat(F.lit("{"), "o_orderstatus", F.lit("}")).alias("status"),
    )
    return wrapped.select(
        "o_orderkey", unwrap(F.col("priority"), '"').alias("priority"), unwrap(F.col("status"), "{").alias("status")
    )
