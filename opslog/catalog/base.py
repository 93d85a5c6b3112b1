"""Registry of the queries over the given tables and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opslog.operators.dims import lookup_side
from opslog.session import prepare

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        REGISTRY[name] = Entry(run, sql)
        return fn

    return register


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file once, not once per mention."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id -> server (nation and segment), site (nation), app (region)."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    where = (
        customer.join(lookup_side(nation), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(lookup_side(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("user_id"),
            F.col("r_name").alias("app_id"),
            F.col("n_name").alias("site_id"),
            F.concat_ws(":", "n_name", "c_mktsegment").alias("server_id"),
        )
    )
    return lookup_side(where, customer)


def servers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The server dimension of ``places``."""
    return places(spark, sf_dir).select("app_id", "site_id", "server_id").distinct()


def value_dec():
    """Event value as an exact decimal, so that sums do not depend on task order."""
    return F.col("value").cast("decimal(18,4)")


def prop_k():
    """The number in an event's JSON properties."""
    return F.get_json_object("props", "$.k").cast("int")


# ---- shared SQL pieces ------------------------------------------------------

PLACES = """places AS (
  SELECT c_custkey AS user_id, r_name AS app_id, n_name AS site_id,
         n_name || ':' || c_mktsegment AS server_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
dim AS (SELECT DISTINCT app_id, site_id, server_id FROM places),
ent AS (
  SELECT 'server' AS level, app_id, site_id, server_id FROM dim
  UNION SELECT 'site', app_id, site_id, '*' FROM dim
  UNION SELECT 'app', app_id, '*', '*' FROM dim)"""

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
VALUE = "CAST(value AS DECIMAL(18,4))"


def buckets(unit: str, source: str = "events", ts: str = "ts") -> str:
    """CTE ``cal(bucket)``: every bucket from the first to the last row of ``source``."""
    return f"""cal AS (
  SELECT unnest(generate_series(date_trunc('{unit}', lo), date_trunc('{unit}', hi),
                                INTERVAL 1 {unit})) AS bucket
  FROM (SELECT min({ts})::TIMESTAMP AS lo, max({ts})::TIMESTAMP AS hi FROM {source}))"""


def leveled(select: str, source: str) -> str:
    """``select`` (aggregates) over ``source`` at the three entity levels."""
    return f"""(SELECT 'server' AS level, bucket, app_id, site_id, server_id, {select}
   FROM {source} GROUP BY bucket, app_id, site_id, server_id
   UNION ALL SELECT 'site', bucket, app_id, site_id, '*', {select}
   FROM {source} GROUP BY bucket, app_id, site_id
   UNION ALL SELECT 'app', bucket, app_id, '*', '*', {select}
   FROM {source} GROUP BY bucket, app_id)"""


# Averages of averages in whole units of 1e-12, so that both sides round alike.


def units(x: str) -> str:
    return f"CAST(round({x} * 1000000000000) AS HUGEINT)"


def mean_units(u: str) -> str:
    return f"((2 * sum({u}) + count(*)) // (2 * count(*)))"


def six_digits(u: str) -> str:
    return f"CAST(({u} + 500000) // 1000000 AS DOUBLE) / 1000000"
