"""Partitioned tables, dimension files and JDBC."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from opslog.functions.timekeys import in_range, partition_predicate
from opslog.sources.folders import live, paths_of, schema_of, some_folder

SERVER_FILE = "app_id STRING, site_id STRING, host_id STRING, host_name STRING, server_ip STRING, role STRING"
PORT_FILE = "site_id STRING, switch_id STRING, switch_name STRING, port_id STRING, port_type STRING"
ROUTER_FILE = "site_id STRING, router_host STRING, router_port STRING, router_id STRING"


def read_window(spark: SparkSession, path: str, ts: str, begin: datetime, end: datetime) -> DataFrame:
    """Rows of ``[begin, end)``: only folders of the hours that the range touches are listed and read.

    Of hours that were compacted, what the manifest says counts.  ``dt`` and ``hh`` are text.
    """
    found = live(spark, path, begin, end)
    folders = [f for hour, names in found.items() for f in paths_of(path, hour, names)]
    some = folders[0] if folders else some_folder(spark, path)
    if some is None:
        return spark.read.parquet(path).where(partition_predicate(begin, end) & in_range(ts, begin, end))
    schema = schema_of(spark, some)
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    return rows.where(partition_predicate(begin, end) & in_range(ts, begin, end))


def read_dimension(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A ``|``-separated snapshot file."""
    return spark.read.csv(path, sep="|", schema=schema, emptyValue="", nullValue=None)


def jdbc_options(url: str, user: str | None, password: str | None, driver: str | None) -> dict[str, str]:
    """Connection options; secrets come from the caller's environment, never from files here."""
    given = {"url": url, "user": user, "password": password, "driver": driver}
    return {k: v for k, v in given.items() if v}


def read_jdbc(
    spark: SparkSession,
    options: dict[str, str],
    table: str | None = None,
    query: str | None = None,
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """A table or a query; ``split`` = (column, low, high, parts) reads a table in parallel."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    reader = spark.read.format("jdbc").options(**options)
    if query is not None:
        return reader.option("query", query).load()
    if split is not None:
        column, low, high, parts = split
        reader = reader.options(
            partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts
        )
    return reader.option("dbtable", table).load()
