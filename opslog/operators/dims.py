"""Dimensions: builds, lookup, calendar and zero fill.

A dimension is broadcast only after a look at the size of the files it comes from
(:func:`lookup_side`).  Above the bound it is joined by a shuffle, whose hot
partitions adaptive execution splits at run time.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.functions.timekeys import instant
from opslog.spec import ALL, DAY, UNKNOWN, Grain, Level


def server_dimension(
    hosts: DataFrame, groups: DataFrame, sites: DataFrame, apps: DataFrame, addresses: DataFrame
) -> DataFrame:
    """Servers in use with their site and app; a host without an app gets the unknown id.

    hosts(host_id, host_name, group_id, app_key, role, in_use), groups(group_id, site_key),
    sites(site_key, site_id), apps(app_key, app_id), addresses(host_id, server_ip).
    """
    placed = (
        hosts.join(groups, "group_id")
        .join(sites, "site_key")
        .join(apps, "app_key", "left")
        .withColumn("app_id", F.coalesce(F.col("app_id").cast("string"), F.lit(UNKNOWN)))
    )
    in_use = hosts.filter("in_use").select("host_id")
    reachable = addresses.join(in_use, "host_id", "left_semi").select("host_id", "server_ip").distinct()
    return placed.join(reachable, "host_id").select(
        "app_id",
        F.col("site_id").cast("string").alias("site_id"),
        F.col("host_id").cast("string").alias("host_id"),
        "host_name",
        "server_ip",
        "role",
    )


def port_dimension(ports: DataFrame, switches: DataFrame, groups: DataFrame, sites: DataFrame) -> DataFrame:
    """ports(switch_id, port_id, port_type), switches(switch_id, switch_name, group_id), ..."""
    return (
        ports.join(switches, "switch_id")
        .join(groups, "group_id")
        .join(sites, "site_key")
        .select(
            F.col("site_id").cast("string").alias("site_id"),
            F.col("switch_id").cast("string").alias("switch_id"),
            "switch_name",
            F.col("port_id").cast("string").alias("port_id"),
            "port_type",
        )
    )


def router_dimension(
    routers: DataFrame, hosts: DataFrame, groups: DataFrame, sites: DataFrame
) -> DataFrame:
    """routers(router_id, host_id, router_port, in_use): active ones, by upper-case host name."""
    active = routers.filter("in_use").select("router_id", "host_id", "router_port").distinct()
    placed = hosts.join(groups, "group_id").join(sites, "site_key")
    return active.join(placed, "host_id").select(
        F.col("site_id").cast("string").alias("site_id"),
        F.upper("host_name").alias("router_host"),
        F.col("router_port").cast("string").alias("router_port"),
        F.col("router_id").cast("string").alias("router_id"),
    )


BROADCAST_BYTES = 16 * 1024 * 1024  # of files; a few times that in memory


def scan_bytes(df: DataFrame) -> int:
    """Size the optimizer gives a plan; for a plain scan, that of its files and columns."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def lookup_side(dim: DataFrame, source: DataFrame | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``dim`` marked for broadcast if its ``source`` scan is small enough.

    ``source`` is the scan that bounds the rows of ``dim`` (``dim`` itself if it
    is one).  The optimizer's own estimate for a dimension joined from several
    tables is the product of their sizes, which says nothing.
    """
    return F.broadcast(dim) if scan_bytes(dim if source is None else source) <= limit else dim


def attach_dim(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    ids: Sequence[str],
    unknown: str = UNKNOWN,
) -> DataFrame:
    """Left lookup of ``ids``; a fact whose device is not known keeps the unknown id."""
    found = facts.join(dim.select(*on, *ids), list(on), "left")
    return found.withColumns({c: F.coalesce(F.col(c), F.lit(unknown)) for c in ids})


def calendar(
    dim: DataFrame,
    begin: datetime | Column,
    end: datetime | Column,
    grain: Grain,
    role: str | None = None,
    bucket: str = "bucket",
    spread: int = 1,
) -> DataFrame:
    """One copy of the dimension per bucket of ``[begin, end)``.

    Each dimension row generates its own buckets, so there is no join at all.
    ``spread`` lets that many tasks share the days of a long range.
    """
    if role is not None:
        dim = dim.filter(F.col("role") == role)
    first = grain.bucket(_ts(begin))
    last = grain.bucket(_ts(end) - F.expr("interval 1 microsecond"))
    if spread > 1 and grain.seconds is not None and grain.seconds < DAY.seconds:
        days = dim.withColumn("_day", F.explode(F.sequence(DAY.bucket(first), last, DAY.step)))
        dim = days.repartition(spread, "_day", *dim.columns)
        first = F.greatest(first, "_day")
        last = F.least(last, F.col("_day") + DAY.step - grain.step)
    return dim.withColumn(bucket, F.explode(F.sequence(first, last, grain.step))).drop("_day")


def _ts(value: datetime | Column) -> Column:
    return value.cast("timestamp") if isinstance(value, Column) else instant(value)


def span(df: DataFrame, ts: str, grain: Grain) -> tuple[Column, Column]:
    """``[begin, end)`` covering all of ``df``, as scalar sub-queries of the same plan."""
    first = df.select(F.min(grain.bucket(ts)).alias("first")).scalar()
    last = df.select((F.max(grain.bucket(ts)) + grain.step).alias("last")).scalar()
    return first, last


def zero_fill(
    stats: DataFrame,
    frame: DataFrame,
    keys: Sequence[str],
    zeros: dict[str, object],
    keep_unknown: bool = False,
) -> DataFrame:
    """Every row of ``frame``, with typed zeros where ``stats`` has nothing.

    Facts of devices outside the frame are dropped unless ``keep_unknown``.
    """
    how = "full" if keep_unknown else "left"
    types = {f.name: f.dataType for f in stats.schema.fields}
    measures = {
        name: F.coalesce(F.col(name), F.lit(zero).cast(types[name])) for name, zero in zeros.items()
    }
    extra = [c for c in frame.columns if c not in keys]
    wanted = stats.select(*keys, *zeros)
    return frame.join(wanted, list(keys), how).withColumns(measures).select(*keys, *extra, *zeros)


def by_levels(
    df: DataFrame,
    levels: Sequence[Level],
    measures: Sequence[Column],
    also: Sequence[str] = (),
) -> DataFrame:
    """Aggregate to several entity levels in one pass.

    Rows of a coarser level carry ``*`` in the ids they have summed over.
    """
    ids = list(dict.fromkeys(c for level in levels for c in level.ids))
    sets = [[F.col(c) for c in (*also, *level.ids)] for level in levels]
    flags = [F.grouping(c).alias(f"_g_{c}") for c in ids]
    out = df.groupingSets(sets, *also, *ids).agg(*flags, *measures)
    name = F.lit(None).cast("string")
    for level in levels:
        present = [F.col(f"_g_{c}") == (0 if c in level.ids else 1) for c in ids]
        test = present[0]
        for p in present[1:]:
            test = test & p
        name = F.when(test, F.lit(level.name)).otherwise(name)
    shown = [
        F.when(F.col(f"_g_{c}") == 1, F.lit(ALL)).otherwise(F.col(c)).alias(c) for c in ids
    ]
    drop = {*also, *ids, *(f"_g_{c}" for c in ids)}
    rest = [c for c in out.columns if c not in drop]
    return out.select(name.alias("level"), *also, *shown, *rest)


def level_frame(dim: DataFrame, levels: Sequence[Level]) -> DataFrame:
    """The distinct entities of every level of a dimension."""
    return by_levels(dim, levels, [F.count(F.lit(1)).alias("members")]).drop("members")
