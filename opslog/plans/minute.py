"""The statistics jobs: raw tables of a window to one table per metric.

Every job returns its tables by name.  A table holds all entity levels of its
metric (column ``level``), so that one pass over the raw rows and one write serve
server, site and app.  The same jobs run at hour or day grain where the numbers
have to be recomputed from raw rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.functions.measures import mbps
from opslog.functions.text import pair_value, port_number
from opslog.functions.timekeys import instant
from opslog.operators.concurrency import clipped, concurrency
from opslog.operators.dims import attach_dim, by_levels, level_frame, lookup_side, zero_fill
from opslog.operators.gauge import (
    by_category, finish_columns, gauge, gauge_parts, gauge_zeros, port_gauge, port_parts,
)
from opslog.operators.histogram import (
    Bin, closed_durations, duration_histogram, long_bins, short_bins,
)
from opslog.operators.last_sample import EMPTY, last_sample
from opslog.operators.outcomes import WEB_RULES, probe_outcome, probe_rules, web_outcome
from opslog.operators.pairing import PAIR_ZEROS, pair_rate, pair_requests
from opslog.operators.rate import rate_per_slot
from opslog.operators.rollup import rollup_entity, shares
from opslog.operators.sequence import minute_chunk
from opslog.operators.uniques import client_visits, unique_sketch, unique_total
from opslog.plans.lake import Lake, window_frame
from opslog.spec import (
    ALL, APP, HOUR, MINUTE, SECOND, SITE, Grain, Level, Rule, Window, gauge_rules, high, low, mean,
    ratio, total,
)

# Roles, port types and log words the jobs select by.
CSS, WEB = "CSS", "WEB"
UPLINK = "U"
OPEN = "OPEN"
OFF, BANDWIDTH = "OFF", "BW"
CPU_CATEGORIES = {"user": "user", "system": "system", "idle": "idle"}
MEMORY_CATEGORIES = {"used": "used"}
DISK_CATEGORIES = {"free": "free", "used": "used"}

IDS = ["app_id", "site_id", "server_ip"]
KEYS = ["bucket", *IDS]
LEVELS = (Level("server", tuple(IDS)), SITE, APP)
PAIR_RULES = [
    total("req_cnt"),
    total("success_cnt"),
    total("fail_cnt"),
    ratio("success_rate", "success_cnt", "req_cnt"),
]
RATE_RULES = [mean("avg_tps"), low("min_tps"), high("max_tps")]

Tables = dict[str, DataFrame]


def _servers(lake: Lake, role: str | None = CSS) -> DataFrame:
    servers = lake.dim("servers")
    kept = servers if role is None else servers.filter(F.col("role") == role)
    return lookup_side(kept.select(*IDS).distinct(), servers)


def _zeros(rules: list[Rule]) -> dict[str, object]:
    return {r.name: 0 for r in rules}


def _fill_servers(
    lake: Lake, stats: DataFrame, window: Window, grain: Grain, zeros: dict[str, object], role: str | None = CSS
) -> DataFrame:
    """Statistics per (bucket, server_ip) over every server of the window."""
    frame = window_frame(_servers(lake, role), window, grain)
    return zero_fill(stats, frame, ["bucket", "server_ip"], zeros).select(*KEYS, *zeros)


def _pair_tables(lake: Lake, pairs: DataFrame, router: list[str], window: Window, grain: Grain) -> Tables:
    pairs = pairs.withColumn("bucket", grain.bucket("log_time"))
    by_server = _fill_servers(lake, pair_rate(pairs, ["bucket", "server_ip"]), window, grain, PAIR_ZEROS)
    named = pairs.withColumnRenamed(router[0], "router_host").withColumnRenamed(router[1], "router_port")
    keys = ["bucket", "router_host", "router_port"]
    routers = window_frame(lake.dim("routers"), window, grain)
    filled = zero_fill(pair_rate(named, keys), routers, keys, PAIR_ZEROS)
    by_router = filled.groupBy("bucket", "router_id").agg(*[r.column() for r in PAIR_RULES])
    return {"servers": rollup_entity(by_server, LEVELS, PAIR_RULES), "routers": by_router}


def route(lake: Lake, window: Window, grain: Grain = MINUTE) -> Tables:
    log = lake.raw("route_log", window.read_from, window.read_to)
    pairs = pair_requests(
        log.filter(F.col("log_time") >= instant(window.begin)),
        ["session_id", "client_mac", "client_ip"],
        ["log_time", "mode", "server_ip", "result", "router_id", "router_port"],
        minute_chunk("log_time"),
        end=instant(window.end),
    )
    out = _pair_tables(lake, pairs, ["router_id", "router_port"], window, grain)
    return {"route": out["servers"], "route_router": out["routers"]}


def status(lake: Lake, window: Window, grain: Grain = MINUTE) -> Tables:
    """Pairs by router session; the server is the request's and an answer needs none."""
    log = lake.raw("status_log", window.read_from, window.read_to)
    pairs = pair_requests(
        log.filter(F.col("log_time") >= instant(window.begin)),
        ["router_host", "router_port", "router_session"],
        ["log_time", "mode", "server_ip", "result"],
        minute_chunk("log_time"),
        entity_from="request",
        require_entity=False,
        end=instant(window.end),
    )
    out = _pair_tables(lake, pairs, ["router_host", "router_port"], window, grain)
    return {"status": out["servers"], "status_router": out["routers"]}


def session(lake: Lake, window: Window, grain: Grain = MINUTE) -> Tables:
    """Users per server as its open sessions report them."""
    log = lake.raw("status_log", window.begin, window.end)
    open_ones = log.filter((F.col("server_ip") != "") & (F.col("session_status") == OPEN))
    stats = gauge(
        open_ones.withColumn("bucket", grain.bucket("log_time")), ["bucket", "server_ip"], {"session": F.col("users")}
    )
    filled = _fill_servers(lake, stats, window, grain, gauge_zeros(["session"]))
    return {"session": rollup_entity(filled, LEVELS, gauge_rules("session"))}


def _closed(lake: Lake, window: Window) -> DataFrame:
    return lake.raw("session_log", window.begin, window.end).filter(F.col("motion") == OFF)


def uvpv(lake: Lake, window: Window, grain: Grain = MINUTE) -> Tables:
    servers = _servers(lake)
    visits = client_visits(_closed(lake, window), "registered_at", grain, "client_id", ["server_ip"])
    stats = unique_total(visits.join(servers, "server_ip"), LEVELS, "client_id")
    frame = window_frame(level_frame(servers, LEVELS), window, grain)
    return {"uvpv": zero_fill(stats, frame, [*KEYS, "level"], {"uv": 0, "pv": 0})}


def uvpv_sketch(lake: Lake, window: Window, grain: Grain = MINUTE) -> Tables:
    """Views with a sketch of their clients: hours, days and months come from it without the raw rows."""
    visits = client_visits(_closed(lake, window), "registered_at", grain, "client_id", ["server_ip"])
    return {"uvpv_sketch": unique_sketch(visits.join(_servers(lake), "server_ip"), LEVELS, "client_id")}


def ccu(lake: Lake, window: Window, grain: Grain = MINUTE) -> Tables:
    """Concurrent users, each level counting its own clients."""
    log = lake.raw("session_log", window.read_from, window.end).filter(F.col("motion") == OFF)
    return {"ccu": ccu_of(lake, log.select("server_ip", "client_id", F.col("registered_at").alias("on_at"), "off_at"), window, grain)}


def ccu_of(lake: Lake, sessions: DataFrame, window: Window, grain: Grain) -> DataFrame:
    """Concurrent users of a window from the sessions (server_ip, client_id, on_at, off_at) that touch it."""
    running = clipped(sessions, instant(window.begin), instant(window.end))
    servers = _servers(lake)
    variants = [
        F.struct(
            F.lit(level.name).alias("level"),
            *[F.col(c) if c in level.ids else F.lit(ALL).alias(c) for c in IDS],
        )
        for level in LEVELS
    ]
    placed = running.join(servers, "server_ip").select(
        "client_id", "on_at", "off_at", F.explode(F.array(*variants)).alias("_e")
    )
    sessions = placed.select("client_id", "on_at", "off_at", "_e.*")
    stats = concurrency(sessions, ["level", *IDS], ["client_id"], "on_at", "off_at", grain)
    frame = window_frame(level_frame(servers, LEVELS), window, grain)
    zeros = {"avg_ccu": 0, "min_ccu": 0, "max_ccu": 0}
    return zero_fill(stats, frame, [*KEYS, "level"], zeros)


def _histogram(lake: Lake, window: Window, grain: Grain, bins: list[Bin]) -> tuple[DataFrame, list[Rule]]:
    lasted = closed_durations(_closed(lake, window), "registered_at", "off_at")
    stats = duration_histogram(
        lasted.withColumn("bucket", grain.bucket("registered_at")), ["bucket", "server_ip"], bins
    )
    return stats, [total("total_cnt"), *[total(b.name) for b in bins]]


def usetime(lake: Lake, window: Window, grain: Grain = MINUTE) -> Tables:
    """Short bins, not zero-filled; servers the dimension lacks stay as unknown."""
    stats, rules = _histogram(lake, window, grain, short_bins())
    placed = attach_dim(stats, _servers(lake, None), ["server_ip"], ["app_id", "site_id"])
    return {"usetime": rollup_entity(placed, LEVELS, rules)}


def usetime_long(lake: Lake, window: Window, grain: Grain = HOUR) -> Tables:
    """Long bins with shares, zero-filled, straight from raw rows."""
    bins = long_bins()
    stats, rules = _histogram(lake, window, grain, bins)
    filled = _fill_servers(lake, stats, window, grain, _zeros(rules))
    out = rollup_entity(filled, LEVELS, rules)
    return {"usetime_long": shares(out, [b.name for b in bins], "total_cnt")}


def bandwidth(lake: Lake, window: Window, grain: Grain = MINUTE) -> Tables:
    """Mbit/s over samples at every level."""
    log = lake.raw("session_log", window.begin, window.end).filter(F.col("motion") == BANDWIDTH)
    servers = _servers(lake)
    parts = gauge_parts(
        log, [grain.bucket("registered_at").alias("bucket"), "server_ip"], {"mbps": mbps(F.col("motion_value"))}
    )
    placed = parts.join(servers, "server_ip")
    stats = by_levels(placed, LEVELS, finish_columns(["mbps"], digits=2), also=["bucket"])
    frame = window_frame(level_frame(servers, LEVELS), window, grain)
    out = zero_fill(stats, frame, [*KEYS, "level"], gauge_zeros(["mbps"]))
    return {"bandwidth": out.withColumns({c: F.col(c).cast("double") for c in gauge_zeros(["mbps"])})}


def probe(lake: Lake, window: Window, grain: Grain = MINUTE) -> Tables:
    tests = lake.raw("probe_log", window.begin, window.end).withColumn("bucket", grain.bucket("test_time"))
    rules = probe_rules()
    filled = _fill_servers(lake, probe_outcome(tests, ["bucket", "server_ip"]), window, grain, _zeros(rules))
    return {"probe": rollup_entity(filled, LEVELS, rules)}


def web(lake: Lake, window: Window, grain: Grain = MINUTE) -> Tables:
    log = lake.raw("web_log", window.begin, window.end).withColumn("bucket", grain.bucket("log_time"))
    stats = web_outcome(log, ["bucket", "server_ip"])
    filled = _fill_servers(lake, stats, window, grain, _zeros(WEB_RULES), WEB)
    return {"web": rollup_entity(filled, LEVELS, WEB_RULES)}


def tps(lake: Lake, window: Window, grain: Grain = MINUTE) -> Tables:
    """Requests per second of routers and of web hosts, each with its sites."""
    zeros = {"avg_tps": 0, "min_tps": 0, "max_tps": 0}
    log = lake.raw("router_web_log", window.begin, window.end)
    named = log.select("log_time", F.col("host").alias("router_host"), F.col("port").alias("router_port"))
    stats = rate_per_slot(named, "log_time", ["router_host", "router_port"], SECOND, grain)
    frame = window_frame(lake.dim("routers"), window, grain)
    routers = zero_fill(stats, frame, ["bucket", "router_host", "router_port"], zeros)
    router_levels = (Level("router", ("site_id", "router_id")), Level("site", ("site_id",)))

    hits = lake.raw("web_log", window.begin, window.end).select("log_time", F.col("host").alias("host_name"))
    hosts = lake.dim("servers").filter(F.col("role") == WEB)
    hosts = hosts.select("site_id", F.upper("host_name").alias("host_name")).distinct()
    web_stats = rate_per_slot(hits, "log_time", ["host_name"], SECOND, grain)
    web_hosts = zero_fill(web_stats, window_frame(hosts, window, grain), ["bucket", "host_name"], zeros)
    web_levels = (Level("host", ("site_id", "host_name")), Level("site", ("site_id",)))
    return {
        "tps_router": rollup_entity(routers, router_levels, RATE_RULES),
        "tps_web": rollup_entity(web_hosts, web_levels, RATE_RULES),
    }


def _host_samples(lake: Lake, name: str, window: Window, grain: Grain) -> DataFrame:
    return lake.raw(name, window.begin, window.end).select(
        grain.bucket("sample_time").alias("bucket"),
        "sample_time",
        F.col("host").alias("host_name"),
        F.col("plugin_instance").alias("mount"),
        "type_instance",
        # Decimals: a sum is the same whatever order its tasks end in.
        F.col("values").try_cast("decimal(28,9)").alias("value"),
        "values",
    )


def _hosts(lake: Lake) -> DataFrame:
    return lake.dim("servers").select("site_id", F.upper("host_name").alias("host_name")).distinct()


def _host_gauge(lake: Lake, name: str, window: Window, grain: Grain, categories: dict[str, str]) -> DataFrame:
    samples = _host_samples(lake, name, window, grain).filter(F.col("type_instance").isin(*categories))
    stats = gauge(
        samples, ["bucket", "host_name"], by_category("type_instance", F.col("value"), categories)
    )
    stats = stats.withColumns({c: F.col(c).cast("double") for c in stats.columns if c.startswith(("min_", "max_"))})
    frame = window_frame(_hosts(lake), window, grain)
    return zero_fill(stats, frame, ["bucket", "host_name"], gauge_zeros(list(categories.values())))


def hosts(lake: Lake, window: Window, grain: Grain = MINUTE) -> Tables:
    """CPU, memory and disk of every host."""
    samples = _host_samples(lake, "disk", window, grain)
    stats = last_sample(
        samples, ["bucket", "host_name", "mount"], "type_instance", "value", ["sample_time", "values"], DISK_CATEGORIES
    )
    frame = window_frame(_hosts(lake), window, grain)
    disk = frame.join(stats, ["bucket", "host_name"], "left").withColumns(
        {
            "mount": F.coalesce("mount", F.lit(EMPTY)),
            "free": F.coalesce("free", F.lit(0.0)),
            "used": F.coalesce("used", F.lit(0.0)),
        }
    )
    return {
        "cpu": _host_gauge(lake, "cpu", window, grain, CPU_CATEGORIES),
        "mem": _host_gauge(lake, "mem", window, grain, MEMORY_CATEGORIES),
        "disk": disk,
    }


def _port_table(lake: Lake, window: Window, grain: Grain, kind: Column, by: list[str]) -> DataFrame:
    """Traffic of the ports of one kind.  The dimension is filtered before the join."""
    samples = lake.raw("network", window.begin, window.end).select(
        grain.bucket("sample_time").alias("bucket"),
        F.col("host").alias("switch_name"),
        port_number(F.col("type_instance")).cast("string").alias("port_id"),
        pair_value(F.col("values"), 0).alias("rx"),
        pair_value(F.col("values"), 1).alias("tx"),
    )
    ports = lake.dim("ports").filter(kind).withColumn("switch_name", F.upper("switch_name"))
    keys = ["bucket", "switch_name", "port_id"]
    frame = window_frame(ports, window, grain)
    return port_gauge(port_parts(samples, keys), keys, frame, ["bucket", "site_id", *by])


def switches(lake: Lake, window: Window, grain: Grain = MINUTE) -> Tables:
    uplink = F.col("port_type") == UPLINK
    return {
        "network": _port_table(lake, window, grain, ~uplink, ["switch_name", "port_id"]),
        "uplink": _port_table(lake, window, grain, uplink, ["switch_name"]),
    }


JOBS: dict[str, Callable[..., Tables]] = {
    "route": route,
    "status": status,
    "session": session,
    "uvpv": uvpv,
    "uvpv_sketch": uvpv_sketch,
    "ccu": ccu,
    "usetime": usetime,
    "bandwidth": bandwidth,
    "probe": probe,
    "web": web,
    "tps": tps,
    "hosts": hosts,
    "switches": switches,
}
# Jobs whose tables lack rows where nothing happened.
SPARSE_TABLES = {"usetime", "uvpv_sketch"}
