"""Which statistics roll up to hour, day and month, and how."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from opslog.operators.histogram import long_bins, short_bins
from opslog.operators.outcomes import WEB_RULES, probe_rules
from opslog.operators.rollup import rollup_entity, rollup_time, shares
from opslog.plans.lake import Lake
from opslog.plans.minute import IDS, LEVELS, PAIR_RULES, RATE_RULES, usetime_long, uvpv
from opslog.spec import DAY, HOUR, MINUTE, MONTH, Grain, Rule, Window, gauge_rules, high, low, mean, sketch, total

LEVEL_KEYS = ["level", *IDS]
LONG = [b.name for b in long_bins()]
SHORT_RULES = [total("total_cnt"), *[total(b.name) for b in short_bins()]]
LONG_RULES = [total("total_cnt"), *[total(b) for b in LONG]]

# Table -> entity columns and rules.
ROLLUPS: dict[str, tuple[list[str], list[Rule]]] = {
    "route": (LEVEL_KEYS, PAIR_RULES),
    "route_router": (["router_id"], PAIR_RULES),
    "status": (LEVEL_KEYS, PAIR_RULES),
    "status_router": (["router_id"], PAIR_RULES),
    "session": (LEVEL_KEYS, gauge_rules("session")),
    "uvpv": (LEVEL_KEYS, [total("uv"), total("pv")]),
    "uvpv_sketch": (LEVEL_KEYS, [sketch("uv_sketch"), total("pv")]),
    "ccu": (LEVEL_KEYS, gauge_rules("ccu")),
    "usetime": (LEVEL_KEYS, SHORT_RULES),
    "usetime_long": (LEVEL_KEYS, LONG_RULES),
    "bandwidth": (LEVEL_KEYS, [mean("avg_mbps", 2), low("min_mbps"), high("max_mbps")]),
    "probe": (LEVEL_KEYS, probe_rules()),
    "web": (LEVEL_KEYS, WEB_RULES),
    "cpu": (["site_id", "host_name"], gauge_rules("user", "system", "idle")),
    "mem": (["site_id", "host_name"], gauge_rules("used")),
    "disk": (["site_id", "host_name", "mount"], [low("free"), high("used")]),
    "network": (["site_id", "switch_name", "port_id"], gauge_rules("rx_bps", "tx_bps")),
    "uplink": (["site_id", "switch_name"], gauge_rules("rx_bps", "tx_bps")),
    "tps_router": (["level", "site_id", "router_id"], RATE_RULES),
    "tps_web": (["level", "site_id", "host_name"], RATE_RULES),
}
# The hour values of these come from raw rows: uniques do not add up over minutes.
FROM_RAW = {"uvpv": uvpv, "usetime_long": usetime_long}
FINER = {HOUR: MINUTE, DAY: HOUR, MONTH: DAY}


def roll(
    lake: Lake, table: str, to: Grain, begin: datetime, end: datetime, exact: bool = False
) -> DataFrame:
    """The ``to`` values of ``[begin, end)``.  ``exact`` recomputes uniques from raw rows."""
    keys, rules = ROLLUPS[table]
    if table in FROM_RAW and (to == HOUR or exact):
        return FROM_RAW[table](lake, Window(begin, end, begin, end), to)[table]
    stats = lake.stat(table, FINER[to], begin, end)
    if table == "bandwidth":
        # Every level comes from the server rows.
        return _bandwidth(stats, to, rules)
    out = rollup_time(stats, to, keys, rules)
    return shares(out, LONG, "total_cnt") if table == "usetime_long" else out


def _bandwidth(stats: DataFrame, to: Grain, rules: list[Rule]) -> DataFrame:
    if to != HOUR:
        return rollup_time(stats, to, LEVEL_KEYS, rules)
    servers = stats.filter("level = 'server'").drop("level").withColumn("bucket", to.bucket("bucket"))
    return rollup_entity(servers, LEVELS, rules)
