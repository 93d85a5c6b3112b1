"""Router logs: routing and status messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.functions.text import after_colon, client_mark, looks_like_mac, unwrap
from opslog.functions.timekeys import parse_time
from opslog.ingest.envelope import (
    BAD_CLIENT, BAD_JSON, BAD_LINE, BAD_TIME, FEW_ARGUMENTS, compute_once, finish, first_reason, open_envelope,
)

# A line is `[level] time [origin]  -  Request|Response Route|Status Msg : (arguments)`.
LINE = (
    r"^\[[^\]]+\] ([\d-]+ [\d:.]+) \[(.+?)\]\s+-\s+(Request|Response) (Route|Status) Msg : \((.+)\)$"
)
ROUTE_ARGUMENTS = {"Request": 4, "Response": 8}
STATUS_ARGUMENTS = {"Request": 6, "Response": 2}
MARK = "\u0001"

ROUTE_COLUMNS = [
    "router_id", "router_port", "log_time", "session_id", "client_mac", "client_ip", "client_port",
    "mode", "server_ip", "app_id", "site_id", "method", "result", "result_text", "server_port",
    "width", "height", "va", "loading",
]
STATUS_COLUMNS = [
    "router_host", "router_port", "log_time", "client_mac", "server_ip", "router_session", "mode",
    "users", "session_id", "session_status", "result", "result_text",
]


def split_line(line: Column) -> Column:
    """time, origin, mode, kind and arguments of a line, in one pass of the pattern."""
    groups = MARK.join(f"${i}" for i in range(1, 6))
    return F.split(F.regexp_replace(line, LINE, groups), MARK)


def router_lines(lines: DataFrame, kind: str) -> DataFrame:
    """Lines of one kind, plus those that are not router lines at all."""
    opened = open_envelope(lines, "message", "type", "host")
    parts = opened.withColumn("_p", split_line(F.col("message")))
    known = F.size("_p") == 5
    shown = F.struct(
        F.upper("host").alias("router"),
        after_colon(F.coalesce(F.col("type"), F.lit(""))).alias("router_port"),
        F.col("message").isNotNull().alias("is_json"),
        known.alias("is_line"),
        parse_time(F.when(known, F.get("_p", F.lit(0)))).alias("log_time"),
        F.get("_p", F.lit(1)).alias("origin"),
        F.get("_p", F.lit(2)).alias("mode"),
        F.get("_p", F.lit(3)).alias("kind"),
        F.get("_p", F.lit(4)).alias("args"),
    )
    named = compute_once(parts, shown).drop("message", "type", "host", "_p")
    wanted = named.filter(~F.coalesce("is_line", F.lit(False)) | (F.col("kind") == kind))
    return wanted.withColumns({"_args": F.split("args", ","), "_from": F.split("origin", "_")})


def _enough(counts: dict[str, int]) -> Column:
    n = F.size("_args")
    return F.when(F.col("mode") == "Request", n >= counts["Request"]).otherwise(n >= counts["Response"])


def _arg(mode: str, index: int) -> Column:
    """An argument of one mode; the empty text for the other."""
    return F.when(F.col("mode") == mode, F.trim(F.get("_args", F.lit(index)))).otherwise(F.lit(""))


def _base(text: Column) -> Column:
    return F.get(F.split(text, r"\["), F.lit(0))


def _bracketed(text: Column) -> Column:
    """``a[b]`` -> ``b``, the empty text where there is no bracket."""
    inside = F.translate(F.get(F.split(text, r"\["), F.lit(1)), "]", "")
    return F.when(F.instr(text, "[") > 1, inside).otherwise(F.lit(""))


def parse_route(lines: DataFrame, debug: bool = False) -> DataFrame:
    """Routing requests and responses.  ``debug`` lets malformed client ids pass."""
    raw = router_lines(lines, "Route")
    address = F.trim(F.get("_from", F.lit(2)))
    mac = client_mark(F.trim(F.get("_from", F.lit(1))))
    reason = first_reason(
        (F.col("is_json"), BAD_JSON),
        (F.col("is_line") & mac.isNotNull() & address.isNotNull(), BAD_LINE),
        (F.col("log_time").isNotNull(), BAD_TIME),
        (F.lit(debug) | looks_like_mac(mac), BAD_CLIENT),
        (_enough(ROUTE_ARGUMENTS), FEW_ARGUMENTS),
    )
    parsed = F.struct(
        F.col("router").alias("router_id"),
        F.trim(F.get("_from", F.lit(0))).alias("session_id"),
        mac.alias("client_mac"),
        _base(address).alias("client_ip"),
        _bracketed(address).alias("client_port"),
        unwrap(_arg("Response", 2), "{").alias("server_ip"),
        _arg("Request", 2).alias("app_id"),
        _arg("Request", 3).alias("site_id"),
        _arg("Request", 1).alias("method"),
        _arg("Response", 0).alias("result"),
        _arg("Response", 1).alias("result_text"),
        _arg("Response", 3).try_cast("int").alias("server_port"),
        _arg("Response", 4).try_cast("int").alias("width"),
        _arg("Response", 5).try_cast("int").alias("height"),
        _arg("Response", 6).alias("va"),
        _arg("Response", 7).alias("loading"),
        reason,
    )
    return finish(compute_once(raw, parsed), "log_time", ROUTE_COLUMNS)


def parse_status(lines: DataFrame, debug: bool = False) -> DataFrame:
    """Status requests and responses; only requests name a client, so only they are checked for it."""
    raw = router_lines(lines, "Status")
    mac = client_mark(_arg("Request", 4))
    reason = first_reason(
        (F.col("is_json"), BAD_JSON),
        (F.col("is_line"), BAD_LINE),
        (F.col("log_time").isNotNull(), BAD_TIME),
        (_enough(STATUS_ARGUMENTS), FEW_ARGUMENTS),
        (F.lit(debug) | (F.col("mode") == "Response") | looks_like_mac(mac), BAD_CLIENT),
    )
    parsed = F.struct(
        F.col("router").alias("router_host"),
        mac.alias("client_mac"),
        unwrap(_arg("Request", 0), "{").alias("server_ip"),
        _bracketed(F.col("origin")).alias("router_session"),
        _arg("Request", 1).try_cast("int").alias("users"),
        _arg("Request", 2).alias("session_id"),
        _arg("Request", 3).alias("session_status"),
        _arg("Response", 0).alias("result"),
        _arg("Response", 1).alias("result_text"),
        reason,
    )
    return finish(compute_once(raw, parsed), "log_time", STATUS_COLUMNS)
