"""Session logs (on, off, bandwidth) and quality-probe results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.functions.text import client_mark, looks_like_mac, unwrap
from opslog.functions.timekeys import parse_time
from opslog.ingest.envelope import (
    BAD_CLIENT, BAD_JSON, BAD_LINE, BAD_TIME, FEW_ARGUMENTS, compute_once, finish, first_reason, open_envelope,
)

# Motions that are not sessions, and the order of the values in a line.
IGNORED_MOTIONS = ["20", "SESSION_USE"]
PAIR = "(^|,)[^=,]*(=([^=,]*))?[^,]*"
SESSION_COLUMNS = [
    "registered_at", "session_id", "log_type", "server_ip", "menu_path", "motion", "motion_value",
    "client_id", "site_id", "off_at",
]
PROBE_COLUMNS = [
    "test_no", "test_time", "probe_id", "server_ip", "client_id", "result", "psnr", "err_cnt",
    "nv_err_cnt", "detail", "sub_app_id",
]


def pair_values(text: Column) -> Column:
    """Values of ``k=v,k=v,...`` by position, the empty text where ``v`` is missing."""
    return F.split(F.regexp_replace(text, PAIR, "$1$3"), ",")


def parse_session(lines: DataFrame, debug: bool = False) -> DataFrame:
    opened = open_envelope(lines, "message").withColumn("_v", pair_values(F.col("message")))

    def at(i: int) -> Column:
        return F.trim(F.get("_v", F.lit(i)))

    client = client_mark(at(7))
    when = parse_time(at(0))
    reason = first_reason(
        (F.col("message").isNotNull(), BAD_JSON),
        (F.size("_v") >= 9, FEW_ARGUMENTS),
        (when.isNotNull(), BAD_TIME),
        (F.lit(debug) | looks_like_mac(client), BAD_CLIENT),
    )
    parsed = F.struct(
        when.alias("registered_at"),
        at(1).alias("session_id"),
        at(2).alias("log_type"),
        at(3).alias("server_ip"),
        at(4).alias("menu_path"),
        at(5).alias("motion"),
        at(6).try_cast("double").alias("motion_value"),
        client.alias("client_id"),
        at(8).alias("site_id"),
        F.when(at(5) == "OFF", parse_time(at(9))).alias("off_at"),
        reason,
    )
    wanted = compute_once(opened, parsed).filter(~F.coalesce("motion", F.lit("")).isin(IGNORED_MOTIONS))
    return finish(wanted, "registered_at", SESSION_COLUMNS)


def parse_probe(lines: DataFrame) -> DataFrame:
    """Comma-separated probe results; the time may be quoted, the client braced."""
    opened = open_envelope(lines, "message").withColumn("_v", F.split("message", ","))

    def at(i: int) -> Column:
        return F.trim(F.get("_v", F.lit(i)))

    when = parse_time(unwrap(at(1), '"'))
    reason = first_reason(
        (F.col("message").isNotNull(), BAD_JSON),
        (F.size("_v") >= 10, BAD_LINE),
        (when.isNotNull(), BAD_TIME),
    )
    parsed = F.struct(
        at(0).alias("test_no"),
        when.alias("test_time"),
        at(2).alias("probe_id"),
        at(3).alias("server_ip"),
        unwrap(at(4), "{").alias("client_id"),
        at(5).alias("result"),
        at(6).try_cast("double").alias("psnr"),
        at(7).try_cast("int").alias("err_cnt"),
        at(8).try_cast("int").alias("nv_err_cnt"),
        at(9).alias("detail"),
        at(10).alias("sub_app_id"),
        reason,
    )
    return finish(compute_once(opened, parsed), "test_time", PROBE_COLUMNS)
