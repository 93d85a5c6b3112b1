"""Web access logs and the alert filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.functions.text import after_colon
from opslog.functions.timekeys import parse_web_time
from opslog.ingest.envelope import (
    BAD_JSON, BAD_TIME, compute_once, finish, first_reason, open_envelope,
)

# Which envelope field feeds which column; the time comes from the line.
WEB_FIELDS = {"host": "host", "server_ip": "css_ip", "ret_code": "ret_code", "bytes": "bytes"}
WEB_COLUMNS = ["log_time", "host", "server_ip", "ret_code", "bytes"]
ROUTER_WEB_COLUMNS = ["log_time", "host", "port"]


def bracket_time(line: Column, zoned: bool = False) -> Column:
    """Time between the first ``[`` and the next ``]``."""
    return parse_web_time(F.regexp_extract(line, r"\[([^\]]*)\]", 1), zoned)


def parse_web(lines: DataFrame, fields: dict[str, str] | None = None, zoned: bool = False) -> DataFrame:
    """Web requests; ``fields`` maps columns to envelope fields, a missing one is empty.

    ``zoned`` honours the offset of each line, for hosts of several zones; else the time is the wall clock it shows.
    """
    fields = WEB_FIELDS if fields is None else fields
    names = list(dict.fromkeys(fields.values()))
    opened = compute_once(
        open_envelope(lines, "message", *names), F.struct(bracket_time(F.col("message"), zoned).alias("log_time"))
    )
    shown = {}
    for column, field in fields.items():
        text = F.coalesce(F.col(field), F.lit(""))
        if column == "host":
            text = F.upper(text)
        if column == "bytes":
            text = text.try_cast("bigint")
        shown[column] = text
    parsed = opened.select(
        "log_time",
        *[c.alias(n) for n, c in shown.items()],
        "value",
        first_reason((F.col("message").isNotNull(), BAD_JSON), (F.col("log_time").isNotNull(), BAD_TIME)),
    )
    return finish(parsed, "log_time", ["log_time", *fields])


def parse_router_web(lines: DataFrame, zoned: bool = False) -> DataFrame:
    opened = open_envelope(lines, "message", "host", "type")
    shown = F.struct(bracket_time(F.col("message"), zoned).alias("log_time"))
    parsed = compute_once(opened, shown).select(
        "log_time",
        F.upper("host").alias("host"),
        after_colon(F.col("type")).alias("port"),
        "value",
        F.col("message").isNotNull().alias("is_json"),
    )
    reason = first_reason((F.col("is_json"), BAD_JSON), (F.col("log_time").isNotNull(), BAD_TIME))
    return finish(parsed.withColumn("reject", reason), "log_time", ROUTER_WEB_COLUMNS)


def alerts(lines: DataFrame, key: str, value: str) -> DataFrame:
    """Untouched lines whose JSON field ``key`` equals ``value``."""
    return lines.filter(F.get_json_object("value", f"$.{key}") == value)
