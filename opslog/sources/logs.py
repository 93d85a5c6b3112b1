"""Text log files (batch import) and line streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslog.functions.text import client_mark, part, unwrap
from opslog.functions.timekeys import parse_time
from opslog.ingest.envelope import BAD_LINE, BAD_TIME, FEW_ARGUMENTS, first_reason
from opslog.ingest.router import ROUTE_ARGUMENTS, split_line

# A file name starts with the id of its router and an underscore; a session line is
# `[time] k=v,k=v,...` with nine values, and the end of a closed one as the tenth.
SESSION_VALUES = 9
SESSION_LINE = r"^\[([\d-]+ [\d:.]+)\] (.+)$"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with the router id of their file name."""
    return spark.read.text(path).select(
        F.substring_index(F.col("_metadata.file_name"), "_", 1).alias("router_id"), "value"
    )


def _router_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of router logs with their parts and why they are refused; lines of another kind than routing have no part here."""
    lines = read_lines(spark, path).withColumn("_p", split_line(F.col("value")))
    mode, args = F.get("_p", F.lit(2)), F.trim(F.get("_p", F.lit(4)))
    needed = F.when(mode == "Request", F.lit(ROUTE_ARGUMENTS["Request"])).otherwise(F.lit(ROUTE_ARGUMENTS["Response"]))
    known = F.size("_p") == 5
    reason = first_reason(
        (known, BAD_LINE),
        (F.size(F.split(args, ",")) >= needed, FEW_ARGUMENTS),
        (parse_time(F.get("_p", F.lit(0))).isNotNull(), BAD_TIME),
    )
    return lines.withColumn("reject", reason).filter(~known | (F.get("_p", F.lit(3)) == "Route"))


def refused_router_log(spark: SparkSession, path: str) -> DataFrame:
    """The quarantine of ``import_router_log``: router id, the untouched line and the reason; blank lines aren't lines."""
    return _refused(_router_lines(spark, path))


def _refused(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("reject").isNotNull() & (F.trim("value") != "")).select("router_id", "value", "reject")


def import_router_log(spark: SparkSession, path: str) -> DataFrame:
    """Routing lines of plain router logs; ``refused_router_log`` has those that can't be read."""
    routed = _router_lines(spark, path).filter(F.col("reject").isNull())
    mode, args = F.get("_p", F.lit(2)), F.trim(F.get("_p", F.lit(4)))
    origin = F.get("_p", F.lit(1))

    def arg(of: str, index: int):
        return F.when(mode == of, part(args, ",", index)).otherwise(F.lit(""))

    return routed.select(
        "router_id",
        parse_time(F.get("_p", F.lit(0))).alias("log_time"),
        client_mark(part(origin, "_", 1)).alias("client_mac"),
        part(origin, "_", 2).alias("client_ip"),
        mode.alias("mode"),
        F.get("_p", F.lit(3)).alias("kind"),
        unwrap(arg("Response", 2), "{").alias("server_ip"),
        arg("Request", 2).alias("app_id"),
        arg("Request", 3).alias("site_id"),
        args.alias("arguments"),
    )


def _session_lines(spark: SparkSession, path: str) -> DataFrame:
    text = F.trim(F.regexp_extract("value", SESSION_LINE, 2))
    lines = read_lines(spark, path).withColumn("_v", F.split(text, ","))
    reason = first_reason(
        (text != "", BAD_LINE),
        (F.size("_v") >= SESSION_VALUES, FEW_ARGUMENTS),
        (parse_time(F.regexp_extract("value", SESSION_LINE, 1)).isNotNull(), BAD_TIME),
    )
    return lines.withColumn("reject", reason)


def refused_session_log(spark: SparkSession, path: str) -> DataFrame:
    """The quarantine of ``import_session_log``."""
    return _refused(_session_lines(spark, path))


def import_session_log(spark: SparkSession, path: str) -> DataFrame:
    """Session lines; ``refused_session_log`` has those that can't be read."""
    pairs = _session_lines(spark, path).filter(F.col("reject").isNull())

    def at(i: int):
        return F.get(F.split(F.get("_v", F.lit(i)), "="), F.lit(1))

    return pairs.select(
        "router_id",
        parse_time(F.regexp_extract("value", SESSION_LINE, 1)).alias("log_time"),
        at(1).alias("session_id"),
        at(2).alias("log_type"),
        at(3).alias("server_ip"),
        at(4).alias("menu_path"),
        at(5).alias("motion"),
        at(6).alias("motion_value"),
        unwrap(at(7), "{").alias("client_id"),
        at(8).alias("site_id"),
        F.when(at(5) == "OFF", parse_time(at(9))).alias("off_at"),
    )


def read_stream(spark: SparkSession, source: str, options: dict[str, str], schema=None) -> DataFrame:
    """``value STRING`` lines of a Kafka topic or of a folder of files.

    Offsets live in the query's checkpoint.  With Kafka, ``startingOffsets`` names
    where a new query begins and ``failOnDataLoss=false`` goes on from the oldest
    record after the broker has dropped some.
    """
    reader = spark.readStream.format(source)
    if schema is not None:
        reader = reader.schema(schema)
    if source == "kafka":
        options = {"startingOffsets": "earliest", "failOnDataLoss": "false", **options}
    stream = reader.options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value")) if source == "kafka" else stream
