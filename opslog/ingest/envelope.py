"""What every parser shares: the JSON envelope and the split into good and bad lines.

A parser takes ``value STRING`` (a batch or a stream) and returns typed columns plus
``value`` and ``reject``: null for a good line, else why it was refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.functions.timekeys import day_part, hour_part

BAD_JSON = "json"
BAD_LINE = "line"
BAD_TIME = "time"
FEW_ARGUMENTS = "arguments"
BAD_CLIENT = "client"


def open_envelope(lines: DataFrame, *fields: str) -> DataFrame:
    """Add the envelope's text fields; they are null where the line is not JSON."""
    schema = ", ".join(f"{f} STRING" for f in fields)
    return compute_once(lines.select("value"), F.from_json("value", schema))


def compute_once(df: DataFrame, row: Column) -> DataFrame:
    """Add the fields of struct ``row`` as columns.

    As rows of a generator they are computed once.  Plain columns would be copied
    by the optimizer into every filter and column that uses them, a regular
    expression a dozen times per line.  The struct is built one step earlier, in a
    projection, where common parts of its fields are shared.
    """
    built = df.withColumn("_row", row)
    return built.select(*df.columns, F.inline_outer(F.array("_row")))


def first_reason(*checks: tuple[Column, str]) -> Column:
    """Reason of the first failed check; a check that is null counts as failed."""
    out = F.lit(None).cast("string")
    for ok, reason in reversed(checks):
        out = F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)).otherwise(out)
    return out.alias("reject")


def finish(parsed: DataFrame, time: str, columns: list[str]) -> DataFrame:
    """Add the partition columns and put everything in order."""
    return parsed.select(*columns, day_part(time), hour_part(time), "value", "reject")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject").isNull()).drop("value", "reject")


def rejected(parsed: DataFrame) -> DataFrame:
    """The quarantine: the untouched line and the reason."""
    return parsed.filter(F.col("reject").isNotNull()).select("value", "reject")
