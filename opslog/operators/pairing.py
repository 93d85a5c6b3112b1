"""Requests paired with the row that follows them in the same conversation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.operators.sequence import next_row
from opslog.spec import percent

# How a log marks a request and a success.
REQUEST = "Request"
SUCCESS = "0"


def pair_requests(
    log: DataFrame,
    session: Sequence[str],
    order_by: Sequence[str],
    chunk: Column,
    entity_from: str = "response",
    require_entity: bool = True,
    end: Column | None = None,
) -> DataFrame:
    """Requests that were answered, with ``success`` (0/1).

    ``log`` has ``mode``, ``server_ip`` and ``result``.  The answer is the next
    row of the session, whatever it is.  ``require_entity`` drops answers without
    a server; ``entity_from`` says whose server counts.  ``end`` keeps requests
    before it, while rows after it still serve as answers.
    """
    paired = next_row(log, session, order_by, chunk, ["server_ip", "result"], "answer")
    asked = (F.col("mode") == REQUEST) & F.col("answer").isNotNull()
    if require_entity:
        asked = asked & (F.length(F.col("answer.server_ip")) > 0)
    if end is not None:
        asked = asked & (F.col(order_by[0]) < end)
    won = F.coalesce(F.col("answer.result") == SUCCESS, F.lit(False)).cast("int")
    kept = paired.filter(asked).withColumn("success", won)
    if entity_from == "response":
        kept = kept.withColumn("server_ip", F.col("answer.server_ip"))
    return kept.drop("answer")


def assume_answered(log: DataFrame, end: Column | None = None, ts: str = "log_time") -> DataFrame:
    """Every request as a success, for logs whose answers are not kept."""
    asked = F.col("mode") == REQUEST
    if end is not None:
        asked = asked & (F.col(ts) < end)
    return log.filter(asked).withColumn("success", F.lit(1))


def pair_rate(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts and success rate of paired requests."""
    n, s = F.count("success"), F.sum("success")
    return pairs.groupBy(*keys).agg(
        n.alias("req_cnt"),
        s.alias("success_cnt"),
        (n - s).alias("fail_cnt"),
        percent(s, n).alias("success_rate"),
    )


PAIR_ZEROS = {"req_cnt": 0, "success_cnt": 0, "fail_cnt": 0, "success_rate": 0.0}
