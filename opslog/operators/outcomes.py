"""Outcome counters: quality-probe tests and web responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.functions.measures import count_when
from opslog.spec import Rule, percent, ratio, total

# Probe result, cause words, web codes.
PROBE_OK = "OK"
PROBE_CAUSES = {
    "low_psnr": "PSNR",
    "no_codec": "Codec",
    "no_video": "Video",
    "connect_fail": "Connect",
}
WEB_OK = "200"
WEB_NOT_MODIFIED = "304"


def probe_outcome(
    tests: DataFrame,
    keys: Sequence[str],
    ok: str = PROBE_OK,
    causes: dict[str, str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Tests, successes, failures, rate and one counter per cause word in ``detail``.

    Causes count whether or not the test failed.  ``strict`` also asks a
    successful test to have an empty detail.
    """
    causes = PROBE_CAUSES if causes is None else causes
    passed = F.col("result") == ok
    if strict:
        passed = passed & (F.coalesce(F.col("detail"), F.lit("")) == "")
    n, s = F.count(F.lit(1)), count_when(passed)
    return tests.groupBy(*keys).agg(
        n.alias("test_cnt"),
        s.alias("success_cnt"),
        (n - s).alias("fail_cnt"),
        percent(s, n).alias("success_rate"),
        *[count_when(F.col("detail").contains(word)).alias(name) for name, word in causes.items()],
    )


def probe_rules(causes: Sequence[str] = tuple(PROBE_CAUSES)) -> list[Rule]:
    return [
        total("test_cnt"),
        total("success_cnt"),
        total("fail_cnt"),
        ratio("success_rate", "success_cnt", "test_cnt"),
        *[total(c) for c in causes],
    ]


def web_outcome(
    requests: DataFrame, keys: Sequence[str], code: str = "ret_code", size: Column | None = None,
    unit: int = 1024,
) -> DataFrame:
    """Requests by response code; a missing code is neither a success nor a failure."""
    size = F.col("bytes") if size is None else size
    ok, same = F.col(code) == WEB_OK, F.col(code) == WEB_NOT_MODIFIED
    n, s = F.count(F.lit(1)), count_when(ok | same)
    return requests.groupBy(*keys).agg(
        n.alias("req_cnt"),
        s.alias("success_cnt"),
        count_when(ok).alias("c200_cnt"),
        count_when(same).alias("c304_cnt"),
        count_when(~ok & ~same).alias("fail_cnt"),
        percent(s, n).alias("success_rate"),
        (F.coalesce(F.sum(size), F.lit(0)).cast("double") / unit).alias("data_size"),
    )


WEB_RULES = [
    total("req_cnt"),
    total("success_cnt"),
    total("c200_cnt"),
    total("c304_cnt"),
    total("fail_cnt"),
    ratio("success_rate", "success_cnt", "req_cnt"),
    total("data_size"),
]
