"""Operators against brute force on small hand-made or random rows."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opslog.operators.concurrency import concurrency, concurrency_vector, segments, sessions_from_marks
from opslog.operators.dims import attach_dim, by_levels, calendar, zero_fill
from opslog.operators.histogram import closed_durations, duration_histogram, long_bins, short_bins
from opslog.operators.outcomes import probe_outcome, web_outcome
from opslog.operators.pairing import pair_requests
from opslog.operators.rate import rate_per_slot
from opslog.operators.rollup import rollup_time
from opslog.operators.sequence import minute_chunk, next_row, previous_row
from opslog.operators.snapshot import combine
from opslog.operators.uniques import client_visits, unique_total
from opslog.spec import (
    DAY, HOUR, MINUTE, MONTH, SECOND, Level, Rule, WindowSpec, gauge_rules, high, low, mean, ratio, total, weighted,
)
from tests.conftest import rows

T0 = datetime(2024, 1, 1, 10)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


# ---- neighbours -------------------------------------------------------------


@pytest.mark.parametrize("backward", [False, True])
def test_neighbours_of_a_hot_key(spark, backward):
    """One key with most rows and many rows per second still gets every neighbour."""
    rng = random.Random(1)
    data = [(i, "hot" if rng.random() < 0.8 else f"k{rng.randrange(5)}", at(rng.randrange(1200))) for i in range(600)]
    df = frame(spark, data, "id LONG, key STRING, ts TIMESTAMP")
    fn = previous_row if backward else next_row
    got = {r["id"]: r["n"] and r["n"]["id"] for r in fn(df, ["key"], ["ts", "id"], minute_chunk("ts"), ["id"], "n").collect()}
    per_key = defaultdict(list)
    for i, key, ts in sorted(data, key=lambda r: (r[2], r[0])):
        per_key[key].append(i)
    want = {}
    for ids in per_key.values():
        ids = ids[::-1] if backward else ids
        want.update(zip(ids, [*ids[1:], None]))
    assert got == want


def test_next_row_sorts_by_chunk_not_by_key(spark):
    """The plan has no window over the whole rows of a key."""
    df = frame(spark, [(1, "a", T0)], "id LONG, key STRING, ts TIMESTAMP")
    plan = next_row(df, ["key"], ["ts", "id"], minute_chunk("ts"), ["id"])._jdf.queryExecution().optimizedPlan().toString()
    wide = [l for l in plan.splitlines() if "Window [" in l and "_chunk" not in l.split("], [")[1]]
    assert len(wide) == 1  # the one over chunk edges
    below = plan[plan.index(wide[0]) + len(wide[0]):]
    assert below.lstrip(" +-:\n").startswith(("Filter isnull", "Project"))


# ---- pairing ----------------------------------------------------------------


def pair(spark, log, **options):
    df = frame(spark, log, "s STRING, ts TIMESTAMP, n INT, mode STRING, server_ip STRING, result STRING")
    out = pair_requests(df, ["s"], ["ts", "n"], minute_chunk("ts"), **options)
    return rows(out, "n", "server_ip", "success")


def test_pairing_cases(spark):
    log = [
        ("a", at(0), 1, "Request", "", ""),
        ("a", at(1), 2, "Request", "", ""),  # a request follows: no server, not counted
        ("a", at(61), 3, "Response", "s1", "0"),
        ("b", at(5), 4, "Response", "s1", "0"),  # an answer first
        ("b", at(6), 5, "Request", "", ""),  # nothing follows
        ("c", at(7), 6, "Request", "", ""),
        ("c", at(7), 7, "Response", "", "0"),  # same time, no server
        ("d", at(9), 8, "Request", "q", ""),
        ("d", at(200), 9, "Response", "s2", "7"),
    ]
    assert pair(spark, log) == [(2, "s1", 1), (8, "s2", 0)]
    assert pair(spark, log, require_entity=False, entity_from="request") == [
        (1, "", 0), (2, "", 1), (6, "", 1), (8, "q", 0),
    ]
    assert pair(spark, log, end=F.lit(at(5))) == [(2, "s1", 1)]


# ---- concurrency ------------------------------------------------------------


def brute(sessions, bucket):
    """Users per (entity, second), then per bucket."""
    active = defaultdict(set)
    for entity, client, on, off in sessions:
        for s in range(on, off):
            active[entity, s].add(client)
    out = defaultdict(lambda: [0] * bucket)
    for (entity, s), clients in active.items():
        out[entity, s // bucket][s % bucket] = len(clients)
    return out


def random_sessions(seed, n=120, span=9000):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        on = rng.randrange(span)
        out.append((rng.choice("aaab"), rng.choice("xyyz"), on, on + rng.choice([0, 1, 30, 59, 60, 61, 500, 4000])))
    return out


def session_frame(spark, sessions):
    base = datetime(1970, 1, 1)
    data = [(e, c, base + timedelta(seconds=a), base + timedelta(seconds=b)) for e, c, a, b in sessions]
    return frame(spark, data, "e STRING, c STRING, on_at TIMESTAMP, off_at TIMESTAMP")


@pytest.mark.parametrize("seed,grain", [(1, MINUTE), (2, HOUR), (3, DAY), (4, MINUTE)])
def test_concurrency_equals_brute_force(spark, seed, grain):
    sessions = random_sessions(seed)
    out = concurrency(session_frame(spark, sessions), ["e"], ["c"], "on_at", "off_at", grain)
    got = {}
    for r in out.collect():
        slot = int((r["bucket"] - datetime(1970, 1, 1)).total_seconds()) // grain.seconds
        got[r["e"], slot] = (r["avg_ccu"], r["min_ccu"], r["max_ccu"])
    want = {k: (sum(v) / grain.seconds, min(v), max(v)) for k, v in brute(sessions, grain.seconds).items()}
    assert {k: v for k, v in got.items() if v[2] > 0} == want


def test_vector_equals_brute_force(spark):
    sessions = random_sessions(7, 40, 1500)
    out = concurrency_vector(session_frame(spark, sessions), ["e"], ["c"], "on_at", "off_at")
    got = {}
    for r in out.collect():
        got[r["e"], int((r["bucket"] - datetime(1970, 1, 1)).total_seconds()) // 60] = list(r["seconds"])
    assert got == dict(brute(sessions, 60))


def test_hot_client_is_reduced_before_the_window(spark):
    """Many sessions of one client in one second are one row of the running window."""
    sessions = [("a", "x", 5, 6 + i % 50) for i in range(500)]
    parts = segments(session_frame(spark, sessions), ["e"], ["c"], "on_at", "off_at")
    assert [(r["sec"], r["len"], r["users"]) for r in parts.orderBy("sec").collect()][0] == (5, 50, 1)


def test_marks_to_sessions(spark):
    marks = [
        ("a", 0, "OFF"),  # nothing before: began `lookahead` earlier
        ("a", 100, "ON"), ("a", 5000, "OFF"),  # long but closed: whole
        ("b", 0, "ON"), ("b", 50, "ON"), ("b", 60, "OFF"), ("b", 70, "OFF"),
        ("c", 0, "ON"),  # never closed: times out
    ]
    df = frame(spark, [(k, at(s), m) for k, s, m in marks], "k STRING, ts TIMESTAMP, m STRING")
    out = sessions_from_marks(df, ["k"], "ts", ["ts"], minute_chunk("ts"), F.col("m") == "ON", 600, 30)
    got = sorted(
        (r["k"], int((r["on_at"] - T0).total_seconds()), int((r["off_at"] - T0).total_seconds())) for r in out.collect()
    )
    assert got == [("a", -30, 0), ("a", 100, 5000), ("b", 0, 50), ("b", 50, 60), ("b", 60, 70), ("c", 0, 600)]


# ---- counts, bins, rates ----------------------------------------------------


def test_histogram_borders(spark):
    lengths = [0, 1, 10, 11, 20, 30, 40, 50, 60, 61, 999]
    df = frame(spark, [("s", T0, at(n)) for n in lengths], "s STRING, on_at TIMESTAMP, off_at TIMESTAMP")
    out = duration_histogram(closed_durations(df, "on_at", "off_at"), ["s"], short_bins()).first()
    assert [out[c] for c in ("total_cnt", "c10_sec", "c20_sec", "c30_sec", "c60_sec", "other")] == [10, 2, 2, 1, 1, 2]


def test_long_bins_cover_every_positive_length_once():
    bins = long_bins()
    assert len(bins) == 18
    for n in [*range(1, 700), 1800, 1801, 3600, 3601]:
        assert sum(b.over < n and (b.upto is None or n <= b.upto) for b in bins) == 1


def test_probe_and_web_outcomes(spark):
    tests = [("s", "OK", ""), ("s", "OK", "Video"), ("s", "FAIL", "No Codec, Video")]
    df = frame(spark, tests, "s STRING, result STRING, detail STRING")
    r = probe_outcome(df, ["s"]).first()
    assert (r["success_cnt"], r["fail_cnt"], r["no_video"], r["no_codec"]) == (2, 1, 2, 1)
    assert probe_outcome(df, ["s"], strict=True).first()["success_cnt"] == 1
    web = frame(spark, [("s", c, 512) for c in ("200", "304", "500", None)], "s STRING, ret_code STRING, bytes LONG")
    w = web_outcome(web, ["s"]).first()
    assert (w["req_cnt"], w["success_cnt"], w["fail_cnt"], w["data_size"]) == (4, 2, 1, 2.0)


@pytest.mark.parametrize("seconds,least", [(60, 1), (59, 0)])
def test_rate_minimum_needs_every_second(spark, seconds, least):
    df = frame(spark, [("h", at(s)) for s in range(seconds)] + [("h", at(3))], "h STRING, ts TIMESTAMP")
    r = rate_per_slot(df, "ts", ["h"], SECOND, MINUTE).first()
    assert (r["avg_tps"], r["min_tps"], r["max_tps"]) == ((seconds + 1) / 60, least, 2)


# ---- levels, frames, roll-ups -----------------------------------------------

LEVELS = (Level("server", ("app_id", "site_id", "server_id")), Level("site", ("app_id", "site_id")), Level("app", ("app_id",)))


def test_uniques_do_not_add_up(spark):
    """One client on two servers; one site id shared by two apps stays two sites."""
    data = [("a", "1", "s1", "c"), ("a", "1", "s2", "c"), ("b", "1", "s3", "c"), ("b", "1", "s3", "c")]
    df = frame(spark, [(*d, T0) for d in data], "app_id STRING, site_id STRING, server_id STRING, c STRING, ts TIMESTAMP")
    visits = client_visits(df, "ts", MINUTE, "c", ["app_id", "site_id", "server_id"])
    out = rows(unique_total(visits, LEVELS, "c"), "level", "app_id", "site_id", "server_id", "uv", "pv")
    assert out == [
        ("app", "a", "*", "*", 1, 2), ("app", "b", "*", "*", 1, 2),
        ("server", "a", "1", "s1", 1, 1), ("server", "a", "1", "s2", 1, 1), ("server", "b", "1", "s3", 1, 2),
        ("site", "a", "1", "*", 1, 2), ("site", "b", "1", "*", 1, 2),
    ]
    rough = unique_total(visits, LEVELS, "c", approx=True)
    assert rows(rough, "level", "uv", "pv") == sorted((r[0], r[4], r[5]) for r in out)


def test_calendar_and_zero_fill(spark):
    dim = frame(spark, [("x", "CSS"), ("y", "WEB")], "d STRING, role STRING")
    cal = calendar(dim, datetime(2024, 1, 1, 9, 58), datetime(2024, 1, 1, 10, 3), MINUTE)
    assert cal.count() == 5 * 2  # crosses the hour without minutes 60, 61, ...
    assert calendar(dim, T0, at(60), MINUTE, role="WEB").count() == 1
    long = (datetime(2024, 1, 1, 22, 30), datetime(2024, 1, 3, 1, 15))
    spread = calendar(dim, *long, MINUTE, spread=3)
    assert rows(spread) == rows(calendar(dim, *long, MINUTE)) and spread.count() == 2 * 1605
    stats = frame(spark, [(T0, "x", 3, 1.5), (T0, "z", 9, 9.0)], "bucket TIMESTAMP, d STRING, n INT, v DOUBLE")
    keys = ["bucket", "d"]
    filled = zero_fill(stats, cal.drop("role"), keys, {"n": 0, "v": 0})
    assert filled.count() == 10 and dict(filled.dtypes)["n"] == "int"
    assert rows(filled.filter("n > 0"), "d", "n", "v") == [("x", 3, 1.5)]
    kept = zero_fill(stats, cal.drop("role"), keys, {"n": 0, "v": 0}, keep_unknown=True)
    assert rows(kept.filter("n > 0"), "d", "n") == [("x", 3), ("z", 9)]


def test_unknown_device(spark):
    facts = frame(spark, [("1", 1), ("2", 1)], "ip STRING, n INT")
    dim = frame(spark, [("1", "s")], "ip STRING, site STRING")
    assert rows(attach_dim(facts, dim, ["ip"], ["site"]), "ip", "site") == [("1", "s"), ("2", "999")]


def test_rollup_rules(spark):
    data = [(T0, "k", 1.0, 0, 4, 2, 1, 10.0, 2), (at(3600), "k", 4.0, 2, 9, 3, 3, 5.0, 3), (T0 + timedelta(days=1), "k", 1.0, 1, 1, 0, 0, 0.0, 0)]
    df = frame(spark, data, "bucket TIMESTAMP, k STRING, avg_g DOUBLE, min_g INT, max_g INT, n INT, ok INT, s DOUBLE, c INT")
    rules = [*gauge_rules("g"), total("n"), total("ok"), ratio("rate", "ok", "n"), weighted("w", "s", "c")]
    day = rows(rollup_time(df, DAY, ["k"], rules), "avg_g", "min_g", "max_g", "n", "rate", "w")
    assert day == [(1.0, 1, 1, 0, 0.0, 0.0), (2.5, 0, 9, 5, 80.0, 3.0)]
    month = rollup_time(rollup_time(df, DAY, ["k"], rules[:3]), MONTH, ["k"], rules[:3]).first()
    assert (month["avg_g"], month["min_g"], month["max_g"]) == (1.75, 0, 9)
    with pytest.raises(ValueError):
        Rule("x", "median").column()


def test_mean_of_means_is_exact(spark):
    """0.1 and 0.2 average to 0.15, whatever the order; ties round half up."""
    df = frame(spark, [(T0, "k", 0.1), (T0, "k", 0.2)], "bucket TIMESTAMP, k STRING, v DOUBLE")
    assert rollup_time(df, DAY, ["k"], [mean("v")]).first()["v"] == 0.15
    assert rollup_time(df, DAY, ["k"], [mean("v", 1)]).first()["v"] == 0.2
    assert [r.kind for r in (low("a"), high("b"))] == ["min", "max"]


def test_levels_name_their_rows(spark):
    df = frame(spark, [("a", None, "s", 1)], "app_id STRING, site_id STRING, server_id STRING, n INT")
    out = rows(by_levels(df, LEVELS, [F.sum("n").alias("n")]), "level", "site_id", "n")
    assert out == [("app", "*", 1), ("server", None, 1), ("site", None, 1)]


def test_combine_pads_missing_measures(spark):
    a = frame(spark, [("x", 1)], "k STRING, ccu LONG")
    b = frame(spark, [("x", 2), ("y", 3)], "k STRING, uv LONG")
    assert rows(combine([a, b], ["k"]), "k", "ccu", "uv") == [("x", 1, 2), ("y", 0, 3)]


def test_window_arithmetic():
    w = WindowSpec(delay=60, window=300, pre=1800, post=60).at(datetime(2024, 1, 1, 10, 7, 30))
    assert (w.begin, w.end) == (datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 10, 5))
    assert (w.read_from, w.read_to) == (datetime(2024, 1, 1, 9, 30), datetime(2024, 1, 1, 10, 6))
    with pytest.raises(ValueError):
        WindowSpec().between(T0, T0)


def test_bins_of_quarter_hours_count_the_shortest_gaps(spark):
    from opslog.operators.histogram import duration_histogram, scaled, short_bins

    gaps = spark.createDataFrame([("k", s) for s in (0, 1, 899, 9000, 9001, 54_000, 54_001)], "key string, seconds bigint")
    row = duration_histogram(gaps, ["key"], scaled(short_bins(), 900)).first().asDict()
    assert row == {"key": "k", "total_cnt": 6, "c10_sec": 3, "c20_sec": 1, "c30_sec": 0, "c40_sec": 0, "c50_sec": 0, "c60_sec": 1, "other": 1}
