"""Stateful streams over several micro-batches: late, tied and missing rows, restarts, state that shrinks."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest

from opslog.operators.pairing import pair_requests
from opslog.operators.sequence import minute_chunk
from opslog.session import scratch_dir
from opslog.sources.logs import read_stream
from opslog.spec import MINUTE, SECOND, Level
from opslog.streaming import stateful
from opslog.streaming.aggregates import windowed
from opslog.streaming.ingest import append
from opslog.streaming.progress import ProgressTable, recorded
from pyspark.sql import functions as F
from tests.conftest import rows

T0 = datetime(2024, 3, 1, 10, 0)
LOG = "ts timestamp, id bigint, who string, mode string, server_ip string, result string"


def at(sec):
    return T0 + timedelta(seconds=sec)


def feed(spark, path, found, schema, k):
    """One file, so one micro-batch; later files are read later."""
    df = spark.createDataFrame(found, schema).coalesce(1)
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(f"{path}/{k:03d}")


def stream(spark, path, schema):
    lines = read_stream(spark, "text", {"path": f"{path}/*", "maxFilesPerTrigger": "1"})
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def ran(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def stored(spark, stats, out):
    query = ran(append(stats, f"{out}/data", f"{out}/state", True, partition_by=()))
    return query, spark.read.schema(stats.schema).parquet(f"{out}/data")


def batches(spark, parts, schema):
    path = scratch_dir(spark, "fed")
    for k, part in enumerate(parts):
        feed(spark, path, part, schema, k)
    return path


def test_pairs_equal_the_batch_with_late_tied_and_missing_answers(spark):
    ask, say = ("Request", "", ""), ("Response", "s1", "0")
    first = [
        (at(5), 1, "a", *ask), (at(5), 2, "a", *say),  # one instant: the id decides
        (at(58), 3, "b", *ask),  # answered in the next minute, by a later file
        (at(30), 4, "c", *ask),  # never answered
        (at(40), 5, "d", *ask), (at(45), 6, "d", *ask), (at(50), 7, "d", "Response", "s2", "1"),
    ]
    second = [
        (at(65), 8, "b", *say),
        (at(20), 9, "e", *ask), (at(119), 10, "e", *say),  # 99 seconds: too late for a horizon of 60
        (at(10), 11, "f", *ask),
        (at(100), 12, "g", *ask), (at(101), 13, "g", "Response", "", "1"),  # an answer without a server
    ]
    third = [(at(15), 14, "f", *say), (at(600), 15, "z", *say)]  # f's answer is out of order, within the delay
    fourth = [(at(601), 16, "z", *say)]
    fifth = [(at(31), 17, "c", *say), (at(1200), 18, "z", *say)]  # behind the watermark of the batch before: dropped
    path = batches(spark, [first, second, third, fourth, fifth], LOG)
    pairs = stateful.pair_stream(stream(spark, path, LOG), ["who"], ["ts", "id"], 60, "2 minutes")
    out = scratch_dir(spark, "pairs")
    query, found = stored(spark, pairs, out)
    whole = spark.createDataFrame([*first, *second, *third[:1]], LOG)
    batch = pair_requests(whole, ["who"], ["ts", "id"], minute_chunk("ts"))
    near = {(r["who"], r["id"], r["server_ip"], r["success"]) for r in batch.collect()} - {("e", 9, "s1", 1)}
    assert {(r["who"], r["id"], r["server_ip"], r["success"]) for r in found.collect()} == near
    assert near == {("a", 1, "s1", 1), ("b", 3, "s1", 1), ("d", 6, "s2", 0), ("f", 11, "s1", 1)}
    states = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress]
    assert max(states) > states[-1]


def test_pair_rates_close_with_their_horizon(spark):
    log = [(at(60 * m + s), 100 * m + s, "u", *(("Request", "", "") if s % 2 == 0 else ("Response", "s1", "0"))) for m in range(6) for s in range(10)]
    path = batches(spark, [log[:20], log[20:40], log[40:]], LOG)
    pairs = stateful.pair_stream(stream(spark, path, LOG), ["who"], ["ts", "id"], 60, "0 seconds")
    _, found = stored(spark, stateful.pair_rate_stream(pairs, ["server_ip"], 60), scratch_dir(spark, "rates"))
    got = {r["bucket"]: (r["req_cnt"], r["success_cnt"]) for r in found.collect()}
    assert got == {at(60 * m): (5, 5) for m in range(4)}  # minute 4 may still be answered in minute 5


VISITS = "ts timestamp, who string, server string, site string"


def test_uniques_count_a_client_once_per_level_and_state_goes(spark):
    parts = [
        [(at(1), "a", "x", "s"), (at(2), "a", "x", "s"), (at(3), "a", "y", "s"), (at(4), "b", "y", "s")],
        [(at(30), "a", "x", "s"), (at(70), "a", "x", "s")],
        [(at(59), "c", "x", "s"), (at(500), "z", "x", "s")],
        [(at(501), "z", "x", "s")],  # lateness is judged by the watermark of the batch before
        [(at(10), "late", "x", "s"), (at(900), "z", "x", "s")],
    ]
    levels = [Level("server", ("site", "server")), Level("site", ("site",))]
    path = batches(spark, parts, VISITS)
    stats = stateful.unique_stream(stream(spark, path, VISITS), "ts", "1 minute", "1 minute", levels, "who")
    query, found = stored(spark, stats, scratch_dir(spark, "uv"))
    got = {(r["bucket"], r["level"], r["server"]): (r["uv"], r["pv"]) for r in found.collect()}
    assert got == {
        (T0, "server", "x"): (2, 4), (T0, "server", "y"): (2, 2), (T0, "site", "*"): (3, 6),
        (at(60), "server", "x"): (1, 1), (at(60), "site", "*"): (1, 1),
        (at(480), "server", "x"): (1, 2), (at(480), "site", "*"): (1, 2),
    }
    states = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress]
    assert max(states) > states[-1]
    assert sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]) > 0


def test_rates_need_every_second_for_a_minimum(spark):
    full = [(at(s), "w", "x", "s") for s in range(60) for _ in range(1 + s % 3)]
    gaps = [(at(60 + s), "w", "x", "s") for s in range(0, 60, 2)]
    path = batches(spark, [full[::2], full[1::2], gaps, [(at(400), "w", "x", "s")]], VISITS)
    stats = stateful.rate_stream(stream(spark, path, VISITS), "ts", "30 seconds", ["server"], SECOND, MINUTE)
    _, found = stored(spark, stats, scratch_dir(spark, "tps"))
    assert rows(found) == [(T0, "x", 2.0, 1, 3), (at(60), "x", 0.5, 0, 1)]
    with pytest.raises(ValueError):
        stateful.rate_stream(found, "bucket", "1 second", [], SECOND, MINUTE.__class__("month", "", 6, None))


def zero_filled(spark, path, out):
    counts = windowed(stream(spark, path, VISITS), "ts", "30 seconds", "1 minute", ["server"], [F.count(F.lit(1)).alias("pv")])
    dim = spark.createDataFrame([("x",), ("y",)], "server string")
    return stateful.fill_closed(counts, dim, ["server"], {"pv": 0}, MINUTE, f"{out}/data", f"{out}/state", "views", True)


def test_zero_fill_has_each_closed_minute_once_also_after_a_restart(spark):
    path = batches(spark, [[(at(5), "a", "x", "s")], [(at(200), "a", "y", "s")], [(at(420), "b", "x", "s")]], VISITS)
    out = scratch_dir(spark, "zeros")
    ran(zero_filled(spark, path, out))
    minutes = {(r["bucket"], r["server"]): r["pv"] for r in stateful.filled(spark, f"{out}/data").collect()}
    want = {(at(60 * m), d): 0 for m in range(4) for d in "xy"} | {(T0, "x"): 1, (at(180), "y"): 1}
    assert minutes == want
    feed(spark, path, [(at(600), "a", "x", "s"), (at(1000), "z", "x", "s")], VISITS, 3)
    ran(zero_filled(spark, path, out))
    found = stateful.filled(spark, f"{out}/data")
    want = {(at(60 * m), d): 0 for m in range(11) for d in "xy"}
    want |= {(T0, "x"): 1, (at(180), "y"): 1, (at(420), "x"): 1, (at(600), "x"): 1}
    assert found.count() == len(want) and {(r["bucket"], r["server"]): r["pv"] for r in found.collect()} == want
    # All lines again under a new checkpoint: no minute is written a second time.
    again = stateful.fill_closed(
        windowed(stream(spark, path, VISITS), "ts", "30 seconds", "1 minute", ["server"], [F.count(F.lit(1)).alias("pv")]),
        spark.createDataFrame([("x",), ("y",)], "server string"), ["server"], {"pv": 0}, MINUTE, f"{out}/data", f"{out}/other", "views", True,
    )
    ran(again)
    assert stateful.filled(spark, f"{out}/data").count() == len(want)


def test_a_batch_of_zero_fill_that_is_tried_again_replaces_its_rows(spark):
    dim = spark.createDataFrame([("x",), ("y",)], "server string")
    path = scratch_dir(spark, "retry")

    def batch(*minutes):
        return spark.createDataFrame([(at(60 * m), "x", 1) for m in minutes], "bucket timestamp, server string, pv bigint")

    stateful._fill(batch(0), dim, ["server"], {"pv": 0}, MINUTE, path, "views.run.0")
    for _ in range(2):
        stateful._fill(batch(3), dim, ["server"], {"pv": 0}, MINUTE, path, "views.run.1")
    assert stateful.filled(spark, path).count() == 8
    assert stateful.high_water(dim, path) == int((at(180) - datetime(1970, 1, 1)).total_seconds())


def test_progress_is_recorded_for_every_batch(spark):
    path = batches(spark, [[(at(k), "a", "x", "s")] * (k + 1) for k in range(5)], VISITS)
    out = scratch_dir(spark, "progress")
    with ProgressTable(spark, f"{out}/table") as table:
        query = append(stream(spark, path, VISITS), f"{out}/data", f"{out}/state", True, partition_by=())
        table.wait(query)
    found = recorded(spark, f"{out}/table").collect()
    assert sorted(r["n_rows"] for r in found) == [1, 2, 3, 4, 5] and len({r["batch"] for r in found}) == 5
    assert all(r["started"] is not None and r["batch_millis"] >= 0 and r["run"] == str(query.runId) for r in found)
    assert json.dumps([r["stream"] for r in found])
