"""Compaction, pruned listing, sessions handed on, sketches, neighbours in one pass."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from opslog.operators.sequence import both_neighbours, minute_chunk, next_row, previous_row
from opslog.operators.uniques import client_visits, estimated
from opslog.plans import carry, compaction, minute
from opslog.plans.lake import Lake
from opslog.plans.rollups import roll
from opslog.plans.run import run_rollup, run_window
from opslog.plans.upkeep import children, drop_old_days
from opslog.session import scratch_dir
from opslog.sinks.tables import save, save_raw, save_snapshot
from opslog.sources import folders
from opslog.sources.tables import read_window
from opslog.spec import DAY, HOUR, MINUTE, MONTH, Window
from opslog.streaming.ingest import write_batch
from pyspark.sql import functions as F
from tests.conftest import rows

DAY0 = datetime(2024, 5, 1)


def raw(spark, found):
    df = spark.createDataFrame(found, "ts timestamp, id bigint")
    return df.withColumns({"dt": F.date_format("ts", "yyyyMMdd"), "hh": F.date_format("ts", "HH")})


def streamed(spark, path, count=6, hours=3):
    """Micro-batches of two sources and a batch job's rows."""
    every = []
    for b in range(count):
        found = [(DAY0 + timedelta(minutes=20 * k), 1000 * b + k) for k in range(3 * hours)]
        write_batch(raw(spark, found), path, f"{'web' if b % 3 else 'app'}.run1.{b}")
        every += [i for _, i in found]
    save_raw(raw(spark, [(DAY0, 9999)]), path, "reload")
    return sorted([*every, 9999])


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_compaction_keeps_every_row_once_before_during_and_after(spark):
    path = scratch_dir(spark, "compacted")
    want, end = streamed(spark, path), DAY0 + timedelta(days=1)
    everything = lambda: ids(read_window(spark, path, "ts", DAY0, end))
    assert everything() == want

    def fails():
        assert everything() == want  # a reader between write and switch
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        compaction.compact(spark, path, "web", DAY0, end, before_switch=fails)
    assert everything() == want  # after a crash
    assert compaction.compact(spark, path, "web", DAY0, end) == 3
    assert everything() == want  # old folders are still there
    assert compaction.sweep(spark, path, DAY0, end) == 0  # and young
    assert compaction.sweep(spark, path, DAY0, end, grace=-5) == 4 * 3 + 3
    assert everything() == want
    names = [n for n in children(spark, f"{path}/dt=20240501/hh=00")]
    assert sum("compact.web." in n for n in names) == 1 and sum("app.run1" in n for n in names) == 2 and "batch=reload" in names


def test_later_batches_and_a_second_compaction(spark):
    path = scratch_dir(spark, "again")
    want, end = streamed(spark, path), DAY0 + timedelta(hours=3)
    compaction.compact(spark, path, "web", DAY0, end)
    write_batch(raw(spark, [(DAY0, 5555)]), path, "web.run1.77")
    want = sorted([*want, 5555])
    assert ids(read_window(spark, path, "ts", DAY0, end)) == want
    assert compaction.compact(spark, path, "web", DAY0, end) == 1  # the one hour that has two folders again
    compaction.compact(spark, path, "app", DAY0, end)
    compaction.sweep(spark, path, DAY0, end, grace=-5)
    assert ids(read_window(spark, path, "ts", DAY0, end)) == want
    save_raw(raw(spark, [(DAY0, 8888)]), path, "reload")  # a batch job's rows are replaced as before
    assert ids(read_window(spark, path, "ts", DAY0, end)) == sorted([*[i for i in want if i != 9999], 8888])
    drop_old_days(spark, path, DAY0 + timedelta(days=10), 10)
    assert not children(spark, f"{path}/_manifest") and not [n for n in children(spark, path) if n.startswith("dt=")]


def test_a_range_lists_only_its_own_hours(spark, monkeypatch):
    path = scratch_dir(spark, "wide")
    save(raw(spark, [(DAY0 + timedelta(hours=h), h) for h in range(48)]), path)
    import pathlib

    root = pathlib.Path(path.removeprefix("file:"))
    for k in range(10_000):
        (root / f"dt=19{k // 24:06d}" / f"hh={k % 24:02d}").mkdir(parents=True)
    listed = []
    monkeypatch.setattr(folders, "children", lambda s, p: listed.append(p) or children(s, p))
    begin = DAY0 + timedelta(hours=22, minutes=30)
    df = read_window(spark, path, "ts", begin, begin + timedelta(hours=3))
    assert ids(df) == [23, 24, 25] and df.schema["hh"].dataType.simpleString() == "string"
    assert len(listed) <= 2 * 3 + 4 and all("dt=2024050" in p for p in listed)
    assert len(df.inputFiles()) == 4
    empty = read_window(spark, path, "ts", datetime(2030, 1, 1), datetime(2030, 1, 2))
    assert empty.columns == df.columns and empty.count() == 0


SERVERS = [("a1", "s1", "h1", "host1", "192.0.2.1", "CSS"), ("a1", "s2", "h2", "host2", "192.0.2.2", "CSS")]


@pytest.fixture(scope="module")
def lake(spark):
    lake = Lake(spark, scratch_dir(spark, "carry-lake"))
    rnd = random.Random(6)
    found = []
    for k in range(150):
        on = DAY0 + timedelta(seconds=rnd.randrange(2 * 86400))
        off = on + timedelta(seconds=rnd.choice([1, 60, 4000, 90_000, 3 * 86400]))
        found.append((on, off, f"c{k % 40}", SERVERS[k % 2][4], "OFF"))
    df = spark.createDataFrame(found, "registered_at timestamp, off_at timestamp, client_id string, server_ip string, motion string")
    save(df.withColumns({"dt": F.date_format("registered_at", "yyyyMMdd"), "hh": F.date_format("registered_at", "HH")}), lake.raw_path("session_log"))
    save_snapshot(spark.createDataFrame(SERVERS, "app_id string, site_id string, host_id string, host_name string, server_ip string, role string"), lake.dim_path("servers"))
    return lake


def test_windows_in_a_row_equal_one_pass_over_sessions_of_three_days(spark, lake):
    begin, end = DAY0, DAY0 + timedelta(days=2)
    assert carry.backfill_carried(lake, begin, end, timedelta(hours=12)) == 4
    whole = minute.ccu(lake, Window(begin, end, begin, end))["ccu"]
    columns = ["bucket", "level", "app_id", "site_id", "server_ip", "avg_ccu", "min_ccu", "max_ccu"]
    got = lake.stat("ccu", MINUTE, begin, end).select(*columns)
    assert got.exceptAll(whole.select(*columns)).count() == 0 == whole.select(*columns).exceptAll(got).count()
    # A window again: the same rows from the same border.
    again = begin + timedelta(hours=12)
    carry.run_carried(lake, Window(again, again + timedelta(hours=12), again, again))
    got = lake.stat("ccu", MINUTE, begin, end).select(*columns)
    assert got.exceptAll(whole.select(*columns)).count() == 0
    with pytest.raises(ValueError):
        carry.run_carried(lake, Window(begin, begin + timedelta(minutes=7), begin, begin))


def test_sketches_roll_up_without_the_raw_rows(spark, lake):
    begin, end = DAY0, DAY0 + timedelta(days=2)
    run_window(lake, "uvpv_sketch", Window(begin, end, begin, end))
    run_rollup(lake, "uvpv_sketch", HOUR, begin, end)
    run_rollup(lake, "uvpv_sketch", DAY, begin, end)
    months = roll(lake, "uvpv_sketch", MONTH, begin, end)
    log = lake.raw("session_log", begin, end)
    exact = {r["server_ip"]: (r["uv"], r["pv"]) for r in log.groupBy("server_ip").agg(F.count_distinct("client_id").alias("uv"), F.count("*").alias("pv")).collect()}
    found = {r["server_ip"]: (r["uv"], r["pv"]) for r in estimated(months).filter("level = 'server'").collect()}
    assert found == exact  # so few clients are counted exactly
    many = spark.range(200_000).select(F.lit(DAY0).alias("ts"), (F.col("id") % 50_000).cast("string").alias("c"), F.lit("k").alias("server_ip"), F.lit("a").alias("app_id"), F.lit("s").alias("site_id"))
    from opslog.operators.uniques import unique_sketch

    visits = client_visits(many, "ts", MINUTE, "c", ["app_id", "site_id", "server_ip"])
    uv = {r["level"]: r["uv"] for r in estimated(unique_sketch(visits, minute.LEVELS, "c")).collect()}
    assert set(uv) == {"server", "site", "app"} and all(abs(n - 50_000) <= 1_500 for n in uv.values())


def test_both_neighbours_equal_two_passes_with_fewer_sorts(spark):
    rnd = random.Random(3)
    found = [(rnd.choice("abc"), DAY0 + timedelta(seconds=rnd.randrange(900)), k) for k in range(400)]
    df = spark.createDataFrame(found, "who string, ts timestamp, id bigint")
    args = (["who"], ["ts", "id"], minute_chunk("ts"), ["id"])
    one = both_neighbours(df, *args, "n", "p")
    two = previous_row(next_row(df, *args, "n"), *args, "p")
    assert rows(one, "id", "n", "p") == rows(two, "id", "n", "p")
    sorts = [d._jdf.queryExecution().executedPlan().toString().count("Sort [") for d in (one, two)]
    assert 2 * sorts[0] <= sorts[1]


def test_requests_of_one_instant_go_to_the_same_router_whatever_the_order_of_rows(spark):
    columns = "log_time timestamp, session_id string, client_mac string, client_ip string, mode string, server_ip string, result string, router_id string, router_port string"
    found = [(DAY0 + timedelta(minutes=1), f"s{k % 3}", "m", "i", "Request", "", "", f"R{k % 2}", str(8080 + k)) for k in range(12)]
    found += [(DAY0 + timedelta(minutes=2), f"s{k}", "m", "i", "Response", "192.0.2.1", "0", "", "") for k in range(3)]
    got = []
    for seed in range(2):
        lake = Lake(spark, scratch_dir(spark, "ties"))
        random.Random(seed).shuffle(found)
        df = spark.createDataFrame(found, columns).coalesce(1)
        save(df.withColumns({"dt": F.lit("20240501"), "hh": F.lit("00")}), lake.raw_path("route_log"))
        save_snapshot(spark.createDataFrame(SERVERS, "app_id string, site_id string, host_id string, host_name string, server_ip string, role string"), lake.dim_path("servers"))
        routers = [("s1", f"R{k % 2}", str(8080 + k), str(k)) for k in range(12)]
        save_snapshot(spark.createDataFrame(routers, "site_id string, router_host string, router_port string, router_id string"), lake.dim_path("routers"))
        end = DAY0 + timedelta(minutes=5)
        tables = minute.route(lake, Window(DAY0, end, DAY0, end))
        got.append(rows(tables["route_router"].filter("req_cnt > 0"), "router_id", "req_cnt", "success_cnt"))
    assert got[0] == got[1] and sum(r[1] for r in got[0]) == 3  # the last request of each session is answered
