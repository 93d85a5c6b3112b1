"""Lines to raw tables to statistics to roll-ups, end to end on a hand-made hour."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from tests.conftest import rows

from opslog.ingest.envelope import accepted
from opslog.ingest.metrics import host_metrics, parse_samples, switch_metrics
from opslog.ingest.router import parse_route, parse_status
from opslog.ingest.sessions import parse_probe, parse_session
from opslog.ingest.web import parse_router_web, parse_web
from opslog.operators.concurrency import concurrency
from opslog.plans.lake import Lake
from opslog.plans.minute import JOBS
from opslog.plans.run import (
    backfill, dashboard, forget, publish_dashboard, retention, run_at, run_day, run_hour, run_rollup, run_window,
)
from opslog.plans.windows import WINDOWS
from opslog.session import scratch_dir
from opslog.sinks.tables import save, save_snapshot
from opslog.sources.tables import read_window
from opslog.spec import DAY, HOUR, MINUTE, MONTH, mean

BEGIN = datetime(2024, 3, 1, 10, 55)
END = datetime(2024, 3, 1, 11, 5)
MAC = "02:00:00:00:00:0"


def line(text, kind="csr:8080", host="router01", **more):
    import json

    return (json.dumps({"message": text, "host": host, "type": kind, **more}),)


def route(sec, mode, mac, args):
    return line(
        f"[ INFO ] 2024-03-01 {sec}.050 [s1_{{{MAC}{mac}}}_192.0.2.10[5000]]  -  {mode} Route Msg : ( {args} )"
    )


def status(sec, mode, args, session=77):
    return line(f"[ INFO ] 2024-03-01 {sec}.050 [198.51.100.3[{session}]]  -  {mode} Status Msg : ( {args} )")


def session(sec, motion, value, client, server, off=""):
    return line(
        f"at=2024-03-01 {sec},sid=1,kind=info,server={server},menu=m4,"
        f"motion={motion},amount={value},client={{{MAC}{client}}},site=1,end={off and '2024-03-01 ' + off}"
    )


def sample(sec, host, plugin, instance, kind, values):
    import calendar

    t = datetime.strptime("2024-03-01 " + sec, "%Y-%m-%d %H:%M:%S")
    return (
        f'[{{"values":[{values}],"dstypes":["gauge"],"dsnames":["value"],"time":{calendar.timegm(t.timetuple())},'
        f'"interval":10,"host":"{host}","plugin":"{plugin}","plugin_instance":"{instance}","type":"x",'
        f'"type_instance":"{kind}"}}]',
    )


A, B = "198.51.100.1", "198.51.100.2"


@pytest.fixture(scope="module")
def lake(spark):
    lake = Lake(spark, scratch_dir(spark, "lake"))

    def put(name, lines, parse):
        text = spark.createDataFrame(lines, "value STRING")
        save(accepted(parse(text)), lake.raw_path(name))

    put(
        "route_log",
        [
            route("10:56:10", "Request", 1, "{x}, INIT, A2, S9"),
            route("10:56:11", "Response", 1, f"0, SUCCESS, {{{A}}}, 7000, 640, 360, 0, 0"),
            route("10:59:50", "Request", 2, "{x}, INIT, A2, S9"),
            route("11:00:10", "Response", 2, f"5, FAIL, {{{B}}}, 7000, 640, 360, 0, 0"),
            route("11:01:00", "Request", 3, "{x}, INIT, A2, S9"),
            route("11:01:01", "Request", 3, "{x}, INIT, A2, S9"),
            route("11:01:02", "Response", 3, "0, SUCCESS, , 7000, 640, 360, 0, 0"),
            # Answered after the window has ended, inside the look-ahead.
            route("11:04:58", "Request", 4, "{x}, INIT, A2, S9"),
            route("11:05:20", "Response", 4, f"0, SUCCESS, {{{A}}}, 7000, 640, 360, 0, 0"),
        ],
        parse_route,
    )
    put(
        "status_log",
        [
            status("10:56:00", "Request", f"{{{A}}}, 7, 9001, OPEN, {{{MAC}1}}, , "),
            status("10:56:01", "Response", "0, SUCCESS"),
            status("10:56:30", "Request", f"{{{A}}}, 9, 9001, OPEN, {{{MAC}1}}, , "),
            status("10:56:31", "Response", "3, FAIL"),
            status("11:02:00", "Request", f"{{{B}}}, 5, 9001, CLOSE, {{{MAC}1}}, , "),
        ],
        parse_status,
    )
    put(
        "session_log",
        [
            session("10:40:00", "OFF", 5, 1, A, "10:57:30"),
            session("10:57:10", "OFF", 5, 1, A, "10:57:40"),
            session("10:57:20", "OFF", 5, 1, B, "10:57:50"),
            session("10:57:20", "OFF", 5, 2, A, "10:57:20"),
            session("11:01:00", "OFF", 5, 3, "203.0.113.9", "11:02:10"),
            session("11:03:00", "BW", 7864320 * 3, 1, A),
            session("11:03:30", "BW", 7864320, 1, A),
            session("11:03:40", "20", 1, 1, A),
        ],
        parse_session,
    )
    put(
        "probe_log",
        [
            line(f'1,"2024-03-01 10:56:02",9,{A},{{{MAC}1}},FAIL,20.1,1,0,Low PSNR,5'),
            line(f'2,"2024-03-01 10:56:12",9,{A},{{{MAC}1}},OK,20.1,1,0,Video ok,5'),
        ],
        parse_probe,
    )
    hit = '192.0.2.10 - - [01/Mar/2024:{} +0900] "GET / HTTP/1.1" 200 512'
    put(
        "web_log",
        [
            line(hit.format("10:56:02"), host="web01", css_ip="198.51.100.8", ret_code=c, bytes="1024")
            for c in ("200", "200", "304", "404")
        ],
        parse_web,
    )
    put(
        "router_web_log",
        [line(hit.format(f"10:56:{s:02d}")) for s in range(60)] + [line(hit.format("11:00:00"))] * 3,
        parse_router_web,
    )
    samples = accepted(
        parse_samples(
            spark.createDataFrame(
                [
                    sample("10:56:01", "css01", "cpu", "0", "user", 10),
                    sample("10:56:11", "css01", "cpu", "0", "user", 30),
                    sample("10:56:11", "css01", "cpu", "0", "idle", "70.5"),
                    sample("10:56:11", "css01", "memory", "", "used", 40),
                    sample("10:56:01", "css01", "df", "var-log", "free", 5),
                    sample("10:56:41", "css01", "df", "var-log", "free", 4),
                    sample("10:56:41", "css01", "df", "var-log", "used", 6),
                    sample("10:56:01", "sw1", "snmp", "", "Port 3", "100,200"),
                    sample("10:56:31", "sw1", "snmp", "", "Port 3", "201,400"),
                    sample("10:56:31", "sw1", "snmp", "", "GigabitEthernet1_0_1", "50,60"),
                    sample("10:56:31", "sw1", "snmp", "", "Link 1", "999,999"),
                ],
                "value STRING",
            )
        )
    )
    for name, part in host_metrics(samples).items():
        save(part, lake.raw_path(name))
    save(switch_metrics(samples), lake.raw_path("network"))
    save_snapshot(
        spark.createDataFrame(
            [
                ("app1", "site1", "1", "css01", A, "CSS"),
                ("app1", "site2", "2", "css02", B, "CSS"),
                ("app1", "site1", "3", "web01", "198.51.100.8", "WEB"),
            ],
            "app_id STRING, site_id STRING, host_id STRING, host_name STRING, server_ip STRING, role STRING",
        ),
        lake.dim_path("servers"),
    )
    save_snapshot(
        spark.createDataFrame([("site1", "ROUTER01", "8080", "r1")], ["a", "b", "c", "d"]), lake.dim_path("routers")
    )
    save_snapshot(
        spark.createDataFrame(
            [("site1", "9", "sw1", "3", "D"), ("site1", "9", "sw1", "4", "D"), ("site1", "9", "sw1", "1", "U"),
             ("site1", "9", "sw1", "2", "U")],
            ["a", "b", "c", "d", "e"],
        ),
        lake.dim_path("ports"),
    )
    return lake


def window(job):
    return WINDOWS[{"switches": "hosts"}.get(job, job)].between(BEGIN, END)


def stats(lake, job, table, level=None, measures=(), keys=()):
    """Rows of a job's table that are not all zero."""
    df = JOBS[job](lake, window(job))[table]
    if level:
        df = df.filter(df.level == level)
    df = df.withColumn("at", MINUTE.key("bucket").substr(9, 4))
    found = [r for r in df.collect()]
    return sorted(
        tuple(r[c] for c in ("at", *keys, *measures)) for r in found if any(r[m] for m in measures)
    )


def test_route_pairs(lake):
    cols = ("req_cnt", "success_cnt", "fail_cnt", "success_rate")
    assert stats(lake, "route", "route", "server", cols, ["server_ip"]) == [
        ("1056", A, 1, 1, 0, 100.0),
        ("1059", B, 1, 0, 1, 0.0),
        ("1104", A, 1, 1, 0, 100.0),
    ]
    assert stats(lake, "route", "route", "app", cols, ["app_id"])[1] == ("1059", "app1", 1, 0, 1, 0.0)
    assert [r[:3] for r in stats(lake, "route", "route_router", None, cols, ["router_id"])] == [
        ("1056", "r1", 1), ("1059", "r1", 1), ("1104", "r1", 1),
    ]


def test_status_pairs_and_session_gauge(lake):
    assert stats(lake, "status", "status", "site", ("req_cnt", "success_cnt", "fail_cnt"), ["site_id"]) == [
        ("1056", "site1", 2, 1, 1)
    ]
    gauges = ("avg_session", "min_session", "max_session")
    assert stats(lake, "session", "session", "server", gauges, ["server_ip"]) == [("1056", A, 8.0, 7, 9)]
    # The site has one server, the app two: the silent one counts as 0.
    assert stats(lake, "session", "session", "app", gauges, ["app_id"]) == [("1056", "app1", 4.0, 0, 9)]


def test_zero_fill_is_complete(lake):
    table = JOBS["route"](lake, window("route"))["route"]
    assert table.filter("level = 'server'").count() == 10 * 2
    assert table.filter("level = 'app'").count() == 10
    assert JOBS["web"](lake, window("web"))["web"].filter("level = 'server'").count() == 10


def test_uvpv(lake):
    assert stats(lake, "uvpv", "uvpv", "server", ("uv", "pv"), ["server_ip"]) == [("1057", A, 2, 2), ("1057", B, 1, 1)]
    assert stats(lake, "uvpv", "uvpv", "app", ("uv", "pv"), ["app_id"]) == [("1057", "app1", 2, 3)]


def test_ccu(lake):
    cols = ("avg_ccu", "min_ccu", "max_ccu")
    # The 10:40 session is on from before the window until :30, the next one of the
    # same client goes on until :40; the two never count twice.
    assert stats(lake, "ccu", "ccu", "server", cols, ["server_ip"]) == [
        ("1055", A, 1.0, 1, 1),
        ("1056", A, 1.0, 1, 1),
        ("1057", A, 40 / 60, 0, 1),
        ("1057", B, 0.5, 0, 1),
    ]
    assert stats(lake, "ccu", "ccu", "app", cols, ["app_id"])[2] == ("1057", "app1", 50 / 60, 0, 1)


def test_usetime(lake):
    assert stats(lake, "usetime", "usetime", "server", ("total_cnt", "c30_sec", "other"), ["app_id", "server_ip"]) == [
        ("1057", "app1", A, 1, 1, 0),
        ("1057", "app1", B, 1, 1, 0),
        ("1101", "999", "203.0.113.9", 1, 0, 1),
    ]


def test_bandwidth_probe_web(lake):
    assert stats(lake, "bandwidth", "bandwidth", "app", ("avg_mbps", "min_mbps", "max_mbps")) == [
        ("1103", 2.0, 1.0, 3.0)
    ]
    probe = ("test_cnt", "success_cnt", "fail_cnt", "success_rate", "low_psnr", "no_codec", "no_video")
    assert stats(lake, "probe", "probe", "server", probe) == [("1056", 2, 1, 1, 50.0, 1, 0, 1)]
    web = ("req_cnt", "success_cnt", "c200_cnt", "c304_cnt", "fail_cnt", "success_rate", "data_size")
    assert stats(lake, "web", "web", "server", web) == [("1056", 4, 3, 2, 1, 1, 75.0, 4.0)]


def test_tps(lake):
    cols = ("avg_tps", "min_tps", "max_tps")
    assert stats(lake, "tps", "tps_router", "router", cols, ["router_id"]) == [
        ("1056", "r1", 1.0, 1, 1),
        ("1100", "r1", 0.05, 0, 3),
    ]
    # Averages of averages keep twelve digits.
    assert stats(lake, "tps", "tps_web", "host", cols, ["host_name"]) == [("1056", "WEB01", round(4 / 60, 12), 0, 4)]


def test_hosts_and_switches(lake):
    assert stats(lake, "hosts", "cpu", None, ("avg_user", "max_user", "avg_idle"), ["host_name"]) == [
        ("1056", "CSS01", 20.0, 30.0, 70.5)
    ]
    assert stats(lake, "hosts", "mem", None, ("avg_used",), ["host_name"]) == [("1056", "CSS01", 40.0)]
    disk = JOBS["hosts"](lake, window("hosts"))["disk"]
    assert rows(disk.filter("mount <> 'empty'"), "host_name", "mount", "free", "used") == [
        ("CSS01", "var/log", 4.0, 6.0)
    ]
    assert disk.filter("mount = 'empty'").count() == 29
    net = ("avg_rx_bps", "min_rx_bps", "max_rx_bps", "avg_tx_bps")
    assert stats(lake, "switches", "network", None, net, ["port_id"]) == [("1056", "3", 150, 100, 201, 300)]
    # Two uplink ports, one of them silent: one sample of 0 joins the average.
    assert stats(lake, "switches", "uplink", None, net, ["switch_name"]) == [("1056", "SW1", 25, 0, 50, 30)]


def test_write_rerun_rollup_and_upkeep(lake, spark):
    for job in ("uvpv", "ccu", "bandwidth", "usetime"):
        run_window(lake, job, window(job))
    before = lake.spark.read.parquet(lake.stat_path("uvpv", MINUTE)).count()
    assert backfill(lake, "uvpv", BEGIN, END, timedelta(minutes=5)) == 2
    again = lake.spark.read.parquet(lake.stat_path("uvpv", MINUTE))
    assert again.count() == before == 10 * (2 + 2 + 1)
    assert run_at(lake, "uvpv", datetime(2024, 3, 1, 11, 37)) == ["uvpv"]  # 11:00 to 11:05
    assert spark.read.parquet(lake.stat_path("uvpv", MINUTE)).count() == before

    with pytest.raises(ValueError):
        run_window(lake, "uvpv", WINDOWS["uvpv"].between(BEGIN, END - timedelta(minutes=1)))

    board = rows(dashboard(lake, BEGIN, END))
    assert board == [("app1", 0, 0, 0, 0), ("app1_site1", 0, 0, 0, 0), ("app1_site2", 0, 0, 0, 0)]
    path = f"{lake.root}/dashboard"
    for minute in (1, 2):
        publish_dashboard(lake, BEGIN, END, path, datetime(2024, 3, 1, 12, minute))
    latest = spark.read.csv(f"{path}/version=20240301120200", sep="|")
    assert latest.count() == 3

    run_hour(lake, datetime(2024, 3, 1, 12, 30), ["uvpv", "ccu", "bandwidth", "usetime"])  # hour 10
    hour = spark.read.parquet(lake.stat_path("uvpv", HOUR))
    assert rows(hour.filter("level = 'app'"), "stat_key", "uv", "pv") == [("2024030110", 2, 4)]
    ccu = spark.read.parquet(lake.stat_path("ccu", HOUR)).filter("level = 'app'").first()
    assert ccu["max_ccu"] == 1 and ccu["min_ccu"] == 0 and abs(ccu["avg_ccu"] - (2 + 50 / 60) / 5) < 1e-6
    run_hour(lake, datetime(2024, 3, 1, 13, 30), ["uvpv", "ccu"])  # hour 11
    run_day(lake, datetime(2024, 3, 2), ["uvpv"])
    day = spark.read.parquet(lake.stat_path("uvpv", DAY)).filter("level = 'app'").first()
    assert (day["stat_key"], day["uv"], day["pv"]) == ("20240301", 2, 4)
    run_rollup(lake, "uvpv", DAY, datetime(2024, 3, 1), datetime(2024, 3, 2), exact=True)
    run_rollup(lake, "uvpv", MONTH, datetime(2024, 3, 1), datetime(2024, 4, 1))
    assert spark.read.parquet(lake.stat_path("uvpv", MONTH)).count() == 5

    assert forget(lake, HOUR, "2024030110") == 4
    assert {r[0] for r in spark.read.parquet(lake.stat_path("uvpv", HOUR)).select("stat_key").collect()} == {
        "2024030111"
    }
    with pytest.raises(ValueError):
        forget(lake, HOUR, "20240301")
    assert retention(lake, datetime(2024, 3, 5)) == 0
    assert retention(lake, datetime(2024, 9, 30)) > 10


@pytest.mark.parametrize("zone", ["UTC", "Asia/Seoul", "Asia/Kolkata"])
def test_windows_and_buckets_follow_the_session_zone(spark, zone):
    """A wall-clock window finds its wall-clock rows, and days start at the zone's midnight."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        path = scratch_dir(spark, "zone")
        rows_ = spark.sql("SELECT timestamp'2024-03-05 10:57:10' AS ts, '20240305' AS dt, '10' AS hh")
        rows_.write.partitionBy("dt", "hh").parquet(path)
        assert read_window(spark, path, "ts", datetime(2024, 3, 5, 10, 55), datetime(2024, 3, 5, 11, 5)).count() == 1
        assert read_window(spark, path, "ts", datetime(2024, 3, 5, 10, 55), datetime(2024, 3, 5, 10, 57)).count() == 0
        one = spark.sql("SELECT 'e' AS e, 'c' AS c, timestamp'2024-03-05 23:00:00' AS a, timestamp'2024-03-06 01:30:00' AS b")
        for grain, want in (
            (DAY, [("20240305", 3600 / 86400), ("20240306", 5400 / 86400)]),
            (HOUR, [("2024030523", 1.0), ("2024030600", 1.0), ("2024030601", 0.5)]),
        ):
            got = concurrency(one, ["e"], ["c"], "a", "b", grain)
            got = [(r["k"], r["avg_ccu"]) for r in got.select(grain.key("bucket").alias("k"), "avg_ccu").orderBy("k").collect()]
            assert got == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_means_of_big_counters_do_not_overflow(spark):
    big = spark.sql("SELECT CAST(9.0e18 AS DOUBLE) AS x UNION ALL SELECT CAST(2e16 AS DOUBLE)")
    assert big.agg(mean("x").column().alias("m")).first()["m"] > 4e18
