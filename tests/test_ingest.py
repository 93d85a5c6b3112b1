"""Parsers on sample lines, bad lines, and the stream that must equal the batch."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opslog.functions.text import after_colon, client_mark, port_number, unwrap
from opslog.functions.timekeys import parse_time, parse_web_time, partition_predicate
from opslog.ingest.envelope import accepted, rejected
from opslog.ingest.metrics import host_metrics, parse_samples, switch_metrics
from opslog.ingest.router import parse_route, parse_status
from opslog.ingest.sessions import parse_probe, parse_session
from opslog.ingest.web import alerts, parse_router_web, parse_web
from opslog.plans.upkeep import check_key, months_back
from opslog.session import scratch_dir
from opslog.sinks.tables import merge_snapshot
from opslog.sources.logs import import_router_log, import_session_log, read_stream
from opslog.sources.tables import jdbc_options, read_jdbc
from opslog.spec import DAY, HOUR
from opslog.streaming.aggregates import progress, windowed
from opslog.streaming.ingest import append, batch_name, fan_out, ingest, one_table, switch_table, write_batch
from tests.conftest import rows

MAC = "02:00:00:00:00:0f"
ORIGIN = "k71_{02:00:00:00:00:0f}_192.0.2.10[5000]"
ROUTE_REQ = f"[ INFO ] 2023-05-06 07:08:00.051 [{ORIGIN}]  -  Request Route Msg : ( {{{MAC}}}, INIT, A2, S9 )"
ROUTE_RES = (
    f"[ INFO ] 2023-05-06 07:08:00.053 [{ORIGIN}]  -  Response Route Msg : "
    "( 0, SUCCESS, {198.51.100.3}, 7000, 640, 360, 0, 0 )"
)
STATUS_REQ = (
    "[ INFO ] 2023-05-06 07:08:00.052 [198.51.100.3[77]]  -  Request Status Msg : "
    f"( {{198.51.100.3}}, 7, 9001, OPEN, {{{MAC}}}, ,  )"
)
STATUS_RES = "[ INFO ] 2023-05-06 07:08:00.053 [198.51.100.3[77]]  -  Response Status Msg : ( 0, SUCCESS )"
SESSION = (
    "at=2023-05-06 07:08:02,sid=518,kind=info,server=198.51.100.3,menu=m4,"
    "motion=OFF,amount=5,client={02:00:00:00:00:2c},site=S9,end=2023-05-06 07:11:10"
)


def lines(spark, *texts, kind="csr:8080"):
    data = [(json.dumps({"message": t, "host": "router01", "type": kind}),) for t in texts]
    return spark.createDataFrame(data, "value STRING")


def raw(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def test_route(spark):
    out = accepted(parse_route(lines(spark, ROUTE_REQ, ROUTE_RES, STATUS_REQ)))
    req, res = sorted(out.collect(), key=lambda r: r["mode"])
    assert (req["router_id"], req["router_port"], req["session_id"]) == ("ROUTER01", "8080", "k71")
    assert (req["client_mac"], req["client_ip"], req["client_port"]) == (MAC, "192.0.2.10", "5000")
    assert (req["app_id"], req["site_id"], req["method"], req["server_ip"]) == ("A2", "S9", "INIT", "")
    assert (res["server_ip"], res["result"], res["result_text"]) == ("198.51.100.3", "0", "SUCCESS")
    assert (res["server_port"], res["width"], res["height"], res["loading"]) == (7000, 640, 360, "0")
    assert req["log_time"] == datetime(2023, 5, 6, 7, 8, 0, 51000)
    assert (req["dt"], req["hh"]) == ("20230506", "07")


def test_route_refusals(spark):
    few = ROUTE_REQ.replace(", A2, S9", "")
    short = ROUTE_REQ.replace(MAC, "02:00")
    whole = lines(spark, few, short, "nothing like a line", ROUTE_REQ.replace("2023-05-06", "2016-13-41"))
    bad = parse_route(whole.unionByName(raw(spark, "not json")))
    assert accepted(bad).count() == 0
    assert sorted(r["reject"] for r in rejected(bad).collect()) == ["arguments", "client", "json", "line", "time"]
    assert accepted(parse_route(lines(spark, short), debug=True)).count() == 1


def test_status_keeps_responses(spark):
    out = accepted(parse_status(lines(spark, STATUS_REQ, STATUS_RES, ROUTE_REQ)))
    req, res = sorted(out.collect(), key=lambda r: r["mode"])
    assert (req["server_ip"], req["users"], req["session_status"], req["router_session"]) == (
        "198.51.100.3", 7, "OPEN", "77",
    )
    assert (res["result"], res["client_mac"], res["router_session"]) == ("0", "", "77")


def test_session(spark):
    on = SESSION.replace("motion=OFF", "motion=ON")
    no_end = SESSION.split(",end")[0].replace("motion=OFF", "motion=ON")
    ignored = SESSION.replace("motion=OFF", "motion=SESSION_USE")
    number = SESSION.replace("amount=5", "amount=x")
    out = accepted(parse_session(lines(spark, SESSION, on, no_end, ignored, number))).collect()
    assert len(out) == 4
    ends = [r["off_at"] for r in out if r["motion"] == "OFF"]
    assert ends == [datetime(2023, 5, 6, 7, 11, 10)] * 2
    assert all(r["off_at"] is None for r in out if r["motion"] == "ON")
    assert sorted(str(r["motion_value"]) for r in out) == ["5.0", "5.0", "5.0", "None"]
    assert {r["client_id"] for r in out} == {"02:00:00:00:00:2c"}


def test_probe_and_web(spark):
    probe = '1,"2023-05-06 07:08:02",9,198.51.100.3,{02:00:00:00:00:2c},FAIL,20.1,1,0,Low PSNR,5'
    r = accepted(parse_probe(lines(spark, probe))).first()
    assert (r["test_time"], r["client_id"], r["psnr"], r["detail"], r["sub_app_id"]) == (
        datetime(2023, 5, 6, 7, 8, 2), "02:00:00:00:00:2c", 20.1, "Low PSNR", "5",
    )
    hit = '192.0.2.10 - - [06/May/2023:07:08:02 +0900] "GET / HTTP/1.1" 200 512'
    body = json.dumps({"message": hit, "host": "web01", "css_ip": "198.51.100.3", "ret_code": "200"})
    w = accepted(parse_web(raw(spark, body))).first()
    assert (w["log_time"], w["host"], w["ret_code"], w["bytes"]) == (datetime(2023, 5, 6, 7, 8, 2), "WEB01", "200", None)
    t = accepted(parse_router_web(lines(spark, hit, kind="web"))).first()
    assert (t["host"], t["port"]) == ("ROUTER01", "web")


def test_samples(spark):
    cpu = (
        '[{"values":[12.5],"dstypes":["gauge"],"dsnames":["value"],"time":1683356880,"interval":10,"host":"h1",'
        '"plugin":"cpu","plugin_instance":"0","type":"percent","type_instance":"user"}]'
    )
    snmp = (
        '[{"values":[100,200],"dstypes":["derive","derive"],"dsnames":["rx","tx"],"time":1683356880,"interval":60,'
        '"host":"sw1","plugin":"snmp","type":"if_octets","type_instance":"Port 3"}]'
    )
    parsed = parse_samples(raw(spark, cpu, "<13>Jan 1 00:00" + cpu, snmp, snmp.replace("Port 3", "Link 3"), "[{]"))
    assert rejected(parsed).count() == 1
    good = accepted(parsed)
    assert rows(host_metrics(good)["cpu"], "values", "host", "dt", "hh") == [("12.5", "H1", "20230506", "07")] * 2
    assert host_metrics(good)["mem"].count() == 0
    assert rows(switch_metrics(good), "values", "type_instance") == [("100,200", "Port 3")]


def test_text_helpers(spark):
    one = spark.range(1)

    def value(c):
        return one.select(c.alias("v")).first()["v"]

    assert value(unwrap(F.lit('"x"'), '"')) == "x" and value(unwrap(F.lit("x"), "{")) == "x"
    assert value(client_mark(F.lit("#{ab}"))) == "ab"
    assert value(after_colon(F.lit("a: 80"))) == "80" and value(after_colon(F.lit("a"))) == "a"
    labels = ["Port 12 up", "GigabitEthernet1_0_7", "Vlan1", "Port", "Port x"]
    assert [value(port_number(F.lit(x))) for x in labels] == [12, 7, -1, None, None]
    assert value(parse_time(F.lit("2024-01-01 07:08:01"))) == datetime(2024, 1, 1, 7, 8, 1)
    assert value(parse_time(F.lit("x"))) is None
    assert value(parse_web_time(F.lit("01/Feb/2024:10:00:00 +0900"))) == datetime(2024, 2, 1, 10)
    assert value(F.unix_seconds(parse_web_time(F.lit("01/Feb/2024:10:00:00 -0330"), True))) == 1706794200
    assert value(parse_web_time(F.lit("01/Feb/2024:10:00:00"), True)) == datetime(2024, 2, 1, 10)
    assert value(parse_web_time(F.lit("no time"), True)) is None


def test_partition_predicate_covers_every_hour(spark):
    hours = spark.sql(
        "SELECT date_format(t, 'yyyyMMdd') dt, date_format(t, 'HH') hh, t FROM "
        "(SELECT explode(sequence(timestamp'2024-01-01', timestamp'2024-01-05', interval 1 hour)) t)"
    )
    for begin, end in [
        (datetime(2024, 1, 1, 5, 10), datetime(2024, 1, 1, 7)),
        (datetime(2024, 1, 1, 22, 10), datetime(2024, 1, 4, 3, 1)),
        (datetime(2024, 1, 2), datetime(2024, 1, 3)),
    ]:
        want = hours.filter((F.col("t") >= F.date_trunc("hour", F.lit(begin))) & (F.col("t") < F.lit(end)))
        assert rows(hours.filter(partition_predicate(begin, end)), "dt", "hh") == rows(want, "dt", "hh")


def test_file_imports(spark, tmp_path):
    (tmp_path / "r01_csrSvr.log").write_text("\n".join([ROUTE_REQ, ROUTE_RES, STATUS_RES, "junk"]))
    out = rows(import_router_log(spark, str(tmp_path / "r01_csrSvr.log")), "router_id", "mode", "server_ip", "app_id")
    assert out == [("r01", "Request", "", "A2"), ("r01", "Response", "198.51.100.3", "")]
    nine = SESSION.split(",end")[0]
    (tmp_path / "r02_onoff.log").write_text(f"[2023-05-06 07:08:02] {nine}\n[2023-05-06 07:08:02] {SESSION}\n")
    got = rows(import_session_log(spark, str(tmp_path / "r02_onoff.log")), "router_id", "client_id", "motion")
    assert got == [("r02", "02:00:00:00:00:2c", "OFF")] * 2
    ends = rows(import_session_log(spark, str(tmp_path / "r02_onoff.log")), "off_at")
    assert [e is None for (e,) in ends] in ([True, False], [False, True])
    for name in ("r100_csrSvr.log", "r101_csrSvr.log"):
        (tmp_path / name).write_text(ROUTE_REQ + "\n" + ROUTE_REQ.replace(", A2, S9 )", " )"))
    assert rows(import_router_log(spark, str(tmp_path / "r10*")), "router_id") == [("r100",), ("r101",)]


def test_stream_equals_batch_and_reports_progress(spark):
    src, out = scratch_dir(spark, "src"), scratch_dir(spark, "out")
    text = lines(spark, ROUTE_REQ, ROUTE_RES, "junk")
    text.write.text(src)
    stream = read_stream(spark, "text", {"path": src})
    query = append(accepted(parse_route(stream)), f"{out}/t", f"{out}/c", available_now=True)
    query.awaitTermination()
    assert sum(p["rows"] for p in progress(query)) == 3
    assert rows(spark.read.parquet(f"{out}/t"), "mode", "client_ip") == rows(
        accepted(parse_route(text)), "mode", "client_ip"
    )
    # A second run from the same checkpoint finds nothing new.
    append(accepted(parse_route(stream)), f"{out}/t", f"{out}/c", available_now=True).awaitTermination()
    assert spark.read.parquet(f"{out}/t").count() == 2
    # New lines are picked up, the bad one ends in the quarantine.
    fan = fan_out(stream, parse_route, one_table("route_log"), f"{out}/raw", f"{out}/c2", "routers", available_now=True)
    fan.awaitTermination()
    assert spark.read.parquet(f"{out}/raw/route_log").count() == 2
    assert rows(spark.read.parquet(f"{out}/raw/quarantine"), "reject") == [("line",)]


def test_a_repeated_batch_replaces_itself(spark):
    path = scratch_dir(spark, "batch")
    good = accepted(parse_route(lines(spark, ROUTE_REQ, ROUTE_RES)))
    for batch in (0, 1, 1):
        write_batch(good, path, batch_name("routers", "run", batch))
    assert spark.read.parquet(path).count() == 4
    assert switch_table(accepted(parse_samples(raw(spark, "[]"))))["network"].count() == 0


def test_watermark_closes_buckets(spark):
    src, out = scratch_dir(spark, "src"), scratch_dir(spark, "out")
    spark.sql(
        "SELECT 'k' k, timestamp'2024-01-01 07:08:00' + make_interval(0,0,0,0,0,id) ts FROM range(10)"
    ).write.parquet(src)
    stream = read_stream(spark, "parquet", {"path": src}, spark.read.parquet(src).schema)
    agg = windowed(stream, "ts", "2 minutes", "1 minute", ["k"], [F.count(F.lit(1)).alias("n")])
    append(agg, f"{out}/t", f"{out}/c", True, partition_by=()).awaitTermination()
    # Minute 9 has come, two minutes of delay: minutes 0 to 6 are closed.
    assert spark.read.schema(agg.schema).parquet(f"{out}/t").count() == 7


def test_alerts(spark):
    found = alerts(raw(spark, '{"response":"404"}', '{"response":"200"}', "x"), "response", "404")
    assert rows(found) == [('{"response":"404"}',)]


def test_snapshot_merge(spark):
    old = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], "id STRING, v INT, stamp INT")
    new = spark.createDataFrame([("a", 2, 2), ("c", 2, 2)], "id STRING, v INT, stamp INT")
    assert rows(merge_snapshot(old, new, ["id"], "stamp"), "id", "v") == [("a", 2), ("b", 1), ("c", 2)]


def test_keys_and_months():
    assert check_key(HOUR, "2024010203") == "2024010203"
    for grain, key in [(HOUR, "20240102"), (DAY, "2024010x"), (DAY, "20241340")]:
        with pytest.raises(ValueError):
            check_key(grain, key)
    assert months_back(datetime(2024, 3, 31), 1) == datetime(2024, 2, 29)
    assert months_back(datetime(2024, 1, 15), 6) == datetime(2023, 7, 15)
    assert months_back(datetime(2024, 12, 1), 60) == datetime(2019, 12, 1)


def test_jdbc_needs_a_table_or_a_query(spark):
    assert jdbc_options("jdbc:x", "u", None, None) == {"url": "jdbc:x", "user": "u"}
    with pytest.raises(ValueError):
        read_jdbc(spark, {"url": "jdbc:x"})


def test_a_new_checkpoint_is_refused_replaced_or_continued(spark):
    src, out = scratch_dir(spark, "src"), scratch_dir(spark, "restart")
    lines(spark, ROUTE_REQ, ROUTE_RES).write.text(src)

    def run(checkpoint, restart, source="routers"):
        rows_ = accepted(parse_route(read_stream(spark, "text", {"path": src})))
        ingest(rows_, f"{out}/t", f"{out}/{checkpoint}", source, True, restart=restart).awaitTermination()
        return spark.read.parquet(f"{out}/t").count()

    assert run("a", "refuse") == 2
    assert run("a", "refuse") == 2
    with pytest.raises(Exception, match="another checkpoint"):
        run("b", "refuse")
    assert run("c", "replace") == 2
    assert run("d", "continue") == 4
    assert run("e", "refuse", "others") == 6
