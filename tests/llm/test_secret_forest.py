"""Secrets: candidates, held-out accuracy of the forest, and a plan without Python."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from opslog.llm import secret_forest as sec
from tests.llm.common import documents, odd_cases, prose


def test_candidates_and_their_words(spark):
    value = "ab12cd34ef56ab78cd90"
    texts = [f"so the password={value} is set", f'x token = "{value}" y', f"{value}", "nothing_here_without_a_number_at_all", f"a;b={value};c={value}1"]
    rows = sec.candidates(documents(spark, texts)).collect()
    assert sorted((r["doc_id"], r["word_no"], r["value"]) for r in rows) == [
        (0, 2, value), (1, 3, value), (2, 0, value), (4, 0, value), (4, 0, value + "1"),
    ]
    by_doc = {r["doc_id"]: r for r in rows}
    assert by_doc[1]["before"] == "x token ="
    assert by_doc[1]["after"] == "y"


def test_held_out_findings(spark):
    rnd = random.Random(1)
    docs = documents(spark, [prose(rnd, 6) for _ in range(240)])
    found = sec.planted_findings(docs).withColumn("label", F.col("label").cast("int"))
    assert {r["label"] for r in found.select("label").distinct().collect()} == {0, 1}
    fold = F.pmod(F.floor(F.col("doc_id") / 2), F.lit(3))
    model = sec.fit(found.filter(fold != 0))
    judged = sec.judge(found.filter(fold == 0), model)
    assert "Python" not in judged._jdf.queryExecution().executedPlan().toString()
    right = judged.select((F.col("predicted") == F.col("label")).cast("int").alias("ok")).agg(F.avg("ok")).first()[0]
    assert right > 0.95


def test_odd_rows_empty_table_and_no_labels(spark):
    df = odd_cases(spark)
    assert sec.candidates(df, "source").count() == 0
    assert sec.candidates(df.limit(0)).count() == 0
    found = sec.candidates(documents(spark, ["key=ab12cd34ef56ab78cd90"]))
    assert sec.fit(found.withColumn("label", F.lit(1))) is None
    assert sec.fit(sec.planted_findings(df.limit(0))) is None
    assert [r["predicted"] for r in sec.judge(found, None).collect()] == [1]


def test_named_values_of_any_form(spark):
    texts = [
        "password: hunter2hunter", "x password=correcthorsebatterystaple y", "my pwd = s3cr3tPass.", 'token="Zq9!x.7@pL&2vR#8mK"',
        "the password is short: no", "password=abc", "compass: northwards", "DB_PASSWORD='abc,def.x', next",
        "api-key\n: \n qwertyuiop", 'password=hunter2;other=ab12cd34ef56ab78cd90',
    ]
    rows = sec.candidates(documents(spark, texts)).collect()
    assert sorted((r["doc_id"], r["part"], r["value"]) for r in rows) == [
        (0, 0, "hunter2hunter"), (1, 0, "correcthorsebatterystaple"), (2, 0, "s3cr3tPass"), (3, 0, "Zq9!x.7@pL&2vR#8mK"),
        (7, 0, "abc,def.x"), (8, 0, "qwertyuiop"), (9, 0, "hunter2;other=ab12cd34ef56ab78cd90"),
    ]


def test_forest_knows_named_secrets_from_plain_words(spark):
    rnd = random.Random(2)
    docs = documents(spark, [prose(rnd, 6) for _ in range(240)])
    model = sec.fit(sec.planted_findings(docs))
    texts = ["password: hunter2hunter", "password=correcthorsebatterystaple", "pwd = s3cr3tPass", 'token="Zq9!x.7@pL&2vR#8mK"']
    plain = ["password: required", "token = undefined", "secret: changeme", "password=your_password"]
    found = sec.judge(sec.candidates(documents(spark, texts + plain)), model)
    assert {(r["doc_id"], r["predicted"]) for r in found.collect()} == {(i, int(i < 4)) for i in range(8)}
