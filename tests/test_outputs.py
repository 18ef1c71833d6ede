"""Small writers: folders of texts, totals as JSON, gates."""

import json

from pyspark.sql import functions as F

from tessera.functions.text import overlapping
from tessera.plans import checks, providers
from tessera.sources import sinks


def test_text_files_and_totals(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x\ny"), ("b", "é")], "k string, t string")
    sinks.text_files(rows, f"file://{tmp_path}/texts", "k", "t")
    back = spark.read.text(f"file://{tmp_path}/texts", wholetext=True).collect()
    assert {(r.k, r.value.rstrip("\n")) for r in back} == {("a", "x\ny"), ("b", "é")}
    assert json.loads(sinks.stats_json(rows.agg(F.count("*").alias("n"), F.max("t").alias("m")))) == {"n": 2, "m": "é"}


def test_gate_parts(spark):
    rows = spark.createDataFrame([("a", ""), (None, "x"), ("b", "y")], "k string, t string")
    assert checks.missing_values(["a", "c"], rows, "k").collect() == [("c",)]
    assert checks.blank_columns(rows, ["k", "t"]).count() == 2
    found = {r.check: (r.violations, r.passed) for r in checks.gate({"blank": checks.blank_columns(rows, ["t"]), "outside": checks.outside(rows, "k", ["a", "b"])}).collect()}
    assert found["blank"] == (1, False)


def test_numbered_prompts(spark):
    rows = spark.createDataFrame([(0, 2, "y"), (0, 1, "x"), (1, 1, "z")], "batch_no long, item_no long, t string")
    got = {r.batch_no: r.payload for r in providers.numbered_prompt(rows, ["batch_no"], "item_no", F.col("t"), "Head").collect()}
    assert got == {0: "Head\n1. x\n2. y", 1: "Head\n1. z"}


def test_overlaps_of_any_literal(spark):
    rows = spark.createDataFrame([("aaaa", "aa", 3), ("x\\Ey\\Ey", "\\Ey", 2), ("a.b.c", ".", 2), ("abc", "", 0)], "t string, w string, n int")
    assert rows.select(overlapping(F.col("t"), F.col("w")).alias("got"), "n").filter("got <> n").isEmpty()
