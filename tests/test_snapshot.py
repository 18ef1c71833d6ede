"""The platform's file, read and written back through data sources."""

import csv
import glob
import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from tessera.sources import snapshot as S


@pytest.fixture
def platform(tmp_path):
    path = f"{tmp_path}/platform.db"
    con = sqlite3.connect(path)
    con.execute("create table courses (goods_id text, goods_name text, resource_type integer, price_low real, sell_num integer, sale_status integer, created_at text, extra text)")
    con.execute("create table store_lives (live_id text, title text, zb_start_at text, zb_stop_at text, alive_state integer)")
    con.execute("create table learning_records (goods_id text, user_id integer, is_finish integer)")
    con.executemany("insert into courses values (?, ?, ?, ?, ?, ?, ?, ?)", [(f"g{i}", f"第{i}课 \"q\"", i % 5, i / 4, i, None if i % 9 == 0 else i % 2, f"2026-01-{i % 28 + 1:02}", "x") for i in range(200)])
    con.executemany("insert into learning_records values (?, ?, ?)", [(f"g{i % 7}", i % 11, i % 3 == 0) for i in range(1000)])
    con.commit()
    con.close()
    return path


def test_three_tables(spark, platform):
    found = S.snapshot(spark, platform, partitions=3)
    con = sqlite3.connect(platform)
    courses = con.execute("select goods_id, goods_name, resource_type, price_low, sell_num, sale_status, created_at from courses").fetchall()
    assert sorted(map(tuple, found["courses"].collect())) == sorted(courses)
    counted = con.execute("select goods_id, count(*), count(distinct user_id), sum(case when is_finish=1 then 1 else 0 end) from learning_records group by goods_id").fetchall()
    assert sorted(map(tuple, found["lr_by_goods"].collect())) == sorted(counted)
    assert found["store_lives"].collect() == [] and found["store_lives"].columns[0] == "live_id"
    assert found["courses"].rdd.getNumPartitions() == 3


def test_filters_are_pushed(spark, platform):
    rows = S.snapshot(spark, platform)["courses"]
    some = rows.filter((F.col("resource_type") == 3) & (F.col("sell_num") >= 50) & F.col("sale_status").isNotNull() & F.col("goods_id").isin("g53", "g58", "g60", "g63"))
    assert {r.goods_id for r in some.collect()} == {"g53", "g58"}
    reader = S.SnapshotReader({"path": platform, "table": "courses"}, rows.schema)
    left = list(reader.pushFilters([S.EqualTo(("resource_type",), 3), S.IsNull(("sale_status",)), S.In(("sell_num",), (1, 2)), S.EqualTo(("x",), b"raw")]))
    assert len(left) == 1 and reader.where == ['"resource_type" = ?', '"sale_status" IS NULL', '"sell_num" IN (?, ?)'] and reader.values == [3, 1, 2]


def test_one_csv_round_trip(spark, platform, tmp_path):
    path = f"{tmp_path}/candidates.csv"
    rows = spark.createDataFrame([(f"a{i}", f'b"{i}, x', i, "l1\nl2", "kind") for i in range(50)], "a string, b string, ca long, ctx_a string, kind string").repartition(4)
    for _ in range(2):  # written twice it is there once
        S.one_csv(rows, path, S.CANDIDATES, ["ca"])
    with open(path, "rb") as f:
        assert f.read(3) == b"\xef\xbb\xbf"
    with open(path, encoding="utf-8-sig", newline="") as f:
        lines = list(csv.reader(f))
    assert lines[0] == list(S.CANDIDATES.values()) and len(lines[0]) == 11
    assert [x[:2] for x in lines[1:]] == [[f"a{i}", f'b"{i}, x'] for i in range(50)] and lines[1][7] == "l1\nl2" and lines[1][9] == ""
    assert glob.glob(f"{path}.parts*") == []


def test_failed_jobs_leave_nothing(spark, tmp_path):
    path = f"{tmp_path}/bad.csv"
    rows = spark.range(100).repartition(4).select(F.when(F.col("id") == 57, F.raise_error(F.lit("stop")).cast("string")).otherwise(F.col("id").cast("string")).alias("a"))
    with pytest.raises(Exception, match="stop"):
        S.registered(spark)
        rows.write.format("one_csv").mode("overwrite").option("path", path).save()
    assert glob.glob(f"{path}*") == []


def test_one_yaml(spark, tmp_path):
    path = f"{tmp_path}/terms.yaml"
    rows = spark.createDataFrame([(1, "合学", ["和学", "核:学"], "c", None, ""), (0, "a\"b", [], None, "n", "s")], "_ord long, canonical string, variants array<string>, category string, note string, source string")
    S.one_yaml(rows, path, ["_ord"])
    with open(path, encoding="utf-8") as f:
        lines = f.read().splitlines()
    assert lines == ["terms:", '- canonical: "a\\"b"', "  variants: []", '  note: "n"', '  source: "s"', '- canonical: "合学"', '  variants: ["和学", "核:学"]', '  category: "c"']
    assert json.loads(lines[6].split(": ", 1)[1]) == ["和学", "核:学"]
