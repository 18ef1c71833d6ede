"""Streams that are stopped and taken up again, against a loop."""

import datetime
import random

from pyspark.sql import functions as F

from tessera.plans import queries_streaming as S
from tessera.streaming import alerts as A
from tessera.streaming import ledger as L

ZERO = datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC)


def loop(rows, quiet=None):
    last, out = {}, set()
    for source, i, ts, said in sorted(rows, key=lambda r: (r[2], r[1])):
        before = last.get(source)
        if before is None or before[0] != said or (quiet is not None and ts - before[1] > datetime.timedelta(milliseconds=quiet)):
            out.add((source, i))
        last[source] = (said, ts)
    return out


def some_rows(seed):
    r = random.Random(seed)
    at, rows = ZERO, []
    for i in range(250):
        at += datetime.timedelta(seconds=r.choice([1, 5, 60, 4000]))
        rows.append((r.choice(["a", "b", None, "c"]), i, at, r.choice(["up", "up", "down", None])))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "source string, id long, ts timestamp, said string")
    return df.select("source", "id", "ts", A.signature("said").alias("signature")).repartition(3)


def test_changes_after_restarts(spark):
    rows = some_rows(1)
    got = S.in_slices(frame(spark, rows), A.changed)
    assert [tuple(x) for x in got.select("source", "id").collect()].__len__() == len(loop(rows))
    assert {tuple(x) for x in got.select("source", "id").collect()} == loop(rows)


def test_quiet_sources_are_forgotten(spark):
    rows = some_rows(2)
    quiet = 3600 * 1000
    got = S.in_slices(frame(spark, rows), lambda stream: A.changed(stream, quiet))
    assert {tuple(x) for x in got.select("source", "id").collect()} == loop(rows, quiet) != loop(rows)


def test_a_run_adds_each_row_once(spark, tmp_path):
    rows = frame(spark, some_rows(3))
    rows.write.parquet(f"{tmp_path}/in")
    for _ in range(2):  # the second run finds nothing new
        L.appended(A.changed(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert spark.read.parquet(f"{tmp_path}/out").count() == len(loop(some_rows(3)))


def test_signature_tells_nulls(spark):
    rows = spark.createDataFrame([(None, "x"), ("", "x"), ("null", "x")], "a string, b string").select(A.signature("a", "b").alias("s")).distinct()
    assert rows.count() == 3 and rows.filter(F.length("s") == 64).count() == 3
