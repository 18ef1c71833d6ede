"""Stages that keep their results: what is computed again, and that it makes no difference."""

import pytest
from pyspark.sql import functions as F

from tessera.plans import cache


def build(rows):
    return rows.groupBy("k").agg(F.sum("v").alias("total"), F.count("*").alias("n"))


def test_only_changed_keys_are_computed(spark, tmp_path):
    folder, seen = f"file://{tmp_path}/stage", []

    def counted(rows):
        seen.append(rows.select("k").distinct().count())
        return build(rows)

    rows = spark.range(1000).select((F.col("id") % 100).alias("k"), F.col("id").alias("v"))
    changed = rows.filter("k <> 99").withColumn("v", F.when(F.col("k") % 10 == 3, F.col("v") + 1).otherwise(F.col("v"))).unionAll(spark.createDataFrame([(500, 1)], "k long, v long"))
    plain = lambda df: sorted(map(tuple, df.collect()))
    first, counts = cache.refreshed(rows, "k", counted, folder)
    assert plain(first) == plain(build(rows)) and counts == {"computed": 100, "kept": 0, "gone": 0}
    again, counts = cache.refreshed(rows.repartition(7), "k", counted, folder)
    assert plain(again) == plain(build(rows)) and counts == {"computed": 0, "kept": 100, "gone": 0} and len(seen) == 1
    second, counts = cache.refreshed(changed, "k", counted, folder)
    assert plain(second) == plain(build(changed)) and counts == {"computed": 11, "kept": 89, "gone": 1} and seen == [100, 11]
    _, counts = cache.refreshed(changed, "k", counted, folder, version="2")
    assert counts["computed"] == 100 and cache.latest(spark, folder) == 3


def test_a_failed_run_leaves_the_last_one(spark, tmp_path):
    folder = f"file://{tmp_path}/stage"
    rows = spark.createDataFrame([(1, 2), (2, 3), (None, 4)], "k long, v long")
    cache.refreshed(rows, "k", build, folder)
    with pytest.raises(Exception, match="stop"):
        cache.refreshed(rows.withColumn("v", F.col("v") + 1), "k", lambda r: build(r).withColumn("total", F.raise_error(F.lit("stop")).cast("long")), folder)
    assert cache.latest(spark, folder) == 1
    result, counts = cache.refreshed(rows, "k", build, folder)
    assert counts["kept"] == 2 and sorted(r.k for r in result.collect()) == [1, 2]


def test_marks_tell_repeated_rows_and_nulls(spark):
    mark = lambda rows: cache.fingerprints(spark.createDataFrame(rows, "k long, a string, b string"), "k", "1").first().mark
    every = [mark(r) for r in ([(1, "x", None)], [(1, None, "x")], [(1, "x", None)] * 2, [(1, "x", None)] * 3, [(1, "x", "")])]
    assert len(set(every)) == 5 and mark([(1, "a", "b"), (1, "c", "d")]) == mark([(1, "c", "d"), (1, "a", "b")])


def test_a_later_run_deals_out_keys_alone(spark, tmp_path, shuffled):
    """Rows of unchanged keys, and results that are kept, are not shuffled to find the changed ones, whatever the engine would broadcast by itself."""
    folder, words = f"file://{tmp_path}/stage", F.concat(*[F.sha2(F.concat("id", F.lit(f":{k}")), 512) for k in range(8)])
    rows = spark.range(2000).select((F.col("id") % 500).alias("k"), words.alias("v"))
    rows.write.parquet(f"{tmp_path}/rows")
    rows, own = spark.read.parquet(f"{tmp_path}/rows"), lambda df: df
    changed = rows.withColumn("v", F.when(F.col("k") % 10 == 3, F.upper("v")).otherwise(F.col("v")))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cache.refreshed(rows, "k", own, folder)
        out = []
        written = shuffled(lambda: out.append(cache.refreshed(changed, "k", own, folder)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    result, counts = out[0]
    assert counts == {"computed": 50, "kept": 450, "gone": 0} and sorted(map(tuple, result.collect())) == sorted(map(tuple, changed.collect()))
    assert written < 1024 * 2000 / 4
