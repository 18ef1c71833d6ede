"""A stage's results kept between runs: only keys whose inputs have changed are computed again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.relational import small, stored
from tessera.sources.readers import exists


def fingerprints(rows: DataFrame, key: str, version: str) -> DataFrame:
    """(key, mark): a mark of all rows of each key, whatever their order; it changes with the version of the stage too.

    Rows are hashed one by one, and the hashes added up in two ways, so no key's rows are gathered.
    """
    row = F.to_json(F.struct(*[F.col(c) for c in sorted(rows.columns)]), {"ignoreNullFields": "false"})
    one, two = F.xxhash64(F.lit(version), row), F.xxhash64(row, F.lit(version))
    sums = [F.count("*"), F.bit_xor(one), F.sum(two.cast("decimal(38,0)")), F.bit_xor(F.xxhash64(one, two))]
    return rows.groupBy(key).agg(F.sha2(F.concat_ws(":", F.lit(version), *[s.cast("string") for s in sums]), 256).alias("mark"))


def latest(spark: SparkSession, folder: str) -> int:
    """Number of the last finished run; 0 before the first."""
    if not exists(spark, f"{folder}/runs"):
        return 0
    return spark.read.parquet(f"{folder}/runs").agg(F.max("run")).first()[0] or 0


def refreshed(rows: DataFrame, key: str, build: Callable[[DataFrame], DataFrame], folder: str, version: str = "1") -> tuple[DataFrame, dict[str, int]]:
    """(result, counts): build(rows), of which only keys that are new or changed since the last run are computed.

    build works on each key by itself, and its result has the key. Results of unchanged keys are taken from the last run, those of
    keys that are gone are dropped. A run's tables are complete before it is listed in `runs`, so one that
    fails leaves the last one as it was. counts: keys computed, kept and gone.
    """
    spark, last = rows.sparkSession, latest(rows.sparkSession, folder)
    marks = stored(fingerprints(rows.filter(F.col(key).isNotNull()), key, version))
    if last:
        before = spark.read.parquet(f"{folder}/marks-{last}").withColumnRenamed("mark", "old")
        both = stored(marks.join(before, key, "full_outer"))
        fresh = both.filter("mark is not null and (old is null or old <> mark)").select(key)
        stale = both.filter("old is not null and (mark is null or old <> mark)").select(key)
        kept = spark.read.parquet(f"{folder}/result-{last}").join(small(stale), key, "left_anti")
        told = both.select(F.when(F.col("mark").isNull(), "gone").when(F.col("old") == F.col("mark"), "kept").otherwise("computed").alias("k")).groupBy("k").count().collect()
        counts = {"computed": 0, "kept": 0, "gone": 0} | {r.k: r["count"] for r in told}
        if not counts["computed"] and not counts["gone"]:
            return spark.read.parquet(f"{folder}/result-{last}"), counts
        result = kept.unionByName(build(rows.join(small(fresh), key, "left_semi")))
    else:
        counts = {"computed": marks.count(), "kept": 0, "gone": 0}
        result = build(rows.filter(F.col(key).isNotNull()))
    run = last + 1
    result.write.mode("overwrite").parquet(f"{folder}/result-{run}")
    marks.write.mode("overwrite").parquet(f"{folder}/marks-{run}")
    spark.createDataFrame([(run, *counts.values())], "run int, computed long, kept long, gone long").write.mode("append").parquet(f"{folder}/runs")
    return spark.read.parquet(f"{folder}/result-{run}"), counts
