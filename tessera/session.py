"""Session helpers shared by the queries, tests and the bench."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

REPO = str(Path(__file__).resolve().parent.parent)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if REPO not in paths:
        env["PYTHONPATH"] = os.pathsep.join([REPO, *paths])


def local_session(cpus: int | str = 8, partitions: int | None = None, **conf) -> SparkSession:
    """A local session for tests and benches; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the driver's tables; the path may belong to any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
