"""Runs: a graph of steps over a versioned folder, published once its checks pass."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.readers import exists

log = logging.getLogger("tessera")


@dataclass
class Step:
    """A step writes what it returns to the run's folder under its name."""

    name: str
    build: Callable[[Run], DataFrame]
    needs: tuple[str, ...] = ()


@dataclass
class Run:
    spark: SparkSession
    base: str
    run_id: str
    failed: dict[str, str] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.base}/runs/{self.run_id}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def listing(steps: list[Step], start: str | None = None) -> list[str]:
    """What would run, in order; start leaves out the steps before it."""
    names = [s.name for s in steps]
    return names[names.index(start) :] if start else names


def execute(run: Run, steps: list[Step], start: str | None = None) -> Run:
    """Run the steps in order. A failure is recorded and the others go on, save those that need it."""
    chosen = set(listing(steps, start))
    for step in steps:
        if step.name not in chosen:
            continue
        if lost := [n for n in step.needs if n in run.failed]:
            run.failed[step.name] = f"needs {', '.join(lost)}"
            continue
        began = time.time()
        try:
            step.build(run).write.mode("overwrite").parquet(run.path(step.name))
            log.info("%s done in %.1f s", step.name, time.time() - began)
        except Exception as e:  # noqa: BLE001  recorded, and it keeps the run from being published
            run.failed[step.name] = str(e)[:300]
            log.error("%s failed: %s", step.name, str(e)[:300])
    return run


def failures(checks: dict[str, DataFrame]) -> dict[str, int]:
    """Checks (tables of offending rows) that found some, with their number."""
    return {name: n for name, df in checks.items() if (n := df.count())}


def publish(run: Run, checks: Callable[[Run], dict[str, DataFrame]]) -> bool:
    """Point to this run if no step failed and no check found anything; else the last pointer stays."""
    found = dict(run.failed) or failures(checks(run))
    for name, what in found.items():
        log.error("not published: %s (%s)", name, what)
    if found:
        return False
    row = run.spark.createDataFrame([(run.run_id,)], "run_id string").withColumn("published_at", F.current_timestamp())
    row.coalesce(1).write.mode("append").parquet(f"{run.base}/latest")
    return True


def latest(spark: SparkSession, base: str) -> str | None:
    """The run published last."""
    if not exists(spark, f"{base}/latest"):
        return None
    return spark.read.parquet(f"{base}/latest").orderBy(F.desc("published_at"), F.desc("run_id")).first().run_id
