"""A platform's SQLite file as a data source, and reports as single files: Spark's Python data sources.

Reading: `sqlite_snapshot` reads one table, in ranges of row ids, one task each; filters that SQLite can test are pushed into
its WHERE. The file is opened read-only. Writing: `one_csv` and `one_yaml` give one file each: tasks write their rows beside it, and
the driver joins the parts in order, under a temporary name, and puts the whole in place; what a failed job has written is
removed. Files are named by paths that all nodes see.
"""

from __future__ import annotations

import contextlib
import csv
import json
import os
import shutil
import sqlite3
import uuid
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

#: SQLite's declared types as the engine's, by what their names hold.
KINDS = [("INT", "bigint"), ("CHAR", "string"), ("TEXT", "string"), ("CLOB", "string"), ("REAL", "double"), ("FLOA", "double"), ("DOUB", "double")]
COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


@dataclass
class Rows(InputPartition):
    low: int
    high: int


def opened(path: str):
    return contextlib.closing(sqlite3.connect(f"file:{path}?mode=ro", uri=True))


def name(identifier: str) -> str:
    return '"' + identifier.replace('"', '""') + '"'


class SnapshotReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.table, self.count = options["path"], options["table"], int(options.get("partitions", "8"))
        self.columns, self.where, self.values = [f.name for f in schema], [], []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = name(".".join(f.attribute)) if hasattr(f, "attribute") else None
            if type(f) in COMPARED and isinstance(f.value, (int, float, str)):
                self.where.append(f"{column} {COMPARED[type(f)]} ?")
                self.values.append(f.value)
            elif isinstance(f, In) and f.value and all(isinstance(v, (int, float, str)) for v in f.value):
                self.where.append(f"{column} IN ({', '.join('?' * len(f.value))})")
                self.values += f.value
            elif isinstance(f, (IsNull, IsNotNull)):
                self.where.append(f"{column} IS {'NOT ' * isinstance(f, IsNotNull)}NULL")
            else:
                yield f  # the engine tests it

    def partitions(self) -> list[Rows]:
        with opened(self.path) as con:
            low, high = con.execute(f"SELECT min(rowid), max(rowid) FROM {name(self.table)}").fetchone()
        if low is None:
            return [Rows(0, 0)]
        step = max(1, -(-(high - low + 1) // self.count))
        return [Rows(a, min(a + step, high + 1)) for a in range(low, high + 1, step)]

    def read(self, part: Rows):
        tests = " AND ".join(["rowid >= ? AND rowid < ?", *self.where])
        with opened(self.path) as con:
            yield from con.execute(f"SELECT {', '.join(map(name, self.columns))} FROM {name(self.table)} WHERE {tests} ORDER BY rowid", [part.low, part.high, *self.values])


class Snapshot(DataSource):
    """Options: path, table, partitions."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_snapshot"

    def schema(self) -> str:
        with opened(self.options["path"]) as con:
            found = con.execute(f"PRAGMA table_info({name(self.options['table'])})").fetchall()
        kind = lambda declared: next((k for part, k in KINDS if part in declared.upper()), "string")
        return ", ".join(f"`{c[1]}` {kind(c[2])}" for c in found)

    def reader(self, schema: StructType) -> SnapshotReader:
        return SnapshotReader(self.options, schema)


@dataclass
class Part(WriterCommitMessage):
    number: int
    path: str
    rows: int


class OneFile(DataSourceWriter):
    """Rows in the order of partitions and rows as one file; subclasses say how a row is written, and what comes first."""

    def __init__(self, options: dict, schema: StructType):
        self.path, self.columns = options["path"], [f.name for f in schema]
        self.parts = f"{self.path}.parts-{uuid.uuid4().hex}"

    def head(self, out) -> None:
        pass

    def row(self, out, values: tuple) -> None:
        raise NotImplementedError

    def write(self, rows) -> Part:
        os.makedirs(self.parts, exist_ok=True)
        number = TaskContext.get().partitionId()
        path, n = f"{self.parts}/{number}-{uuid.uuid4().hex}", 0
        with open(path, "w", encoding="utf-8", newline="") as out:
            for r in rows:
                self.row(out, tuple(r))
                n += 1
        return Part(number, path, n)

    def commit(self, messages: list[Part]) -> None:
        whole = f"{self.parts}.whole"
        with open(whole, "w", encoding="utf-8", newline="") as out:
            self.head(out)
            for part in sorted((m for m in messages if m), key=lambda m: m.number):
                with open(part.path, encoding="utf-8", newline="") as own:
                    shutil.copyfileobj(own, out)
        os.replace(whole, self.path)
        shutil.rmtree(self.parts, ignore_errors=True)

    def abort(self, messages: list[Part]) -> None:
        shutil.rmtree(self.parts, ignore_errors=True)


class CsvWriter(OneFile):
    def head(self, out) -> None:
        out.write("﻿")
        csv.writer(out).writerow(self.columns)

    def row(self, out, values: tuple) -> None:
        csv.writer(out).writerow(["" if v is None else v for v in values])


class OneCsv(DataSource):
    """One CSV file with a byte order mark. Option: path."""

    @classmethod
    def name(cls) -> str:
        return "one_csv"

    def writer(self, schema: StructType, overwrite: bool) -> CsvWriter:
        return CsvWriter(self.options, schema)


class YamlWriter(OneFile):
    def __init__(self, options: dict, schema: StructType):
        super().__init__(options, schema)
        self.key, self.always = options.get("key", "terms"), set(options.get("always", "variants").split(","))

    def head(self, out) -> None:
        out.write(f"{self.key}:\n")

    def row(self, out, values: tuple) -> None:
        kept = [(c, v) for c, v in zip(self.columns, values, strict=True) if v or c in self.always]
        lines = [f"{c}: {json.dumps(v, ensure_ascii=False)}" for c, v in kept]  # JSON values are YAML
        out.write("- " + "\n  ".join(lines or ["{}"]) + "\n")


class OneYaml(DataSource):
    """One YAML list under a key, without empty fields but those always kept. Options: path, key, always."""

    @classmethod
    def name(cls) -> str:
        return "one_yaml"

    def writer(self, schema: StructType, overwrite: bool) -> YamlWriter:
        return YamlWriter(self.options, schema)


def registered(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (Snapshot, OneCsv, OneYaml):
        spark.dataSource.register(source)
    return spark


def snapshot(spark: SparkSession, path: str, partitions: int = 8) -> dict[str, DataFrame]:
    """The platform's courses, store lives, and learning records by goods (records, users, finishes)."""
    read = lambda t: registered(spark).read.format("sqlite_snapshot").option("path", path).option("table", t).option("partitions", partitions).load()
    records = read("learning_records")
    counted = records.groupBy("goods_id").agg(F.count("*").alias("records"), F.count_distinct("user_id").alias("users"), F.sum(F.when(F.col("is_finish") == 1, 1).otherwise(0)).alias("finishes"))
    return {
        "courses": read("courses").select("goods_id", "goods_name", "resource_type", "price_low", "sell_num", "sale_status", "created_at"),
        "store_lives": read("store_lives").select("live_id", "title", "zb_start_at", "zb_stop_at", "alive_state"),
        "lr_by_goods": counted,
    }


#: The columns of the candidates' file, and what they are called there.
CANDIDATES = {"a": "词形A", "b": "词形B", "key": "拼音", "ca": "次数A", "cb": "次数B", "na": "课程数A", "nb": "课程数B", "ctx_a": "示例A", "ctx_b": "示例B", "suggest": "裁决建议", "kind": "来源"}


def one_csv(df: DataFrame, path: str, headers: dict[str, str], order: list[str]) -> None:
    """df sorted, with renamed columns (those it lacks empty), as one CSV file."""
    registered(df.sparkSession)
    named = [(F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(h) for c, h in headers.items()]
    df.orderBy(*order).select(*named).write.format("one_csv").mode("overwrite").option("path", path).save()


def one_yaml(df: DataFrame, path: str, order: list[str], key: str = "terms", always: str = "variants") -> None:
    """df sorted, as one YAML list; columns of the order that begin with an underscore are left out."""
    registered(df.sparkSession)
    rows = df.orderBy(*order).drop(*[c for c in order if c.startswith("_")])
    rows.write.format("one_yaml").mode("overwrite").option("path", path).option("key", key).option("always", always).save()
