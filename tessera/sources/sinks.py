"""Writers. Reports are small by nature: one row per course or finding."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import table_cell


def report_csv(df: DataFrame, path: str, headers: dict[str, str], order: list[str]) -> None:
    """One CSV file for a spreadsheet: renamed columns, sorted, with a byte order mark before the header."""
    named = df.orderBy(*order).select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(h) for c, h in headers.items()])
    first, rest = named.columns[0], named.columns[1:]
    named.select(F.col(f"`{first}`").alias("\ufeff" + first), *[F.col(f"`{c}`") for c in rest]).coalesce(1).write.mode("overwrite").option("header", True).option("quoteAll", False).csv(path)


def json_lines(df: DataFrame, path: str, by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).json(path)


def text_files(df: DataFrame, path: str, key: str, text: str) -> None:
    """A folder per key with its text."""
    df.select(key, F.col(text).alias("value")).write.mode("overwrite").partitionBy(key).option("lineSep", "\n").text(path)


def compact_json(columns: list[str], always: tuple[str, ...] = ("variants",)) -> Column:
    """A row as JSON without its empty fields, except those always kept."""
    full = [F.col(c).alias(c) if c in always else F.when(F.coalesce(F.col(c).cast("string"), F.lit("")).isin("", "0", "false"), None).otherwise(F.col(c)).alias(c) for c in columns]
    return F.to_json(F.struct(*full))


def markdown_table(df: DataFrame, columns: list[str], order: list[str | Column]) -> DataFrame:
    """(n, line): a Markdown table's lines in order, header first."""
    from pyspark.sql import Window

    cells = F.concat(F.lit("| "), F.concat_ws(" | ", *[table_cell(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns]), F.lit(" |"))
    head = df.sparkSession.createDataFrame([(-1, "| " + " | ".join(columns) + " |"), (0, "|" + "---|" * len(columns))], "n int, line string")
    # reports have a row per course or finding, so one window over them is small
    rows = df.select(F.row_number().over(Window.orderBy(*order)).alias("n"), cells.alias("line"))
    return head.unionAll(rows)


def replace_section(report: Column, heading: str, section: Column) -> Column:
    """A report whose part from the heading on is this section: written twice it is there once."""
    return F.concat(F.rtrim(F.substring_index(report, heading, 1), F.lit(" \n")), F.lit("\n\n" + heading + "\n\n"), section)


def append(df: DataFrame, path: str) -> None:
    """Add rows to a ledger; rows already there stay as they are."""
    df.write.mode("append").json(path)


def blocked(spark: SparkSession, path: str, step: str, reason: str) -> None:
    """Say that a step could not run, where its result would be."""
    spark.createDataFrame([(step, "BLOCKED", reason)], "step string, status string, reason string").write.mode("overwrite").json(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced as a whole."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(conf).create(place, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def stats_json(df: DataFrame) -> str:
    """A one-row table of totals as JSON."""
    return json.dumps(df.first().asDict(recursive=True), ensure_ascii=False, sort_keys=True, default=str)
