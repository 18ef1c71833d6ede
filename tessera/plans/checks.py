"""Acceptance checks: each is the table of rows that break it, empty when all is well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import overlapping, squeeze
from tessera.operators.quotes import quote_places
from tessera.operators.relational import stable_sample


def at_least(df: DataFrame, n: int, name: str) -> DataFrame:
    """One row if there are fewer than n."""
    return df.agg(F.count("*").alias("rows")).filter(F.col("rows") < n).select(F.lit(name).alias("check"), "rows")


def outside(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Values that are not allowed, with their number."""
    return df.filter(~F.col(column).isin(allowed) | F.col(column).isNull()).groupBy(column).agg(F.count("*").alias("rows"))


def missing_values(allowed: list[str], df: DataFrame, column: str) -> DataFrame:
    """Allowed values that never occur."""
    wanted = df.sparkSession.createDataFrame([(v,) for v in allowed], f"{column} string")
    return wanted.join(df.select(column).distinct(), column, "left_anti")


def blank_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows where a required column is null or empty."""
    bad = F.lit(False)
    for c in columns:
        bad |= F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
    return df.filter(bad)


def residue(texts: DataFrame, id_col: str, text_col: str, forbidden: list[str]) -> DataFrame:
    """id_col, word, n of forbidden strings that are left in texts, overlaps counted."""
    word = F.explode(F.array(*map(F.lit, forbidden))).alias("word")
    rows = texts.select(id_col, F.col(text_col).alias("_t"), word)
    return rows.select(id_col, "word", overlapping(F.col("_t"), F.col("word")).alias("n")).filter("n > 0")


def unguarded(texts: DataFrame, id_col: str, text_col: str, variant: str, before: str = "", after: str = "") -> DataFrame:
    """Texts where a variant stands without a guarding neighbour."""
    look = (f"(?<![{before}])" if before else "") + variant + (f"(?![{after}])" if after else "")
    return texts.select(id_col, F.regexp_count(F.col(text_col), F.lit(look)).alias("n")).filter("n > 0")


def lost_quotes(cards: DataFrame, texts: DataFrame, key: str = "course_id", sample: int | None = None) -> DataFrame:
    """Cards (a stable sample of each course if asked) whose quote is not in their course's text."""
    rows = stable_sample(cards, [key], ["card_id"], sample) if sample else cards
    asked = rows.filter(F.coalesce(squeeze(F.col("quote")) != "", F.lit(True))).select(key, "card_id", "quote")
    return asked.join(quote_places(asked, texts, "card_id", "quote", key, "text", on=[key]), [key, "card_id"], "left_anti").select(key, "card_id")


def uncovered(wanted: DataFrame, got: DataFrame, key: str) -> DataFrame:
    """Wanted keys without a row."""
    return wanted.select(key).distinct().join(got.select(key).distinct(), key, "left_anti")


def gate(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, violations, passed) of named tables of violations: a run is published if all have passed."""
    out = None
    for name, found in checks.items():
        row = found.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations", (F.col("violations") == 0).alias("passed"))
        out = row if out is None else out.unionAll(row)
    return out


def present(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """(condition, rows, present): how many rows meet each named condition, and whether any does."""
    counts = df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("condition"), F.col(n).alias("rows")) for n in conditions]))
    return counts.select(pairs.alias("p")).select("p.condition", "p.rows", (F.col("p.rows") > 0).alias("present"))
