"""Exact rounding of doubles, and number fragments with their places."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def half_even(value: Column, places: int) -> Column:
    """A double rounded to so many decimals by its exact binary value, ties to the even digit.

    A double is m * 2^-e with whole numbers m and e. Below 2^53 / 10^places the product with 10^places is formed exactly: its rounded
    value p by the processor, and what p lacks by Dekker's products of 26-bit halves. p's fraction and that remainder tell on which side of the
    middle the exact product lies; greater values have no more than `places` decimals and half a unit, or stay as they are.
    """
    scale = float(10**places)
    size = F.abs(value)
    p = size * F.lit(scale)
    halves = lambda x: (lambda c: (c - (c - x), x - (c - (c - x))))(x * F.lit(134217729.0))  # noqa: E731  2^27 + 1
    (xh, xl), (sh, sl) = halves(size), halves(F.lit(scale))
    lacks = ((xh * sh - p) + xh * sl + xl * sh) + xl * sl
    whole = F.floor(p).cast("double")
    over = (p - whole) - F.lit(0.5)  # exact, as p is below 2^53
    odd = whole % 2 == 1
    up = (over > 0) | ((over == 0) & ((lacks > 0) | ((lacks == 0) & odd)))
    # where p has been rounded to the middle, or to a whole number, its remainder decides
    digits = whole + F.when(up & ~((over == 0) & (lacks < 0)), 1.0).otherwise(0.0)
    out = digits / F.lit(scale)
    signed = F.when(value < 0, -out).otherwise(out)
    return F.when(p < F.lit(float(1 << 52)), signed).otherwise(value)


class NumberFragments:
    """Matches of (pattern, unit) rules in a text: (unit, start, end, fragment, ctx), in the order of rules and places.

    A rule written for whole numbers also takes those with decimals: its digit group is widened, so that 3.5 is one
    number and not the 5 behind a point. ctx is the fragment with `width` characters on both sides, line ends as spaces.
    """

    def __init__(self):
        self.rules: dict[tuple, list[tuple[re.Pattern, str]]] = {}

    def eval(self, text: str, patterns: list, units: list, width: int) -> Iterator[tuple]:
        key = (*patterns, *units)
        if key not in self.rules:
            self.rules[key] = [(re.compile(widened(p)), u) for p, u in zip(patterns, units, strict=True)]
        for pattern, unit in self.rules[key]:
            for m in pattern.finditer(text or ""):
                yield unit, m.start(), m.end(), m.group(), text[max(0, m.start() - width) : m.end() + width].replace("\n", " ")


def widened(pattern: str) -> str:
    """A rule's pattern with its plain digit groups open for decimals."""
    return pattern.replace(r"(\d+)", r"(\d+(?:\.\d+)?)")


def number_places(texts: DataFrame, key: str, text: str, rules: list[tuple[str, str]], width: int = 30) -> DataFrame:
    """key, unit, start, end, fragment, ctx of all matches of the rules (pattern, unit), by a lateral table function."""
    spark = texts.sparkSession
    found = F.udtf(NumberFragments, returnType="unit string, start long, end long, fragment string, ctx string")
    spark.udtf.register("number_fragments_of", found)
    lists = [F.array(*[F.lit(r[k]) for r in rules]) if rules else F.array().cast("array<string>") for k in (0, 1)]
    rows = texts.select(F.col(key).alias("_key"), F.col(text).alias("_text"), lists[0].alias("_patterns"), lists[1].alias("_units"), F.lit(width).alias("_width"))
    met = spark.sql("SELECT _key, f.* FROM {rows}, LATERAL number_fragments_of(_text, _patterns, _units, _width) f", rows=rows)
    return met.withColumnRenamed("_key", key)
