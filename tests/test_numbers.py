"""Exact rounding against Python's round, number places against a loop."""

import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tessera.functions import numbers as N


def cases():
    r = random.Random(5)
    out = [0.0, 0.5, 1.5, 2.5, 0.125, 0.375, 2.675, 1.005, 1.0005, 0.05, 0.15, 0.25, 0.35, 1e15 + 0.5, 2.0**52 + 1, 1e300, 5e-324, 1e-10, 4503599627370495.5, 123456.7895, 0.49999999999999994, 8.5, 1e16]
    for _ in range(4000):
        k = r.choice([1, 2, 3, 4, 6])
        out.append(r.choice([r.random(), r.uniform(-1e6, 1e6), round(r.uniform(-1000, 1000), k + 1), (r.randrange(10**6) + 0.5) / 10**k, r.randrange(1 << 20) / 2 ** r.randrange(20)]))
    return out + [-x for x in out]


@pytest.mark.parametrize("places", [0, 1, 2, 3, 4])
def test_half_even_like_python(spark, places):
    values = cases()
    df = spark.createDataFrame([(x,) for x in values] + [(None,)], "x double").select("x", N.half_even(F.col("x"), places).alias("y"))
    for x, y in df.collect():
        assert y == (None if x is None else round(x, places)), (x, Fraction(x) if x is not None else None, y)


def test_number_places(spark):
    r = random.Random(1)
    texts = [(i, "".join(r.choice("0123.4 cm颗\n") for _ in range(r.randint(0, 60)))) for i in range(80)] + [(80, None), (81, "")]
    rules = [(r"(\d+)\s*cm", "cm"), (r"(\d+)颗", "颗"), (r"\d+\.\d+", "decimal")]
    want = sorted((i, u, m.start(), m.end(), m.group()) for i, t in texts for p, u in rules for m in re.finditer(p.replace(r"(\d+)", r"(\d+(?:\.\d+)?)"), t or ""))
    got = N.number_places(spark.createDataFrame(texts, "i long, t string"), "i", "t", rules)
    assert got.columns == ["i", "unit", "start", "end", "fragment", "ctx"] and sorted(map(tuple, got.drop("ctx").collect())) == want
    assert all(x.ctx == (dict(texts)[x.i] or "")[max(0, x.start - 30) : x.end + 30].replace("\n", " ") for x in got.collect())
    assert N.number_places(spark.createDataFrame([(1, "3.5 cm, 5cm")], "i long, t string"), "i", "t", rules[:1]).select("fragment").collect() == [("3.5 cm",), ("5cm",)]
