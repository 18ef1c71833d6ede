"""Every query with SQL against DuckDB on the same tables, as the driver compares them."""

import math

import duckdb
import pytest

from tessera.plans import catalogue

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    return v


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_like_sql(spark, duck, name):
    out = catalogue.QUERIES[name](spark, SF)
    cols = sorted(out.columns)
    rows = [tuple(plain(r[c]) for c in cols) for r in out.collect()]
    if name not in catalogue.ORACLE_SQL:
        assert rows
        return
    rel = duck.sql(catalogue.ORACLE_SQL[name])
    names = rel.columns
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    want = [tuple(plain(r[i]) for i in order) for r in rel.fetchall()]
    assert len(rows) == len(want)
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    assert sorted(rows, key=key) == sorted(want, key=key)
    kinds = {"long": "BIGINT", "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    types = dict(zip(names, map(str, rel.types), strict=True))
    assert {c: kinds[t] for c, t in out.dtypes} == types
