import duckdb
import pytest

from tessera.llm import registry

SF = "/root/testdata/sf0.01"
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_like_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    out = registry.QUERIES[name](spark, SF)
    cols = sorted(out.columns)
    rel = con.sql(registry.ORACLE_SQL[name])
    assert sorted(rel.columns) == cols
    assert {c: KINDS[t] for c, t in out.dtypes} == dict(zip(rel.columns, map(str, rel.types), strict=True))
    order = [rel.columns.index(c) for c in cols]
    assert sorted(tuple(r[c] for c in cols) for r in out.collect()) == sorted(tuple(r[i] for i in order) for r in rel.fetchall())
