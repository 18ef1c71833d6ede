"""Every query of the library by name, with its SQL for cross-checking."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
FLAGSHIP = "retrieval_recall"


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) under its name; without SQL it is tested against brute force."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


from tessera.plans import queries_reconcile, queries_replacement, queries_retrieval, queries_streaming, queries_terms  # noqa: E402, F401
