"""Registry of named queries: Spark builder plus optional DuckDB twin.

Query modules call ``register(name, sql)`` as a decorator on a function
``(spark, sf_dir) -> DataFrame``. ``sql=None`` marks operators that SQL
cannot express (checked against brute force in tests instead).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco
