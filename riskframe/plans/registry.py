"""Registry of named queries bound to the driver's test tables.

``register(name, sql)`` records a callable ``(spark, sf_dir) -> DataFrame`` and,
when the query is SQL-expressible, the DuckDB oracle text over the same tables.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskframe.session import package_on_workers

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise KeyError(f"query registered twice: {name}")
        @functools.wraps(fn)
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            package_on_workers(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco
