"""The query registry."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from adjudika.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(spark, sf_dir) -> DataFrame`` under ``name``, with its comparison SQL if there is one."""
    def register(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(tune(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return f

    return register
