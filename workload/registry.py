"""Registry of queries: a function over roles and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.roles import Roles, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(roles)`` under ``name``; ``sql`` may refer to roles as ``{role}``."""

    def add(fn: Callable[[Roles], DataFrame]) -> Callable[[Roles], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Roles(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return add
