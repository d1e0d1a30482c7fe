"""Name -> query and name -> SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adoptrend.sources.inputs import Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``Inputs`` under ``name``."""

    def register(build: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Inputs(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return build

    return register
