"""Registry of the named queries and, beside each, the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vacantia.plans.bindings import Data

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers ``fn(data)`` under a name as a callable of session and table folder."""

    def add(fn: Callable[[Data], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Data(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add
