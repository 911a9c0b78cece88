"""Named queries on the given tables, each next to the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` under ``name``, with its SQL where there is one."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql:
            ORACLES[name] = sql
        return build

    return register
