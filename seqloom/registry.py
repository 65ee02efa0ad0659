"""Where the library's queries and their SQL counterparts are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seqloom.plans import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def add(name: str, run: Query, sql: str | None = None, *needs: str) -> None:
    """Register ``run``; ``sql`` follows the recipes named by ``needs``."""
    QUERIES[name] = run
    if sql is not None:
        ORACLES[name] = ("WITH RECURSIVE " + ",\n ".join(fx.SQL.get(n, n) for n in needs) + "\n" if needs else "") + sql


def on(fixture, then) -> Query:
    return lambda spark, d: then(fixture(spark, d))
