"""Query registry: each entry is a Spark query and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from cytoframe.adapters import Model

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_MODULES = ("quality", "matrices", "markers", "pseudobulk", "abundance", "copynumber", "evidence", "tables", "io", "embedding", "neighbours", "programs", "comparison")


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Model], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: fn(Model(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load() -> None:
    for module in _MODULES:
        import_module(f"cytoframe.suite.{module}")
