"""Operators for preparing large text corpora, with their registered queries."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_MODULES = (
    "quality_mil", "line_ledger", "secret_ledger", "decontaminate", "surrogates", "outlier_rules", "hidden_markov", "mix_flow",
    "language_backoff", "chosen_path", "token_store", "segment_mining", "source_audit",
)


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load() -> None:
    for module in _MODULES:
        import_module(f"cytoframe.llm.{module}")
