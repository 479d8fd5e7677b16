"""Named queries over the driver's tables, each with its DuckDB oracle text.

A module declares a query with ``@query("key", oracle=SQL)``; ``__spark_entry__``
exposes the collected callables and oracle strings. A query without an oracle is one
that ANSI SQL cannot state (plan walks, Python-side text scoring); the driver then
checks its rows only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle.strip()
        return fn
    return wrap


MODULES = (
    "answercheck.operators.relational",
    "answercheck.operators.fanout",
    "answercheck.operators.quality",
    "answercheck.operators.metrics",
    "answercheck.operators.diff_queries",
    "answercheck.operators.scoring_queries",
    "answercheck.functions.text_queries",
    "answercheck.plans.catalog",
    "answercheck.plans.governed_queries",
)


def load_all() -> None:
    """Import every module that registers queries."""
    import importlib
    for name in MODULES:
        importlib.import_module(name)
