"""Registry of the engine's queries and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under a name, with its SQL counterpart where there is one."""

    def register(f):
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return register
