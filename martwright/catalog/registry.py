"""Registry of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martwright.catalog.views import sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` may refer to tables and views in braces."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = sql(oracle)
        return run

    return register


def rounded_ratio(total: str, count: str) -> str:
    """SQL for ``total / count`` rounded half up to two places, in whole numbers."""
    exact = f"(CAST({total} AS HUGEINT) * 200 + {count}) // (2 * {count})"
    return f"CAST(({exact}) / 100.0 AS DECIMAL(18,2))"
