"""Register of the named queries and of the SQL that each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegate.registry.inputs import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str, views: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query under ``name`` with the DuckDB SQL of the same result."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        ORACLES[name] = with_views(sql, views)
        return run

    return register
