"""All named queries and the SQL they are compared with."""

from tidegate.registry import (  # noqa: F401  (each module registers its queries)
    aggregate_queries,
    function_queries,
    join_queries,
    projection_queries,
    sink_queries,
    source_queries,
    stream_queries,
)
from tidegate.registry.core import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
