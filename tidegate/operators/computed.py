"""Columns that are computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_computed(frame: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns, such as parsed JSON, behind a one-row generator.

    The optimizer moves a filter below a projection by repeating the projected expressions in the
    filter. It cannot do so with generated columns, so a parse is not repeated for each predicate
    on its result. Filters on the other columns still move to the scan.
    """
    row = F.struct(*(column.alias(name) for name, column in columns.items()))
    kept = [c for c in frame.columns if c not in columns]
    return frame.select(*kept, F.inline(F.array(row)))
