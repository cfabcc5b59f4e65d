"""Numbered write chunks within each partition of a topic."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidegate import fixed_values as V

# Offsets are unique in a partition, so a span of offsets holds at most that many rows.
OFFSET_SPAN = 1_000_000


def with_chunks(
    rows: DataFrame,
    by: Sequence[str],
    offset: str,
    size: int = V.INDEX_CHUNK_DOCS,
    span: int = OFFSET_SPAN,
) -> DataFrame:
    """Add ``chunk_id``: every ``size`` rows of a partition, in offset order, and the remainder.

    Row numbers are counted within spans of offsets and shifted by the size of the spans before,
    so no task sorts a whole partition, however many of the rows it holds.
    """
    spanned = rows.withColumn("_span", F.floor(F.col(offset) / F.lit(span)))
    counts = spanned.groupBy(*by, "_span").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*by).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *by, "_span", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    within = Window.partitionBy(*by, "_span").orderBy(offset)
    numbered = spanned.withColumn("_number", F.row_number().over(within))
    index = F.col("_start") + F.col("_number") - 1
    return (
        numbered.join(starts, [*by, "_span"])
        .withColumn("chunk_id", F.floor(index / F.lit(size)))
        .drop("_span", "_start", "_number")
    )
