"""Dimension snapshots as sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegate.sinks.tables import SnapshotTable


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed state. Call it per micro-batch, so that updates are seen."""
    return SnapshotTable(spark, path, keys=(), version=()).read()
