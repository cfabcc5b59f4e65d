"""Inputs that arrive in fewer pieces than there are cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread_few_pieces(frame: DataFrame, *by: str) -> DataFrame:
    """Distribute a scan over all cores if it has fewer partitions than half of them.

    Meant for costly work per row, such as parsing, behind files that cannot be split. A large
    input has more pieces than that and stays as it is, without a shuffle.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    pieces = frame._jdf.queryExecution().toRdd().getNumPartitions()
    return frame if 2 * pieces >= cores else frame.repartition(cores, *by)
