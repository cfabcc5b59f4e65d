"""Relational sources read through JDBC, and their rows as JSON objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    driver: str | None = None,
    fetch_size: int = 10_000,
    split: tuple[str, int, int, int] | None = None,
) -> dict[str, str]:
    """Options of a JDBC read of a table or a query.

    ``split`` is (numeric column, lower bound, upper bound, partitions): a large table is then read
    by several tasks. The bounds set the strides and lose no rows.
    """
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    options = {"url": url, "fetchsize": str(fetch_size)}
    if driver:
        options["driver"] = driver
    if query is not None and split is None:
        options["query"] = query
    else:
        # A split read takes no ``query`` option; the query goes in as a derived table.
        options["dbtable"] = table if table is not None else f"({query}) q"
    if split is not None:
        column, low, high, partitions = split
        options.update(
            partitionColumn=column,
            lowerBound=str(low),
            upperBound=str(high),
            numPartitions=str(partitions),
        )
    return options


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def as_json_objects(rows: DataFrame) -> DataFrame:
    """One JSON object per row, keyed by column name; NULL columns stay as null."""
    return rows.select(
        F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("object")
    )
