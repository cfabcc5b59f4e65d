"""Tables between the steps of one job."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from tidegate.workspace import workspace

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` to the shared folder and read it again.

    Cuts the lineage: a lost executor costs the step that ran on it, not the steps before. Values made by
    ``monotonically_increasing_id`` are fixed from here on. The shuffle files of the step go as soon as it is written.
    """
    spark = frame.sparkSession
    place = workspace(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        frame.write.parquet(place)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(place)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Python workers look for this package where the driver found it, besides their own path."""
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if here not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (here, known)))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
