"""What a write took and what it rejected."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

logger = logging.getLogger("tidegate")


def outcome(reject_reason: Column) -> Column:
    return F.when(reject_reason.isNull(), "ok").otherwise("failed")


def write_audit(rows: DataFrame) -> DataFrame:
    """Documents per outcome and reason."""
    return rows.groupBy(
        outcome(F.col("reject_reason")).alias("outcome"),
        F.coalesce(F.col("reject_reason"), F.lit("")).alias("reason"),
    ).agg(F.count(F.lit(1)).alias("docs"))


def outcome_counts() -> list[Column]:
    failed = F.col("reject_reason").isNotNull()
    return [F.count_if(~failed).alias("ok"), F.count_if(failed).alias("failed")]


def observed(rows: DataFrame, observation: Observation, reasons: Sequence[str] = ()) -> DataFrame:
    """The same rows; ``observation`` gets the counts of outcomes, and of ``reasons``, from the write itself."""
    of_reasons = (F.count_if(F.col("reject_reason") == reason).alias(f"reason_{i}") for i, reason in enumerate(reasons))
    return rows.observe(observation, *outcome_counts(), *of_reasons)


def observed_audit(counts: Mapping[str, int], reasons: Sequence[str]) -> list[tuple[str, str, int]]:
    """Rows of ``write_audit`` from what ``observed`` has counted; reasons that were not asked for are ``other``."""
    found = [("failed", reason, counts[f"reason_{i}"]) for i, reason in enumerate(reasons)]
    rest = counts["failed"] - sum(docs for _, _, docs in found)
    return [row for row in (("ok", "", counts["ok"]), *found, ("failed", "other", rest)) if row[2]]


@dataclass(frozen=True)
class AuditTable:
    """Documents per batch, outcome and reason; a repeated batch replaces its own counts, so sums stay right."""

    spark: SparkSession
    path: str

    def keep(self, batch: str, counts: Iterable[tuple[str, str, int]]) -> None:
        rows = self.spark.createDataFrame(list(counts), "outcome string, reason string, docs bigint")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def read(self) -> DataFrame:
        return self.spark.read.schema("outcome string, reason string, docs bigint, batch string").parquet(self.path)

    def totals(self) -> DataFrame:
        """As ``write_audit`` over the rows of all batches."""
        return self.read().groupBy("outcome", "reason").agg(F.sum("docs").alias("docs"))


def log_outcome(batch: str, counts: Mapping[str, int]) -> None:
    """Counts only: rows may hold personal data."""
    level = logging.WARNING if counts["failed"] else logging.INFO
    logger.log(level, "batch %s: %d rows written, %d rejected", batch, counts["ok"], counts["failed"])
