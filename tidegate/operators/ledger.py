"""Consumer positions: exclusive end offsets per topic, group and partition."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Observation, functions as F

from tidegate.operators.lookup import lookup_join

# What a Kafka source takes for the earliest record of a partition.
EARLIEST = -2


def until_offsets(records: DataFrame, partition: str = "partition", offset: str = "offset") -> DataFrame:
    """Exclusive end position of each partition in these records."""
    return records.groupBy("topic", F.col(partition).alias("partition_id")).agg(
        (F.max(offset) + 1).alias("until_offset")
    )


def observed_positions(records: DataFrame, partitions: Sequence[tuple[str, int]], observation: Observation) -> DataFrame:
    """The same records; ``observation`` gets ``end_0``, ``end_1``, ... of ``partitions``, and how many ``others`` there are."""
    places = [(F.col("topic") == topic) & (F.col("partition") == partition) for topic, partition in partitions]
    ends = [F.max(F.when(place, F.col("offset") + 1)).alias(f"end_{i}") for i, place in enumerate(places)]
    known = F.struct("topic", "partition").isin([F.struct(F.lit(t), F.lit(p).cast("int")) for t, p in partitions])
    return records.observe(observation, *ends, F.count_if(~F.coalesce(known, F.lit(False))).alias("others"))


def merge_positions(saved: DataFrame | None, new: DataFrame) -> DataFrame:
    """Saved and new positions in one ledger; a replayed batch cannot move a position back."""
    both = new if saved is None else saved.unionByName(new)
    return both.groupBy("topic", "group_id", "partition_id").agg(
        F.max("until_offset").alias("until_offset")
    )


def positions_of(ledger: DataFrame, topic: str, group_id: str) -> DataFrame:
    return ledger.filter((F.col("topic") == topic) & (F.col("group_id") == group_id)).select(
        "topic", "partition_id", "until_offset"
    )


def positions_from_rows(rows: DataFrame, topic: str, group_id: str) -> DataFrame:
    """Positions from a relational ledger ``group_id, topic, topic_offset, partition_id``.

    The filters reach the source; a missing number reads as 0.
    """
    matching = rows.filter((F.col("topic") == topic) & (F.col("group_id") == group_id))
    return matching.select(
        "topic",
        F.coalesce(F.col("partition_id").try_cast("int"), F.lit(0)).alias("partition_id"),
        F.coalesce(F.col("topic_offset").try_cast("bigint"), F.lit(0).cast("bigint")).alias(
            "until_offset"
        ),
    )


def starting_offsets(positions: DataFrame) -> DataFrame:
    """Per topic the JSON that a Kafka source takes as ``startingOffsets``.

    A group is the partitions of one topic.
    """
    entries = F.array_sort(
        F.collect_list(F.struct(F.col("partition_id"), F.col("until_offset")))
    )
    by_partition = F.map_from_entries(
        F.transform(entries, lambda e: F.struct(e["partition_id"].cast("string"), e["until_offset"]))
    )
    return positions.groupBy("topic").agg(by_partition.alias("_offsets")).select(
        "topic",
        F.to_json(F.create_map(F.col("topic"), F.col("_offsets"))).alias("starting_offsets"),
    )


def with_all_partitions(positions: DataFrame, partitions: DataFrame) -> DataFrame:
    """Positions of each of ``partitions`` (topic, partition_id) of a topic that has any.

    A Kafka source wants all partitions of the topic in ``startingOffsets``. One without a saved position came
    later and starts at its earliest record.
    """
    earliest = partitions.join(positions.select("topic").distinct(), "topic", "left_semi")
    earliest = earliest.select("topic", "partition_id", F.lit(EARLIEST).cast("bigint").alias("until_offset"))
    both = positions.select("topic", "partition_id", "until_offset").unionByName(earliest)
    return both.groupBy("topic", "partition_id").agg(F.max("until_offset").alias("until_offset"))


def starting_offsets_option(
    positions: DataFrame, otherwise: str = "latest", partitions: DataFrame | None = None
) -> str:
    """The ``startingOffsets`` option of the one topic in ``positions``, complete for ``partitions`` if given."""
    row = starting_offsets(positions if partitions is None else with_all_partitions(positions, partitions)).first()
    return row["starting_offsets"] if row else otherwise


def resume_from(
    records: DataFrame, positions: DataFrame, partition: str = "partition", offset: str = "offset"
) -> DataFrame:
    """Records at or behind the saved position of their partition; a new partition from its start."""
    at = positions.select(
        "topic", F.col("partition_id").alias(partition), F.col("until_offset").alias("_from")
    )
    return (
        lookup_join(records, at, ["topic", partition], [offset])
        .filter(F.col(offset) >= F.coalesce(F.col("_from"), F.lit(0)))
        .drop("_from")
    )
