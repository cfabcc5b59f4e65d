"""Change streams: Kafka options, and files of records as a stand-in without brokers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate import fixed_values as V
from tidegate.schemas import RECORD
from tidegate.sinks.publish import MESSAGE_ID, SOURCE_POSITION, header_long, header_text


def kafka_options(
    servers: str,
    topic: str,
    group_id: str | None = None,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of a Kafka source. The offsets only count for a query without checkpoint."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "kafka.group.id": group_id or V.group_of(topic),
        "includeHeaders": "true",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    records = spark.readStream.format("kafka").options(**options).load()
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
        *(header_long(F.col("headers"), c).alias(c) for c in SOURCE_POSITION),
        header_text(F.col("headers"), MESSAGE_ID).alias(MESSAGE_ID),
    )


def file_stream(
    spark: SparkSession, path: str, schema: str = RECORD, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files of records as a stream; each new file is new data."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def of_topic(records: DataFrame, topic: str) -> DataFrame:
    return records.filter(F.col("topic") == topic)


def once(records: DataFrame, delay: str = "1 hour") -> DataFrame:
    """The records without those that were published again: of each ``message_id`` the first that is read.

    In a stream an id is remembered until ``delay`` has passed since it was read, so the state holds the ids of that time
    and no record can be too late for it; a repeat after that time is let through. A batch remembers all ids and keeps the
    record of the least topic, partition and offset. Records without id are all kept.
    """
    place = F.to_json(F.array(*(F.col(c).cast("string") for c in ("topic", "partition", "offset"))))
    has_id = F.col(MESSAGE_ID).isNotNull()
    named = records.withColumn("_same", F.when(has_id, F.concat(F.lit("id"), MESSAGE_ID)).otherwise(place))
    if records.isStreaming:
        seen = named.withColumn("_read_at", F.current_timestamp()).withWatermark("_read_at", delay)
        return seen.dropDuplicatesWithinWatermark(["_same"]).select(*records.columns)
    repeated = named.filter(has_id)
    first = repeated.groupBy("_same").agg(
        F.min_by(F.struct(*records.columns), F.struct("topic", "partition", "offset")).alias("_first")
    )
    return named.filter(~has_id).select(*records.columns).unionByName(first.select("_first.*"))
