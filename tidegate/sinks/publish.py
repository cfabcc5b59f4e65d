"""Publishing of messages to topics."""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidegate import fixed_values as V

MESSAGE_COLUMNS = ("topic", "key", "value")

# Names a message the same on every attempt to publish it, as a column and as a header.
MESSAGE_ID = "message_id"

# Where a change lies in its source; a message carries it as headers.
SOURCE_POSITION = ("source_ts", "xid", "xoffset")

Publisher = Callable[[DataFrame, str], None]


def position_headers() -> Column:
    """The source position as message headers; a part that is NULL has a header without value."""
    return F.array(
        *(
            F.struct(F.lit(c).alias("key"), F.col(c).cast("string").cast("binary").alias("value"))
            for c in SOURCE_POSITION
        )
    )


def message_id(origin: str, *position: Column) -> Column:
    """Identity of what ``origin`` makes of the change at ``position``; the parts cannot run into each other.

    It holds nothing of an attempt, so a batch that is repeated, or read anew by a query without checkpoint, gives it again.
    """
    return F.to_json(F.array(F.lit(origin), *(part.cast("string") for part in position)))


def message_headers(columns: Sequence[str]) -> Column | None:
    """The headers of messages with these columns: position and identity, as far as they have them."""
    parts = []
    if set(SOURCE_POSITION) <= set(columns):
        parts.append(position_headers())
    if MESSAGE_ID in columns:
        parts.append(F.array(F.struct(F.lit(MESSAGE_ID).alias("key"), F.col(MESSAGE_ID).cast("binary").alias("value"))))
    return F.concat(*parts) if parts else None


def header_text(headers: Column, name: str) -> Column:
    """The text in the first header of this name."""
    return F.get(F.filter(headers, lambda h: h["key"] == name), F.lit(0))["value"].cast("string")


def header_long(headers: Column, name: str) -> Column:
    """The number in the first header of this name."""
    return header_text(headers, name).try_cast("bigint")


def kafka_sink_options(servers: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "kafka.enable.idempotence": "true"}


def publish_to_kafka(messages: DataFrame, options: dict[str, str]) -> None:
    """Each message to the topic it names. A keyed message keeps its order per key."""
    columns = [c for c in MESSAGE_COLUMNS if c in messages.columns]
    headers = message_headers(messages.columns)
    if headers is not None:
        columns.append(headers.alias("headers"))
    messages.select(*columns).write.format("kafka").options(**options).save()


def publish_to_files(messages: DataFrame, path: str, batch_key: str = "0") -> None:
    """Messages as files by topic. A replayed batch replaces its own folder.

    Tasks write the topics they hold, so a topic with most of the rows is no bottleneck.
    """
    messages.write.mode("overwrite").partitionBy("topic").parquet(f"{path}/batch={batch_key}")


def file_publisher(path: str) -> Publisher:
    return lambda messages, batch_key: publish_to_files(messages, path, batch_key)


def kafka_publisher(servers: str) -> Publisher:
    return lambda messages, _: publish_to_kafka(messages, kafka_sink_options(servers))


def index_options(nodes: str, id_field: str = "id", chunk_docs: int = V.INDEX_CHUNK_DOCS) -> dict[str, str]:
    """Options of a search-index connector: upsert by id, whole documents, fixed bulk size."""
    return {
        "es.nodes": nodes,
        "es.mapping.id": id_field,
        "es.write.operation": "index",
        "es.batch.size.entries": str(chunk_docs),
        "es.input.json": "true",
    }


def index_documents(documents: DataFrame, index: str, options: dict[str, str]) -> None:
    documents.write.format("org.elasticsearch.spark.sql").options(**options).mode("append").save(index)
