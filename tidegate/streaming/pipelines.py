"""The streaming pipelines: each reads a change stream and writes in ``foreachBatch``.

The sink of a batch is complete before Spark commits the batch to its checkpoint, and each sink
takes a repeated batch without effect. Dimension tables are opened inside the batch, so that a
running query sees their updates.
"""

from __future__ import annotations

from typing import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidegate import fixed_values as V
from tidegate.functions import payload as P
from tidegate.operators import dimensions as D
from tidegate.operators.envelopes import (
    BAD_ID,
    accepted,
    parse_envelopes,
    parse_payloads,
    rejected,
    require_ids,
)
from tidegate.operators.ledger import merge_positions, observed_positions, until_offsets
from tidegate.operators.oplog import high_water_mark
from tidegate.operators.routing import REASONS, publishable_with_rejects, route_by_table
from tidegate.plans.clue_enrichment import ClueDimensions, enrich_clues
from tidegate.plans.oplog_capture import capture_entries, judged_entries
from tidegate.schemas import LEDGER
from tidegate.sinks.audit import AuditTable, log_outcome, observed, observed_audit, outcome_counts, write_audit
from tidegate.sinks.publish import MESSAGE_ID, SOURCE_POSITION, Publisher, file_publisher, message_id
from tidegate.sinks.tables import IndexTable, SnapshotTable
from tidegate.streaming.frontier import Frontier, in_order
from tidegate.workspace import scratch

# The highest wins: the position in the source if the record carries it, else the offset. Records of an id lie
# in one partition, in order. The timestamp comes from producers, so it decides nothing by itself.
POSITION = (*SOURCE_POSITION, "offset", "partition", "timestamp")
ROW_KEY = ("topic", "partition", "offset")

# A topic's partitions up to which their ends are observed in passing; each is an aggregate of the observation.
OBSERVED_PARTITIONS = 200

BatchSink = Callable[[DataFrame, str], None]


def batch_key(batch: DataFrame, batch_id: int) -> str:
    """Names a batch the same on every attempt, and differently for each query."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{batch_id:012d}"


def start(
    records: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    name: str | None = None,
    seconds: int | None = None,
) -> StreamingQuery:
    """Run ``sink`` per batch: every ``seconds``, or, without them, over what is there now."""
    writer: DataStreamWriter = records.writeStream.foreachBatch(
        lambda batch, batch_id: sink(batch, batch_key(batch, batch_id))
    ).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if seconds is not None:
        return writer.trigger(processingTime=f"{seconds} seconds").start()
    return writer.trigger(availableNow=True).start()


def positions_sink(ledger: SnapshotTable, group_id: str) -> BatchSink:
    """Mirror of the positions for other tools, read from the batch by itself."""

    def save(batch: DataFrame, _: str) -> None:
        new = until_offsets(batch).withColumn("group_id", F.lit(group_id))
        ledger.upsert(merge_positions(None, new.select("topic", "group_id", "partition_id", "until_offset")))

    return save


def with_positions(sink: BatchSink, ledger: SnapshotTable, group_id: str) -> BatchSink:
    """``sink``, then the end positions of its batch in ``ledger``: a start without checkpoint begins behind them.

    The positions are observed while ``sink`` itself reads the batch, which it has to. Only a batch with a partition that
    the ledger does not have yet, or a topic of more than ``OBSERVED_PARTITIONS``, has its positions read again. After a
    crash between the two the batch is repeated, and both take that without effect.
    """
    known: list[tuple[str, int]] = []
    read_again = positions_sink(ledger, group_id)

    def both(batch: DataFrame, key: str) -> None:
        if not known and (saved := ledger.state()) is not None:
            known.extend(tuple(p) for p in saved.filter(F.col("group_id") == group_id).select("topic", "partition_id").collect())
        if not known or len(known) > OBSERVED_PARTITIONS:
            sink(batch, key)
            read_again(batch, key)
            known.clear()
            return
        seen = Observation()
        sink(observed_positions(batch, known, seen), key)
        ends = seen.get
        if ends["others"]:
            known.clear()
            read_again(batch, key)
        elif rows := [(t, group_id, p, ends[f"end_{i}"]) for i, (t, p) in enumerate(known) if ends[f"end_{i}"] is not None]:
            ledger.upsert(batch.sparkSession.createDataFrame(rows, LEDGER))

    return both


def positions_table(spark, path: str) -> SnapshotTable:
    return SnapshotTable(spark, path, ("topic", "group_id", "partition_id"), ("until_offset",))


def positioned(batch: DataFrame) -> DataFrame:
    """Records with a source position, NULL where they carry none."""
    missing = {c: F.lit(None).cast("bigint") for c in SOURCE_POSITION if c not in batch.columns}
    return batch.withColumns(missing) if missing else batch


def in_turn(*sinks: BatchSink) -> BatchSink:
    """One sink after the other, each after the one before has ended."""

    def sink(batch: DataFrame, key: str) -> None:
        for each in sinks:
            each(batch, key)

    return sink


def _publisher(to: str | Publisher) -> Publisher:
    return file_publisher(to) if isinstance(to, str) else to


def router_sink(
    to: str | Publisher,
    route: Callable[[DataFrame], DataFrame] = route_by_table,
    on_counts: Callable[[str, Mapping[str, int]], None] = log_outcome,
    audit: AuditTable | None = None,
) -> BatchSink:
    """Change envelopes to topics: files below a path, or whatever a publisher such as ``kafka_publisher`` writes.

    Rejected records go to a topic of their own. Messages carry the position of the change in its source, and an id
    that is the same if the record is published again (see ``change_stream.once``). ``audit`` gets the counts per reason,
    which the write itself has observed.
    """
    publish = _publisher(to)

    def sink(batch: DataFrame, key: str) -> None:
        identity = message_id("router", *(F.col(c) for c in ROW_KEY if c in batch.columns))
        records = batch.withColumn(MESSAGE_ID, identity).drop("topic", *SOURCE_POSITION)
        routed = route(parse_envelopes(records))
        messages = publishable_with_rejects(
            routed.withColumn("source_ts", F.col("ts")), carry=["type", *POSITION, MESSAGE_ID]
        )
        counts = Observation()
        publish(observed(messages, counts, REASONS), key)
        if audit:
            audit.keep(key, observed_audit(counts.get, REASONS))
        on_counts(key, {outcome: counts.get[outcome] for outcome in ("ok", "failed")})

    return sink


def dimension_changes(batch: DataFrame, op: str | None = None) -> DataFrame:
    """Payload records as versioned dimension rows ``id, doc, deleted, position``, and rejects.

    A delete is an ordinary change unless ``op`` names the column with the operation.
    """
    rows = require_ids(parse_payloads(positioned(batch)))
    deleted = F.coalesce(F.col(op) == "delete", F.lit(False)) if op else F.lit(False)
    return rows.select(
        "id",
        P.to_text(F.col("payload")).alias("doc"),
        deleted.alias("deleted"),
        *POSITION,
        "value",
        "reject_reason",
    )


def split_sink(
    judge: Callable[[DataFrame], DataFrame],
    write: BatchSink,
    rejects: str,
    on_counts: Callable[[str, Mapping[str, int]], None] = log_outcome,
    audit: AuditTable | None = None,
) -> BatchSink:
    """Write what ``judge`` accepts, keep what it rejects below ``rejects``, tell both counts.

    The judged batch is kept for both writes, and for the counts per reason that ``audit`` gets; if an executor is lost,
    Spark computes it again.
    """

    def sink(batch: DataFrame, key: str) -> None:
        judged = judge(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counts = Observation()
            unusable = rejected(observed(judged, counts)).select("value", "reject_reason", *POSITION)
            unusable.write.mode("overwrite").parquet(f"{rejects}/batch={key}")
            write(accepted(judged).drop("value", "reject_reason"), key)
            if audit:
                audit.keep(key, map(tuple, write_audit(judged).collect()))
            on_counts(key, counts.get)
        finally:
            judged.unpersist()

    return sink


def dimension_sink(table: SnapshotTable, rejects: str, op: str | None = None, audit: AuditTable | None = None) -> BatchSink:
    """Latest document per id."""
    return split_sink(
        lambda batch: dimension_changes(batch, op), lambda changes, _: table.upsert(changes), rejects, audit=audit
    )


def user_changes(batch: DataFrame) -> DataFrame:
    """User records as typed, labelled rows; rejected for the same reasons as those of other dimensions."""
    kept = require_ids(parse_payloads(positioned(batch).select("value", *POSITION)))
    users = kept.select("value", "reject_reason", *POSITION, *D.user_columns(F.col("payload")))
    return D.with_user_labels(users)


def user_dimension_sink(table: SnapshotTable, rejects: str, audit: AuditTable | None = None) -> BatchSink:
    """Latest typed row per user."""
    return split_sink(user_changes, lambda changes, _: table.upsert(changes), rejects, audit=audit)


def enriched_documents(batch: DataFrame, dims: ClueDimensions, place: str | None = None) -> DataFrame:
    """Clue records as index documents ``id, doc``; one without id is rejected."""
    clues = enrich_clues(parse_payloads(positioned(batch)), dims, ROW_KEY, place=place)
    no_id = F.when(F.col("id").isNull(), BAD_ID)
    return (
        clues.withColumn("id", P.get_string(F.col("payload"), "id"))
        .withColumn("reject_reason", F.coalesce(F.col("reject_reason"), no_id))
        .select("id", P.to_text(F.col("enriched")).alias("doc"), *POSITION, "value", "reject_reason")
    )


def enrichment_sink(
    open_dimensions: Callable[[], ClueDimensions], index: IndexTable | BatchSink, rejects: str, audit: AuditTable | None = None
) -> BatchSink:
    """Clue payloads to enriched documents in the index, with the dimensions of this moment.

    ``index`` is a table, or a writer of ``id, doc, position`` rows to another index. What a batch needs of a large
    dimension is kept in a folder until the batch is written.
    """
    write = index.write if isinstance(index, IndexTable) else index

    def sink(batch: DataFrame, key: str) -> None:
        with scratch(batch.sparkSession, "lookup") as place:
            judge = lambda records: enriched_documents(records, open_dimensions(), place)
            split_sink(judge, write, rejects, audit=audit)(batch, key)

    return sink


def folding(index: IndexTable, every: int | None = None) -> BatchSink:
    """Fold the batches of an index after each ``every``-th one (as many as it folds at once, without it)."""
    every = every or index.fanout

    def fold(_: DataFrame, key: str) -> None:
        if (int(key.rsplit("-", 1)[1]) + 1) % every == 0:
            index.fold()

    return fold


def oplog_sink(
    open_collection: Callable[[], DataFrame | SnapshotTable],
    followed: DataFrame,
    to: str | Publisher,
    cursors: SnapshotTable,
    on: Sequence[str],
    rejects: str | None = None,
    on_counts: Callable[[str, Mapping[str, int]], None] = log_outcome,
    frontier: Frontier | None = None,
) -> BatchSink:
    """Log entries to envelopes on the change topic, then the cursor per shard.

    Entries without document or key are kept below ``rejects`` and counted. The batch is read once and the judged
    entries are kept for all that is taken from them. Messages carry an id as those of the router do. Of a collection that is a table with the keys ``on``, only the
    buckets of the batch's documents are read. With a ``frontier``, entries wait until no shard can give an older one, and
    the messages of a document go out in order.
    """
    publish = _publisher(to)

    def current(entries: DataFrame) -> DataFrame:
        collection = open_collection()
        if not isinstance(collection, SnapshotTable):
            return collection
        return collection.lookup(entries.filter(F.col("op").isin("u", "d")).select(*on))

    def capture(batch: DataFrame, key: str) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        step = frontier.step(batch, key) if frontier else None
        judged = judged_entries(step.released if step else batch, followed).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counts = judged.agg(*outcome_counts()).first().asDict()
            if rejects:
                unusable = rejected(judged).select(
                    "ts", "ns", "op", "shard", "reject_reason", P.to_text(F.col("o")).alias("o"), P.to_text(F.col("o2")).alias("o2")
                )
                unusable.write.mode("overwrite").parquet(f"{rejects}/batch={key}")
            messages = capture_entries(accepted(judged), current(accepted(judged)), on)
            identity = message_id("oplog", *(F.col(c) for c in ("ts", "ns", "type", "doc_id")))
            messages = messages.withColumns({"topic": F.lit(V.CHANGE_TOPIC), MESSAGE_ID: identity})
            publish(in_order(messages) if step else messages, key)
            if step:
                frontier.commit(step)
            cursors.upsert(high_water_mark(batch, ["shard"]))
            on_counts(key, counts)
        finally:
            judged.unpersist()
            batch.unpersist()

    return capture


def start_all(
    streams: Mapping[str, tuple[DataFrame, BatchSink]], checkpoints: str, seconds: int | None = None
) -> dict[str, StreamingQuery]:
    """Several pipelines in one session, each with a checkpoint of its own."""
    return {
        name: start(records, sink, f"{checkpoints}/{name}", name, seconds)
        for name, (records, sink) in streams.items()
    }


def await_all(queries: Mapping[str, StreamingQuery]) -> None:
    for query in queries.values():
        query.awaitTermination()
