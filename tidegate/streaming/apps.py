"""The applications: which topics feed which tables, wired for one site."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate import fixed_values as V
from tidegate.functions import payload as P
from tidegate.operators.computed import with_computed
from tidegate.operators.ledger import positions_of, starting_offsets_option
from tidegate.operators.routing import route_by_table
from tidegate.plans.clue_enrichment import ClueDimensions
from tidegate.plans.derived_dimensions import DerivedDimensions
from tidegate.sinks.audit import AuditTable
from tidegate.sinks.publish import Publisher
from tidegate.sinks.tables import IndexTable, SnapshotTable
from tidegate.sources.change_stream import kafka_options, kafka_stream, once
from tidegate.sources.operation_log import EVERY_ROW, oplog_stream
from tidegate.streaming import pipelines as S
from tidegate.streaming.frontier import Frontier

FIELD_TABLE, PARAM_TABLE = V.FIELD_TABLE, V.PARAM_TABLE
CLUE_SEA_TABLE, CUSTOMER_SEA_TABLE = V.CLUE_SEA_TABLE, V.CUSTOMER_SEA_TABLE
USER_TABLE, CLUE_TABLE = V.USER_TABLE, V.CLUE_TABLE

DIMENSION_TABLES = (FIELD_TABLE, PARAM_TABLE, CLUE_SEA_TABLE, CUSTOMER_SEA_TABLE)


@dataclass(frozen=True)
class Site:
    """Where an installation reads and writes.

    ``open_stream`` gives the records of a topic, from Kafka or from files. Below ``root`` lie the
    tables, rejects and checkpoints. Without ``seconds`` a query runs over what is there and ends. What a table has
    replaced stays for ``hold_seconds``, and longer for readers with a lease. ``once_within`` (such as "1 hour") drops
    messages that come again within that time; the tables do without, as they take a repeat without effect.
    """

    spark: SparkSession
    open_stream: Callable[[str], DataFrame]
    root: str
    seconds: int | None = V.BATCH_SECONDS
    hold_seconds: float = 600.0
    once_within: str | None = None

    def table(self, name: str) -> SnapshotTable:
        place = f"{self.root}/dim/{name}"
        return SnapshotTable(self.spark, place, ["id"], list(S.POSITION), hold_seconds=self.hold_seconds)

    def index(self, name: str) -> IndexTable:
        place = f"{self.root}/index/{name}"
        return IndexTable(self.spark, place, ["id"], list(S.POSITION), hold_seconds=self.hold_seconds)

    def rejects(self, name: str) -> str:
        return f"{self.root}/rejects/{name}"

    def audit(self, name: str) -> AuditTable:
        """Outcome counts of the batches of an application."""
        return AuditTable(self.spark, f"{self.root}/audit/{name}")

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def positions(self, topic: str) -> SnapshotTable:
        """The ledger of a topic; it has one writer, the query that reads the topic."""
        return saved_positions(self.spark, self.root, topic)

    def start(self, name: str, records: DataFrame, sink: S.BatchSink) -> StreamingQuery:
        return S.start(records, sink, self.checkpoint(name), name, self.seconds)

    def start_topic(self, name: str, topic: str, sink: S.BatchSink) -> StreamingQuery:
        """Run ``sink`` over a topic; the positions of a batch are saved after it."""
        records = self.open_stream(topic)
        if self.once_within:
            records = once(records, self.once_within)
        return self.start(name, records, S.with_positions(sink, self.positions(topic), V.group_of(topic)))


def saved_positions(spark: SparkSession, root: str, topic: str) -> SnapshotTable:
    return S.positions_table(spark, f"{root}/positions/{topic}")


def topic_start(spark: SparkSession, root: str, topic: str, partitions: DataFrame | None = None) -> str:
    """``startingOffsets`` of a topic: behind the saved positions, else the latest record.

    ``partitions`` (topic, partition_id) are those that the topic has now. The option only counts for a query
    without checkpoint.
    """
    saved = saved_positions(spark, root, topic).state()
    if saved is None:
        return "latest"
    return starting_offsets_option(positions_of(saved, topic, V.group_of(topic)), "latest", partitions)


def kafka_topics(
    spark: SparkSession,
    servers: str,
    root: str,
    partitions_of: Callable[[str], DataFrame] | None = None,
    max_offsets_per_trigger: int | None = None,
) -> Callable[[str], DataFrame]:
    """``open_stream`` of a site with a broker."""

    def open_stream(topic: str) -> DataFrame:
        begin = topic_start(spark, root, topic, partitions_of(topic) if partitions_of else None)
        return kafka_stream(
            spark, kafka_options(servers, topic, None, begin, max_offsets_per_trigger)
        )

    return open_stream


def start_router(
    site: Site,
    topics: str | Publisher,
    topic: str = V.CHANGE_TOPIC,
    route: Callable[[DataFrame], DataFrame] = route_by_table,
) -> StreamingQuery:
    """The change topic to one topic per table."""
    return site.start_topic("router", topic, S.router_sink(topics, route, audit=site.audit("router")))


def start_dimensions(
    site: Site, tables: Sequence[str] = DIMENSION_TABLES
) -> dict[str, StreamingQuery]:
    """One query per dimension table, all in this session."""
    return {
        table: site.start_topic(
            table,
            V.ods_topic(table),
            S.dimension_sink(site.table(table), site.rejects(table), audit=site.audit(table)),
        )
        for table in tables
    }


def start_users(site: Site) -> StreamingQuery:
    sink = S.user_dimension_sink(site.table(USER_TABLE), site.rejects(USER_TABLE), site.audit(USER_TABLE))
    return site.start_topic(USER_TABLE, V.ods_topic(USER_TABLE), sink)


def dimension_rows(site: Site, table: str, columns: Sequence[str]) -> DataFrame:
    """Chosen keys of a dimension's documents as text beside ``id``; no rows before its first batch."""
    snapshot = site.table(table)
    if snapshot.state() is None:
        texts = ", ".join(f"{c} string" for c in columns)
        return site.spark.createDataFrame([], f"id int, {texts}")
    parsed = with_computed(snapshot.read().select("id", "doc"), _obj=P.parse_object(F.col("doc")))
    return parsed.select("id", *(P.get_string(F.col("_obj"), c).alias(c) for c in columns))


def clue_dimensions(site: Site) -> ClueDimensions:
    """The dimensions of clues as they are now."""
    users = site.table(USER_TABLE)
    known = users.state() is not None
    if known:
        names = users.read().select("id", F.col("realName").alias("real_name"))
    else:
        names = site.spark.createDataFrame([], "id int, real_name string")
    return ClueDimensions.from_tables(
        dimension_rows(site, PARAM_TABLE, ("tenant_id", "field_id", "param_id", "display")),
        dimension_rows(site, FIELD_TABLE, ("tenant_id", "field_id", "field_key")),
        dimension_rows(site, CLUE_SEA_TABLE, ("public_seas_name",)),
        names,
        (lambda ids: users.lookup(ids).select("id", F.col("realName").alias("name"))) if known else None,
    )


def derived_clue_dimensions(site: Site) -> DerivedDimensions:
    """As ``clue_dimensions``, derived once per version of the tables."""
    tables = {"params": PARAM_TABLE, "fields": FIELD_TABLE, "seas": CLUE_SEA_TABLE, "users": USER_TABLE}

    def versions() -> dict[str, int]:
        return {name: site.table(table).newest_version() for name, table in tables.items()}

    return DerivedDimensions(site.spark, f"{site.root}/derived/{CLUE_TABLE}", versions, lambda: clue_dimensions(site))


def start_clues(site: Site, index: IndexTable | S.BatchSink | None = None) -> StreamingQuery:
    """Clues to enriched documents in the index: the site's own table, or what the given writer fills.

    The batches of a table are folded as they come.
    """
    index = site.index(CLUE_TABLE) if index is None else index
    sink = S.enrichment_sink(derived_clue_dimensions(site).current, index, site.rejects(CLUE_TABLE), site.audit(CLUE_TABLE))
    if isinstance(index, IndexTable):
        sink = S.in_turn(sink, S.folding(index))
    return site.start_topic(CLUE_TABLE, V.ods_topic(CLUE_TABLE), sink)


def start_oplog(
    site: Site,
    log: str | DataFrame,
    open_collection: Callable[[], DataFrame | SnapshotTable],
    followed: DataFrame,
    topics: str | Publisher,
    on: Sequence[str] = ("ns", "doc_id"),
    checkpoint: str | None = None,
    shards: Sequence[str] | None = None,
    quiet_seconds: float | None = None,
) -> StreamingQuery:
    """Operation-log entries of all shards (``shard`` names them) to the change topic.

    ``log`` is a folder of log files, or a stream of entries. The folder is read in bounded reads; without a checkpoint
    they begin behind the cursors that were saved. With ``shards``, the names of all shards, an entry waits until none of them
    can give an older one (see ``Frontier``).
    """
    cursors = SnapshotTable(site.spark, f"{site.root}/cursors", ["shard"], ["cursor_ts"])
    frontier = Frontier(site.spark, f"{site.root}/frontier", shards, quiet_seconds) if shards else None
    sink = S.oplog_sink(open_collection, followed, topics, cursors, on, site.rejects("oplog"), frontier=frontier)
    rows = V.OPLOG_READ_ROWS if site.seconds is not None else EVERY_ROW
    records = oplog_stream(site.spark, log, cursors.state(), rows) if isinstance(log, str) else log
    return S.start(records, sink, checkpoint or site.checkpoint("oplog"), "oplog", site.seconds)
