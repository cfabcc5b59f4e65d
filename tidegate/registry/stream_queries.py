"""Queries of the streaming pipelines: each runs over what is there and returns what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.operators import oplog as O
from tidegate.registry import inputs as I
from tidegate.registry.core import query
from tidegate.registry.join_queries import OPLOG_ENVELOPES_SQL, clue_dimensions
from tidegate.sinks.publish import MESSAGE_ID
from tidegate.sinks.tables import IndexTable, SnapshotTable
from tidegate.sources.change_stream import file_stream, once
from tidegate.streaming import pipelines as S
from tidegate.streaming.frontier import Frontier
from tidegate.workspace import workspace

LATEST_DIM_SQL = """select cast(id as int) as id, doc from dim_docs
qualify row_number() over (partition by id order by event_id desc) = 1"""


def dimension_stream(spark, sf):
    docs = I.table_stream(spark, sf, "events").selectExpr("event_id", f"{I.DIM_DOC} as value")
    return I.with_position(docs, "ods_dim", "event_id")


def dimension_table(spark, path):
    return SnapshotTable(spark, path, ["id"], list(S.POSITION))


def append_sink(folder):
    def append(batch, key):
        batch.write.mode("overwrite").parquet(f"{folder}/batch={key}")

    return append


@query(
    "stream_micro_batch",
    "select topic, partition_id, count(*) as records, max(record_offset)+1 as until_offset from kafka_like group by all",
    ("kafka_like",),
)
def stream_micro_batch(spark, sf):
    folder = workspace(spark, "micro-batch")
    S.start(I.record_stream(spark, sf), append_sink(f"{folder}/out"), f"{folder}/checkpoint").awaitTermination()
    written = spark.read.parquet(f"{folder}/out")
    return written.groupBy("topic", F.col("partition").alias("partition_id")).agg(
        F.count(F.lit(1)).alias("records"), (F.max("offset") + 1).alias("until_offset")
    )


@query(
    "stream_resume",
    "select topic, partition_id, record_offset, value from kafka_like",
    ("kafka_like",),
)
def stream_resume(spark, sf):
    """A second start with the same checkpoint goes on behind what the first has written."""
    folder = workspace(spark, "resume")
    for _ in range(2):
        stream = I.record_columns(I.record_stream(spark, sf)).drop("record_key")
        S.start(stream, append_sink(f"{folder}/out"), f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("batch")


@query("stream_replay_idempotent", LATEST_DIM_SQL, ("dim_docs",))
def stream_replay_idempotent(spark, sf):
    """Two queries with checkpoints of their own bring every record twice."""
    folder = workspace(spark, "replay")
    table = dimension_table(spark, f"{folder}/dim")
    for run in ("first", "again"):
        sink = S.dimension_sink(table, f"{folder}/rejects-{run}")
        S.start(dimension_stream(spark, sf), sink, f"{folder}/checkpoint-{run}").awaitTermination()
    return table.read().select("id", "doc")


@query(
    "stream_enrich",
    "select cast(id as varchar) as id, doc from enriched_docs",
    ("enriched_docs",),
)
def stream_enrich(spark, sf):
    folder = workspace(spark, "enrich")
    docs = I.table_stream(spark, sf, "orders").selectExpr("o_orderkey", f"{I.CLUE_DOC} as value")
    index = IndexTable(spark, f"{folder}/index", ["id"], list(S.POSITION))
    sink = S.enrichment_sink(lambda: clue_dimensions(spark, sf), index, f"{folder}/rejects")
    records = I.with_position(docs, "ods_saas_clue", "o_orderkey")
    S.start(records, sink, f"{folder}/checkpoint").awaitTermination()
    return index.read().select("id", "doc")


DIMENSIONS = {
    "clue_saas_crm_customer_field": (
        "region",
        "r_regionkey",
        """concat('{"id":',r_regionkey,',"field_key":"',r_name,'"}')""",
    ),
    "clue_saas_crm_customer_param_field": (
        "supplier",
        "s_suppkey",
        """concat('{"id":',s_suppkey,',"display":"',s_name,'"}')""",
    ),
    "clue_saas_customer_public_sea": (
        "nation",
        "n_nationkey",
        """concat('{"id":',n_nationkey,',"public_seas_name":"',n_name,'"}')""",
    ),
    "saas_customer_public_sea": (
        "customer",
        "c_custkey",
        """concat('{"id":',c_custkey,',"public_seas_name":"',c_name,'"}')""",
    ),
}


@query(
    "stream_multi_dim",
    " union all ".join(
        f"select '{name}' as dimension, cast({key} as int) as id, {doc} as doc from {table}"
        for name, (table, key, doc) in DIMENSIONS.items()
    ),
)
def stream_multi_dim(spark, sf):
    folder = workspace(spark, "multi-dim")
    tables, streams = {}, {}
    for name, (source, key, doc) in DIMENSIONS.items():
        docs = I.table_stream(spark, sf, source).selectExpr(f"{doc} as value", f"{key} as n")
        tables[name] = dimension_table(spark, f"{folder}/{name}")
        sink = S.dimension_sink(tables[name], f"{folder}/rejects/{name}")
        streams[name] = (I.with_position(docs, f"ods_{name}", "n"), sink)
    S.await_all(S.start_all(streams, f"{folder}/checkpoints"))
    result = None
    for name, table in tables.items():
        part = table.read().select(F.lit(name).alias("dimension"), "id", "doc")
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "stream_router",
    """select topic, value from messages union all
    select 'rejected', value from envelopes where value is null or not json_valid(value)""",
    ("messages",),
)
def stream_router(spark, sf):
    folder = workspace(spark, "router")
    envelopes = I.table_stream(spark, sf, "events").selectExpr("event_id", f"{I.ENVELOPE} as value")
    records = I.with_position(envelopes, "changes", "event_id")
    S.start(records, S.router_sink(f"{folder}/topics"), f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/topics").select("topic", "value")


@query(
    "stream_publish_replayed",
    """select topic, value from messages union all
    select 'rejected', value from envelopes where value is null or not json_valid(value)""",
    ("messages",),
)
def stream_publish_replayed(spark, sf):
    """Two routers bring every message twice to one log, whose reader takes each once."""
    folder = workspace(spark, "replayed")
    envelopes = I.table_stream(spark, sf, "events").selectExpr("event_id", f"{I.ENVELOPE} as value")
    records = I.with_position(envelopes, "changes", "event_id")
    columns = ("topic", "key", "value", "partition", "offset", MESSAGE_ID)

    def append(messages, _):
        messages.select(*columns).write.mode("append").parquet(f"{folder}/log")

    for run in ("first", "again"):
        S.start(records, S.router_sink(append), f"{folder}/checkpoint-{run}").awaitTermination()
    schema = "topic string, key string, value string, partition int, offset bigint, message_id string"
    log = file_stream(spark, f"{folder}/log", schema)
    S.start(once(log), append_sink(f"{folder}/out"), f"{folder}/checkpoint-reader").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("topic", "value")


@query("stream_dim_upsert", LATEST_DIM_SQL, ("dim_docs",))
def stream_dim_upsert(spark, sf):
    folder = workspace(spark, "dim-stream")
    table = dimension_table(spark, f"{folder}/dim")
    sink = S.dimension_sink(table, f"{folder}/rejects")
    S.start(dimension_stream(spark, sf), sink, f"{folder}/checkpoint").awaitTermination()
    return table.read().select("id", "doc")


@query("stream_oplog", OPLOG_ENVELOPES_SQL, ("followed_log", "current_docs"))
def stream_oplog(spark, sf):
    folder = workspace(spark, "oplog")
    log = I.oplog_stream(spark, sf).withColumn("shard", F.lit("shard1"))
    cursors = SnapshotTable(spark, f"{folder}/cursors", ["shard"], ["cursor_ts"])
    sink = S.oplog_sink(
        lambda: I.current_docs(spark, sf),
        O.namespaces(I.collections(spark, sf)),
        f"{folder}/topics",
        cursors,
        ["doc_id"],
    )
    S.start(log, sink, f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/topics").select("ts", "ns", "type", "doc_id", "value")


@query(
    "oplog_frontier",
    """select shard, ts, op, ns from (select 'shard1' as shard, ts, op, ns from oplog union all
    select 'shard2', ts, op, ns from other_shard)
    where ts <= least((select max(ts) from oplog), (select max(ts) from other_shard))""",
    ("oplog", "other_shard"),
)
def oplog_frontier(spark, sf):
    """One shard comes first and is held; the other releases both up to the lower of their ends."""
    folder = workspace(spark, "frontier")
    frontier = Frontier(spark, f"{folder}/state", ("shard1", "shard2"))
    columns = ("ts", "op", "ns")
    one = I.oplog(spark, sf).select(*columns, F.lit("shard1").alias("shard"))
    two = I.other_shard(spark, sf).select(*columns, F.lit("shard2").alias("shard"))
    for key, batch in (("0", one), ("1", two)):
        step = frontier.step(batch, key)
        step.released.write.parquet(f"{folder}/out/batch={key}")
        frontier.commit(step)
    return spark.read.parquet(f"{folder}/out").select("shard", *columns)
