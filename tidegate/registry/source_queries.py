"""Queries of the sources: change streams, operation log, dimensions, relations and positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate import fixed_values as V
from tidegate.operators import ledger as L, oplog as O
from tidegate.registry import inputs as I
from tidegate.registry.core import query
from tidegate.sinks.tables import SnapshotTable
from tidegate.sources.change_stream import of_topic
from tidegate.sources.dimension import read_dimension
from tidegate.sources.relational import as_json_objects
from tidegate.streaming.pipelines import start
from tidegate.workspace import workspace

RECORD_SQL = "topic, partition_id, record_offset, record_key, value"


def streamed(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    """What a stream over the data at hand writes, read back."""
    folder = workspace(spark, name)

    def append(batch: DataFrame, key: str) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={key}")

    start(frame, append, f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("batch")


@query("src_change_stream", f"select {RECORD_SQL} from kafka_like where topic='ods_purchase'", ("kafka_like",))
def src_change_stream(spark, sf):
    stream = of_topic(I.record_stream(spark, sf), V.ods_topic("purchase"))
    return streamed(spark, I.record_columns(stream), "change-stream")


@query(
    "src_change_stream_named",
    f"select {RECORD_SQL}, 'ods_view_group3' as group_id from kafka_like where topic='ods_view'",
    ("kafka_like",),
)
def src_change_stream_named(spark, sf):
    topic = V.ods_topic("view")
    stream = of_topic(I.record_stream(spark, sf), topic)
    named = I.record_columns(stream).withColumn("group_id", F.lit(V.group_of(topic)))
    return streamed(spark, named, V.group_of(topic))


@query(
    "src_resume_from_offsets",
    f"""select k.topic, k.partition_id, k.record_offset, k.record_key, k.value
    from kafka_like k left join (
      select topic, partition_id, max(record_offset)+1 as until_offset from kafka_like
      where record_ts < timestamp '{I.SPLIT_TIME}' and topic <> 'ods_error' group by all) s
    on s.topic = k.topic and s.partition_id = k.partition_id
    where k.record_offset >= coalesce(s.until_offset, 0)""",
    ("kafka_like",),
)
def src_resume_from_offsets(spark, sf):
    records = I.records(spark, sf)
    done = records.filter((F.col("timestamp") < I.SPLIT_TIME) & (F.col("topic") != "ods_error"))
    return I.record_columns(L.resume_from(records, L.until_offsets(done)))


def log_columns(log: DataFrame, *extra: str) -> DataFrame:
    return log.select(
        "ts", "op", "ns", F.to_json("o").alias("o"), F.to_json("o2").alias("o2"), *extra
    )


@query(
    "oplog_scan_full",
    "select ts, op, ns, o, o2 from followed_log where ts > (select min(ts) from oplog)",
    ("followed_log",),
)
def oplog_scan_full(spark, sf):
    log = I.oplog(spark, sf)
    followed = O.in_namespaces(log, O.namespaces(I.collections(spark, sf)))
    return log_columns(O.after_cursor(followed, O.start_cursor(log, None)))


@query(
    "oplog_scan_incremental",
    "select ts, op, ns, o, o2 from followed_log where ts > (select max(event_id) from events "
    f"where ts < timestamp '{I.SPLIT_TIME}')",
    ("followed_log",),
)
def oplog_scan_incremental(spark, sf):
    log = I.oplog(spark, sf)
    processed = I.table(spark, sf, "events").filter(F.col("ts") < I.SPLIT_TIME)
    saved = O.high_water_mark(processed.select(F.col("event_id").alias("ts")))
    followed = O.in_namespaces(log, O.namespaces(I.collections(spark, sf)))
    return log_columns(O.after_cursor(followed, O.start_cursor(log, saved)))


@query(
    "oplog_multi_shard",
    f"""select 'shard1' as shard, ts, op, ns from followed_log
    where ts > (select max(event_id) from events where ts < timestamp '{I.SPLIT_TIME}')
    union all
    select 'shard2', ts, op, ns from other_shard where ns in (select ns from namespaces)
    and ts > (select min(ts) from other_shard)""",
    ("followed_log", "other_shard"),
)
def oplog_multi_shard(spark, sf):
    """Two shards with a cursor each; only the first has a saved one."""
    one = I.oplog(spark, sf).withColumn("shard", F.lit("shard1"))
    two = I.other_shard(spark, sf).withColumn("shard", F.lit("shard2"))
    log = one.unionByName(two)
    processed = I.table(spark, sf, "events").filter(F.col("ts") < I.SPLIT_TIME)
    saved = O.high_water_mark(
        processed.select(F.col("event_id").alias("ts"), F.lit("shard1").alias("shard")), ["shard"]
    )
    cursors = O.start_cursor(log.select("shard", "ts"), saved, ["shard"])
    followed = O.in_namespaces(log, O.namespaces(I.collections(spark, sf)))
    return O.after_cursor(followed, cursors, ["shard"]).select("shard", "ts", "op", "ns")


@query("oplog_namespaces", "select ns from namespaces", ("namespaces",))
def oplog_namespaces(spark, sf):
    return O.namespaces(I.collections(spark, sf))


@query(
    "src_current_docs",
    "select cast(doc_id as varchar) as doc_id, name from current_docs "
    "where doc_id in (select doc_id from oplog where op in ('u','d'))",
    ("current_docs", "oplog"),
)
def src_current_docs(spark, sf):
    log = I.oplog(spark, sf).filter(F.col("op").isin("u", "d"))
    key = F.when(F.col("op") == "u", F.col("o2")).otherwise(F.col("o"))
    keyed = O.with_document_key(log, key)
    return O.touched_documents(keyed, I.current_docs(spark, sf), ["doc_id"]).select("doc_id", "name")


@query("src_dim_scan", "select id, real_name from users", ("users",))
def src_dim_scan(spark, sf):
    """The newest of two snapshots: all users, of which the second has the present names."""
    users = I.users(spark, sf).select("id", "real_name")
    folder = workspace(spark, "dim-scan")
    dimension = SnapshotTable(spark, folder, ["id"], ["version"])
    dimension.upsert(users.select("id", F.lower("real_name").alias("real_name"), F.lit(1).alias("version")))
    dimension.upsert(users.withColumn("version", F.lit(2)))
    return read_dimension(spark, folder).select("id", "real_name")


@query(
    "src_jdbc_query",
    """select concat('{"n_nationkey":',n_nationkey,',"n_name":"',n_name,'","customers":',customers,'}') as object
    from (select n_nationkey, n_name, count(c_custkey) as customers
          from nation left join customer on c_nationkey = n_nationkey group by all)""",
)
def src_jdbc_query(spark, sf):
    """The object form of a query's rows; here the relations are files, not a database."""
    customers = I.table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("c_custkey").alias("n"))
    rows = (
        I.table(spark, sf, "nation")
        .join(customers, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select("n_nationkey", "n_name", F.coalesce("n", F.lit(0)).alias("customers"))
    )
    return as_json_objects(rows)


@query(
    "src_jdbc_query_alt",
    """select concat('{"id":',id,',"real_name":"',real_name,'","creator":',
       case when id%3=0 then 'null' else cast(status as varchar) end,'}') as object from users""",
    ("users",),
)
def src_jdbc_query_alt(spark, sf):
    """As above for rows with NULL columns, which stay in the object."""
    users = I.users(spark, sf)
    return as_json_objects(
        users.select("id", "real_name", F.when(F.col("id") % 3 != 0, F.col("status")).alias("creator"))
    )


@query(
    "src_offset_ledger",
    """select topic, concat('{"',topic,'":{',string_agg(concat('"',partition_id,'":',until_offset), ','
       order by partition_id),'}}') as starting_offsets
    from (select topic, partition_id, max(record_offset)+1 as until_offset from kafka_like group by all)
    group by topic""",
    ("kafka_like",),
)
def src_offset_ledger(spark, sf):
    return L.starting_offsets(L.until_offsets(I.records(spark, sf)))


@query(
    "src_offset_ledger_jdbc",
    """select topic, partition_id, max(record_offset)+1 as until_offset from kafka_like
    where topic='ods_click' group by all""",
    ("kafka_like",),
)
def src_offset_ledger_jdbc(spark, sf):
    """Positions from rows in the layout of the relational ledger; here they are no database."""
    positions = L.until_offsets(I.records(spark, sf))
    rows = positions.select(
        F.concat("topic", F.lit(V.GROUP_SUFFIX)).alias("group_id"),
        "topic",
        F.col("until_offset").alias("topic_offset"),
        "partition_id",
    )
    return L.positions_from_rows(rows, V.ods_topic("click"), V.group_of(V.ods_topic("click")))
