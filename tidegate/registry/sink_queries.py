"""Queries of the sinks: what is written is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.operators import chunks as C, envelopes as E, ledger as L, routing as R
from tidegate.registry import inputs as I
from tidegate.registry.core import query
from tidegate.sinks.audit import write_audit
from tidegate.sinks.publish import publish_to_files
from tidegate.sinks.tables import IndexTable, SnapshotTable
from tidegate.streaming.pipelines import POSITION, dimension_changes, positions_table, user_changes
from tidegate.workspace import workspace


@query("sink_publish_by_topic", "select topic, value from messages", ("messages",))
def sink_publish_by_topic(spark, sf):
    folder = workspace(spark, "publish")
    routed = R.route_by_table(E.parse_envelopes(I.envelopes(spark, sf)))
    publish_to_files(R.publishable(routed).drop("key"), folder)
    return spark.read.parquet(folder).select("topic", "value")


@query(
    "sink_publish_keyed",
    "select topic, record_key as key, value from kafka_like",
    ("kafka_like",),
)
def sink_publish_keyed(spark, sf):
    folder = workspace(spark, "publish-keyed")
    publish_to_files(I.records(spark, sf).select("topic", "key", "value"), folder)
    return spark.read.parquet(folder).select("topic", "key", "value")


def dimension_records(spark, sf):
    docs = I.table(spark, sf, "events").selectExpr("event_id", "ts", f"{I.DIM_DOC} as value")
    return I.with_position(docs, "ods_dim", "event_id").withColumn("timestamp", F.col("ts"))


@query(
    "sink_dim_upsert",
    """select cast(id as int) as id, doc from dim_docs
    qualify row_number() over (partition by id order by event_id desc) = 1""",
    ("dim_docs",),
)
def sink_dim_upsert(spark, sf):
    """An earlier part first, then everything: the repeated rows change nothing."""
    changes = E.accepted(dimension_changes(dimension_records(spark, sf))).drop("value", "reject_reason")
    dimension = SnapshotTable(spark, workspace(spark, "dim"), ["id"], list(POSITION))
    dimension.upsert(changes.filter(F.col("timestamp") < I.SPLIT_TIME))
    dimension.upsert(changes)
    return dimension.read().select("id", "doc")


@query(
    "sink_user_dim_upsert",
    """select cast(c_custkey as int) as id, c_name as real_name,
    case c_custkey%3 when 1 then '冻结' when 0 then '非冻结' end as status_name,
    case c_custkey%4 when 0 then '神秘人' when 1 then '男' when 2 then '女' end as gender_name,
    case c_custkey%3 when 0 then '未改过密码' when 1 then '改过密码' end as change_pass_name from customer""",
)
def sink_user_dim_upsert(spark, sf):
    customers = I.work_table(spark, sf, "customer", "c_custkey")
    now = I.with_position(
        customers.selectExpr(f"{I.USER_DOC} as value", "c_custkey + 1 as n"), "ods_sys_user2", "n"
    )
    before = customers.selectExpr(
        """concat('{"id":',c_custkey,',"realName":"before"}') as value""", "0 as n"
    )
    users = SnapshotTable(spark, workspace(spark, "users"), ["id"], list(POSITION))
    for batch in (I.with_position(before, "ods_sys_user2", "n"), now):
        users.upsert(E.accepted(user_changes(batch)).drop("value", "reject_reason"))
    return users.read().select(
        "id",
        F.col("realName").alias("real_name"),
        F.col("statusName").alias("status_name"),
        F.col("genderName").alias("gender_name"),
        F.col("changePassName").alias("change_pass_name"),
    )


@query("sink_index_upsert", "select id, doc from clue_docs", ("clue_docs",))
def sink_index_upsert(spark, sf):
    """An older document of each id is replaced whole, also through a compaction."""
    docs = I.clue_docs(spark, sf)
    index = IndexTable(spark, workspace(spark, "index"), ["id"], ["version"])
    index.write(docs.select("id", F.lit('{"old":true}').alias("doc"), F.lit(0).alias("version")), "a-0")
    index.compact()
    index.write(docs.withColumn("version", F.lit(1)), "a-1")
    return index.read().select("id", "doc")


@query(
    "sink_chunks",
    """select topic, partition_id, chunk_id, count(*) as docs, min(record_offset) as first_offset,
    max(record_offset) as last_offset from (
      select *, cast((row_number() over (partition by topic, partition_id order by record_offset)-1)//1000 as bigint)
      as chunk_id from kafka_like) group by all""",
    ("kafka_like",),
)
def sink_chunks(spark, sf):
    chunked = C.with_chunks(I.records(spark, sf), ["topic", "partition"], "offset")
    return chunked.groupBy("topic", F.col("partition").alias("partition_id"), "chunk_id").agg(
        F.count(F.lit(1)).alias("docs"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


@query(
    "sink_offset_ledger",
    """select topic, concat(topic,'_group3') as group_id, partition_id, max(record_offset)+1 as until_offset
    from kafka_like group by all""",
    ("kafka_like",),
)
def sink_offset_ledger(spark, sf):
    """Positions of an earlier and of a later part in one ledger."""
    records = I.records(spark, sf)
    ledger = positions_table(spark, workspace(spark, "ledger"))
    earlier = F.col("timestamp") < I.SPLIT_TIME
    for part in (records.filter(~earlier), records.filter(earlier)):
        positions = L.until_offsets(part).withColumn("group_id", F.concat("topic", F.lit("_group3")))
        ledger.upsert(positions.select("topic", "group_id", "partition_id", "until_offset"))
    return ledger.read()


@query(
    "sink_write_audit",
    """select case when reason='' then 'ok' else 'failed' end as outcome, reason, count(*) as docs from (
      select case when value is null then 'null_record' when not json_valid(value) then 'malformed' else '' end
      as reason from envelopes) group by all""",
    ("envelopes",),
)
def sink_write_audit(spark, sf):
    return write_audit(R.route_by_table(E.parse_envelopes(I.envelopes(spark, sf))))
