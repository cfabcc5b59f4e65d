"""CRM-shaped inputs over the given tables: as DataFrames, and as SQL for the comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.functions import payload as P
from tidegate.sources.spread import spread_few_pieces

# Records before this moment play the part of what was processed earlier.
SPLIT_TIME = "2024-01-15 00:00:00"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def work_table(spark: SparkSession, sf: str, name: str, key: str) -> DataFrame:
    """A table whose rows are costly to process."""
    return spread_few_pieces(table(spark, sf, name), key)


def table_stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The table as a stream of files. The glob lets the table be one file or a folder of them."""
    schema = table(spark, sf, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parque[t]")


# ---- dimensions -----------------------------------------------------------------------------

USERS = [
    "c_custkey as id",
    "c_name as real_name",
    "cast(c_custkey%3 as int) as status",
    "cast(c_custkey%4 as int) as gender",
    "cast(c_custkey%3 as int) as change_pass",
]

USER_DOC = (
    """concat('{"id":',c_custkey,',"realName":"',c_name,'","status":',c_custkey%3,"""
    """',"gender":',c_custkey%4,',"changePass":',c_custkey%3,',"password":"-"}')"""
)


def users(spark, sf):
    return table(spark, sf, "customer").filter("c_custkey%10<>9").selectExpr(*USERS)


def seas(spark, sf):
    return table(spark, sf, "nation").selectExpr(
        "cast(n_nationkey as string) as id",
        "case when n_nationkey%5=4 then '  ' else n_name end as public_seas_name",
    )


def fields(spark, sf):
    return (
        table(spark, sf, "region")
        .selectExpr(
            "r_regionkey",
            "explode(array(struct(1 as field_id,'orderStatus' as field_key),"
            "struct(2 as field_id,'orderPriority' as field_key))) as f",
        )
        .filter("not (r_regionkey=2 and f.field_id=2)")
        .selectExpr(
            "cast(r_regionkey*10+f.field_id as int) as id", "r_regionkey as tenant_id", "f.field_id", "f.field_key"
        )
    )


def params(spark, sf):
    """Each code that orders use, for each of the five regions."""
    codes = (
        table(spark, sf, "orders")
        .selectExpr(
            "explode(array(struct(1 as field_id,o_orderstatus as param_id),"
            "struct(2 as field_id,o_orderpriority as param_id))) as p"
        )
        .select("p.*")
        .distinct()
    )
    regions = table(spark, sf, "region").agg(F.collect_set("r_regionkey").alias("keys"))
    return codes.withColumn("tenant_id", F.explode(regions.scalar())).selectExpr(
        "tenant_id",
        "field_id",
        "param_id",
        "case when param_id='P' then '' else concat('D',tenant_id,'_',param_id) end as display",
    )


def params_dup(spark, sf):
    return (
        table(spark, sf, "region")
        .selectExpr("r_regionkey", "explode(array(1,2,3)) as n")
        .selectExpr(
            "cast(r_regionkey*10+n as int) as id",
            "r_regionkey as tenant_id",
            "1 as field_id",
            "concat('D',r_regionkey,'_v',n) as display",
        )
    )


# ---- clues ----------------------------------------------------------------------------------

CLUES = [
    "o_orderkey as id",
    "cast(o_orderkey%6 as int) as tenant_id",
    "cast(o_custkey%30 as string) as public_sea_id",
    "case when o_orderkey%4=0 then null else o_custkey end as creator_id",
    "o_orderkey%2000 as last_charger",
    "(o_custkey*7+3)%1500 as belong_to_id",
    "o_orderstatus as order_status",
    "case when o_orderkey%9=0 then ' ' else o_orderpriority end as order_priority",
]

CLUE_DOC = (
    """concat('{"id":"',o_orderkey,'","tenantId":',o_orderkey%6,',"publicSeaId":"',o_custkey%30,"""
    """'","creatorId":',case when o_orderkey%4=0 then 'null' else cast(o_custkey as string) end,"""
    """',"lastCharger":',o_orderkey%2000,',"belongToId":',(o_custkey*7+3)%1500,"""
    """',"orderStatus":"',o_orderstatus,'","orderPriority":"',"""
    """case when o_orderkey%9=0 then ' ' else o_orderpriority end,'"}')"""
)


def clues(spark, sf):
    return table(spark, sf, "orders").selectExpr(*CLUES)


def clue_docs(spark, sf):
    return work_table(spark, sf, "orders", "o_orderkey").selectExpr("o_orderkey as id", f"{CLUE_DOC} as doc")


def clue_payloads(spark, sf):
    """Clue documents parsed: ``id``, ``payload``."""
    return clue_docs(spark, sf).select("id", P.parse_object(F.col("doc")).alias("payload"))


# ---- change streams -------------------------------------------------------------------------


def _envelope(table_case: str) -> str:
    return (
        """case when event_id%17=0 then null when event_id%19=0 then '{bad' else """
        """concat('{"database":"crm","type":"',case cast(event_id%3 as int) when 0 then 'insert' """
        """when 1 then 'update' else 'delete' end,'","table":"',"""
        f"""{table_case},'","data":',case when event_id%11=0 then '{{}}' """
        """when event_id%13=0 then 'null' else props end,'}') end"""
    )


ENVELOPE = _envelope(
    "case event_type when 'purchase' then concat('saas_clue.',user_id%6) "
    "when 'view' then concat('saas_opport.',user_id%6) when 'signup' then 'sys_user2' "
    "when 'click' then 'saas_clue' else 'unlisted' end"
)
OP_ENVELOPE = _envelope(
    "case event_type when 'purchase' then 'order_info' when 'view' then 'order_detail' "
    "when 'signup' then 'user_info' when 'click' then 'sku_info' else 'unlisted' end"
)


def envelopes(spark, sf):
    return work_table(spark, sf, "events", "event_id").selectExpr("event_id", f"{ENVELOPE} as value")


def op_envelopes(spark, sf):
    return work_table(spark, sf, "events", "event_id").selectExpr("event_id", f"{OP_ENVELOPE} as value")


RECORDS = [
    "cast(user_id as string) as key",
    "props as value",
    "concat('ods_',event_type) as topic",
    "cast(user_id%3 as int) as partition",
    "event_id as offset",
    "ts as timestamp",
]


def records(spark, sf):
    """Records in the layout of a Kafka source."""
    return table(spark, sf, "events").selectExpr(*RECORDS)


def record_stream(spark, sf):
    return table_stream(spark, sf, "events").selectExpr(*RECORDS)


def record_columns(frame: DataFrame, *extra: str) -> DataFrame:
    return frame.select(
        "topic",
        F.col("partition").alias("partition_id"),
        F.col("offset").alias("record_offset"),
        F.col("key").alias("record_key"),
        "value",
        *extra,
    )


DIM_DOC = """concat('{"id":',user_id,',"event":"',event_type,'","seq":',event_id,'}')"""


def with_position(frame: DataFrame, topic: str, offset: str) -> DataFrame:
    """Messages as records of a one-partition topic, at the position ``offset``."""
    return frame.withColumns(
        {
            "topic": F.lit(topic),
            "partition": F.lit(0),
            "offset": F.col(offset).cast("bigint"),
            "timestamp": F.timestamp_seconds(F.col(offset)),
        }
    )


# ---- operation log --------------------------------------------------------------------------

OPLOG = [
    "event_id as ts",
    "case event_type when 'signup' then 'i' when 'purchase' then 'u' when 'click' then 'u' "
    "when 'error' then 'd' else 'n' end as op",
    "case when user_id%4=3 then 'crm.other.1' else concat('crm.saas_clue.',user_id%6) end as ns",
    """case event_type when 'signup' then concat('{"_id":',user_id,',"score":',event_id%100,'}') """
    """when 'error' then concat('{"_id":',user_id,'}') """
    """else concat('{"$set":{"score":',event_id%100,'}}') end as o""",
    """concat('{"_id":',user_id,'}') as o2""",
]

OTHER_SHARD = [
    "o_orderkey as ts",
    "'i' as op",
    "concat('crm.saas_customer.',o_custkey%6) as ns",
    """concat('{"_id":',o_custkey,',"score":',o_orderkey%100,'}') as o""",
    """concat('{"_id":',o_custkey,'}') as o2""",
]

COLLECTION = (
    "case event_type when 'purchase' then concat('saas_clue.',user_id%6) "
    "when 'view' then concat('saas_customer.',user_id%6) when 'signup' then 'sys_user2' "
    "when 'click' then 'saas_record_x' else '  ' end"
)


def _parsed_log(frame: DataFrame) -> DataFrame:
    return frame.select(
        "ts", "op", "ns", P.parse_object(F.col("o")).alias("o"), P.parse_object(F.col("o2")).alias("o2")
    )


def oplog(spark, sf):
    return _parsed_log(table(spark, sf, "events").selectExpr(*OPLOG))


def oplog_stream(spark, sf):
    return _parsed_log(table_stream(spark, sf, "events").selectExpr(*OPLOG))


def other_shard(spark, sf):
    return _parsed_log(table(spark, sf, "orders").selectExpr(*OTHER_SHARD))


def collections(spark, sf):
    return table(spark, sf, "events").selectExpr(f"{COLLECTION} as name").distinct()


def current_docs(spark, sf):
    """Current documents: ``doc_id`` as text, the document with its key, ``name``."""
    held = table(spark, sf, "customer").filter("c_custkey%5<>0")
    return held.select(
        F.col("c_custkey").cast("string").alias("doc_id"),
        F.create_map(
            F.lit("_id"), F.col("c_custkey").cast("variant"), F.lit("name"), F.col("c_name").cast("variant")
        ).alias("doc"),
        F.col("c_name").alias("name"),
    )


# ---- the same as SQL ------------------------------------------------------------------------

VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "users": (f"select {', '.join(USERS)} from customer where c_custkey%10<>9", ()),
    "seas": (
        "select cast(n_nationkey as string) as id, "
        "case when n_nationkey%5=4 then '  ' else n_name end as public_seas_name from nation",
        (),
    ),
    "fields": (
        "select cast(r_regionkey*10+f.field_id as int) as id, r_regionkey as tenant_id, f.field_id, "
        "f.field_key from region cross join (select 1 as field_id,'orderStatus' as field_key union all "
        "select 2,'orderPriority') f where not (r_regionkey=2 and f.field_id=2)",
        (),
    ),
    "params": (
        "select r_regionkey as tenant_id, p.field_id, p.param_id, case when p.param_id='P' then '' else "
        "concat('D',r_regionkey,'_',p.param_id) end as display from region cross join (select distinct 1 "
        "as field_id,o_orderstatus as param_id from orders union all select distinct 2,o_orderpriority "
        "from orders) p",
        (),
    ),
    "params_dup": (
        "select cast(r_regionkey*10+k.n as int) as id, r_regionkey as tenant_id, 1 as field_id, "
        "concat('D',r_regionkey,'_v',k.n) as display from region cross join (select 1 as n union all "
        "select 2 union all select 3) k",
        (),
    ),
    "clues": (f"select {', '.join(CLUES)} from orders", ()),
    "clue_docs": (f"select o_orderkey as id, {CLUE_DOC} as doc from orders", ()),
    "user_docs": (f"select c_custkey as id, {USER_DOC} as doc from customer", ()),
    "envelopes": (f"select event_id, {ENVELOPE} as value from events", ()),
    "op_envelopes": (f"select event_id, {OP_ENVELOPE} as value from events", ()),
    "kafka_like": (
        "select concat('ods_',event_type) as topic, cast(user_id%3 as int) as partition_id, "
        "event_id as record_offset, ts as record_ts, cast(user_id as string) as record_key, "
        "props as value from events",
        (),
    ),
    "dim_docs": (f"select event_id, user_id as id, {DIM_DOC} as doc from events", ()),
    "oplog": (f"select user_id as doc_id, {', '.join(OPLOG)} from events", ()),
    "other_shard": (f"select {', '.join(OTHER_SHARD)} from orders", ()),
    "collections": (f"select distinct {COLLECTION} as name from events", ()),
    "current_docs": (
        "select c_custkey as doc_id, c_name as name from customer where c_custkey%5<>0",
        (),
    ),
    # Steps that several comparisons share.
    "namespaces": (
        "select distinct concat('crm.',name) as ns from collections where "
        + " or ".join(
            f"starts_with(name,'{t}')"
            for t in ("saas_clue", "saas_customer", "saas_contact", "saas_opport", "saas_agreement", "saas_record")
        ),
        ("collections",),
    ),
    "parsed": (
        "select event_id, value, json_extract_string(value,'$.type') as op_type, "
        "json_extract_string(value,'$.table') as table_name, "
        "nullif(cast(json_extract(value,'$.data') as varchar),'null') as data "
        "from (select event_id, case when json_valid(value) then value end as value from envelopes) "
        "where value is not null",
        ("envelopes",),
    ),
    "routed": (
        "select event_id, table_name, op_type, data, "
        "case when table_name='sys_user2' then table_name else regexp_extract(table_name,'^(.*)\\.([^.]*)$',1) "
        "end as base_table, case when table_name<>'sys_user2' then "
        "cast(regexp_extract(table_name,'^(.*)\\.([^.]*)$',2) as int) end as tenant_id "
        "from parsed where data is not null and data<>'{}' and (table_name='sys_user2' "
        "or starts_with(table_name,'saas_clue.') or starts_with(table_name,'saas_opport.'))",
        ("parsed",),
    ),
    "messages": (
        "select event_id, op_type, concat('ods_',base_table) as topic, case when tenant_id is null then data else "
        "concat(substr(data,1,length(data)-1),',\"tenantId\":',tenant_id,'}') end as value from routed",
        ("routed",),
    ),
    "keyed_params": (
        "select p.*, f.field_key from params p left join fields f on p.tenant_id=f.tenant_id "
        "and p.field_id=f.field_id",
        ("params", "fields"),
    ),
    "clue_names": (
        "select c.*, ps.display as order_status_name, pp.display as order_priority_name, "
        "s.public_seas_name, u1.real_name as creator_id_name, u2.real_name as last_charger_name, "
        "u3.real_name as belong_to_id_name from clues c "
        "left join keyed_params ps on ps.tenant_id=c.tenant_id and ps.field_key='orderStatus' "
        "and ps.param_id=c.order_status and trim(ps.display)<>'' "
        "left join keyed_params pp on pp.tenant_id=c.tenant_id and pp.field_key='orderPriority' "
        "and pp.param_id=c.order_priority and trim(pp.display)<>'' "
        "left join seas s on s.id=c.public_sea_id and trim(s.public_seas_name)<>'' "
        "left join users u1 on u1.id=c.creator_id left join users u2 on u2.id=c.last_charger "
        "left join users u3 on u3.id=c.belong_to_id",
        ("clues", "keyed_params", "seas", "users"),
    ),
    "enriched_docs": (
        "select id, concat(substr(doc,1,length(doc)-1), "
        + ", ".join(
            f"case when {column} is null then '' else concat(',\"{key}\":\"',{column},'\"') end"
            for key, column in (
                ("orderPriorityName", "order_priority_name"),
                ("orderStatusName", "order_status_name"),
                ("publicSeasName", "public_seas_name"),
                ("creatorIdName", "creator_id_name"),
                ("lastChargerName", "last_charger_name"),
                ("belongToIdName", "belong_to_id_name"),
            )
        )
        + ",'}') as doc from clue_docs join clue_names using (id)",
        ("clue_docs", "clue_names"),
    ),
    "followed_log": ("select * from oplog where ns in (select ns from namespaces)", ("oplog", "namespaces")),
}


def with_views(body: str, names: tuple[str, ...]) -> str:
    """SQL text of a comparison with the views it uses, in order of need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in VIEWS[name][1]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return body
    views = ",\n".join(f"{name} as ({VIEWS[name][0]})" for name in ordered)
    return f"with {views}\n{body}"
