"""Queries of projections, filters and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate import fixed_values as V
from tidegate.functions import payload as P
from tidegate.operators import dimensions as D, envelopes as E, oplog as O, routing as R
from tidegate.registry import inputs as I
from tidegate.registry.core import query


def parsed_envelopes(spark, sf):
    return E.parse_envelopes(I.envelopes(spark, sf))


@query(
    "pf_parse_json",
    """select event_id, case when value is null then null when json_valid(value)
       then cast(json(value) as varchar) end as object,
       case when value is null then 'null_record' when not json_valid(value) then 'malformed' end as reject_reason
    from envelopes""",
    ("envelopes",),
)
def pf_parse_json(spark, sf):
    rows = E.parse_payloads(I.envelopes(spark, sf))
    return rows.select("event_id", P.to_text(F.col("payload")).alias("object"), "reject_reason")


@query(
    "pf_drop_null",
    """select event_id, case when not json_valid(value) then 'malformed' end as reject_reason
    from envelopes where value is not null""",
    ("envelopes",),
)
def pf_drop_null(spark, sf):
    return E.non_null_records(parsed_envelopes(spark, sf)).select("event_id", "reject_reason")


@query("pf_envelope_fields", "select event_id, op_type, table_name, data from parsed", ("parsed",))
def pf_envelope_fields(spark, sf):
    return E.accepted(parsed_envelopes(spark, sf)).select(
        "event_id",
        F.col("type").alias("op_type"),
        F.col("table").alias("table_name"),
        P.to_text(F.col("data")).alias("data"),
    )


@query(
    "pf_nonempty_payload",
    "select event_id, data from parsed where data is not null and data <> '{}'",
    ("parsed",),
)
def pf_nonempty_payload(spark, sf):
    rows = E.non_empty_payloads(E.accepted(parsed_envelopes(spark, sf)))
    return rows.select("event_id", P.to_text(F.col("data")).alias("data"))


@query(
    "pf_exact_tables",
    "select event_id, table_name from parsed where table_name in ('sys_user2','t_country','t_province','t_city',"
    "'t_area','clue_saas_customer_public_sea','saas_customer_public_sea','clue_saas_crm_customer_field',"
    "'clue_saas_crm_customer_param_field','user')",
    ("parsed",),
)
def pf_exact_tables(spark, sf):
    rows = parsed_envelopes(spark, sf).filter(R.is_exact_table(F.col("table")))
    return rows.select("event_id", F.col("table").alias("table_name"))


@query(
    "pf_tenant_prefix",
    "select event_id, table_name from parsed where starts_with(table_name,'saas_clue.') or "
    "starts_with(table_name,'saas_customer.') or starts_with(table_name,'saas_contact.') or "
    "starts_with(table_name,'saas_opport.') or starts_with(table_name,'saas_agreement.') or "
    "starts_with(table_name,'saas_record.')",
    ("parsed",),
)
def pf_tenant_prefix(spark, sf):
    rows = parsed_envelopes(spark, sf).filter(R.has_tenant_prefix(F.col("table")))
    return rows.select("event_id", F.col("table").alias("table_name"))


@query(
    "pf_tenant_split",
    "select event_id, table_name, regexp_extract(table_name,'^(.*)\\.([^.]*)$',1) as base_table, "
    "cast(regexp_extract(table_name,'^(.*)\\.([^.]*)$',2) as int) as tenant_id "
    "from parsed where contains(table_name,'.')",
    ("parsed",),
)
def pf_tenant_split(spark, sf):
    table = F.col("table")
    rows = parsed_envelopes(spark, sf).filter(table.contains("."))
    return rows.select(
        "event_id",
        table.alias("table_name"),
        R.base_table(table).alias("base_table"),
        R.tenant_id(table).alias("tenant_id"),
    )


@query(
    "pf_inject_tenant",
    """select id, concat('{"id":"',id,'"',regexp_extract(doc,'(,"publicSeaId".*)\\}$',1),',"tenantId":',id%7,'}') as doc
    from clue_docs""",
    ("clue_docs",),
)
def pf_inject_tenant(spark, sf):
    """The tenant replaces the one that the payload has."""
    rows = I.clue_payloads(spark, sf)
    tenanted = P.put(F.col("payload"), V.TENANT_KEY, (F.col("id") % 7).cast("int"))
    return rows.select("id", P.to_text(tenanted).alias("doc"))


@query(
    "pf_topic_name",
    "select event_id, concat('ods_', table_name) as topic from parsed",
    ("parsed",),
)
def pf_topic_name(spark, sf):
    rows = E.accepted(parsed_envelopes(spark, sf))
    return rows.select("event_id", R.topic_name(F.col("table")).alias("topic"))


@query("change_router", "select event_id, topic, value from messages", ("messages",))
def change_router(spark, sf):
    return R.publishable(R.route_by_table(parsed_envelopes(spark, sf)), ["event_id"]).drop("key")


@query(
    "change_router_by_op",
    """select event_id, concat('ods_',table_name) as topic, data as value from (
      select event_id, json_extract_string(value,'$.type') as op_type,
      json_extract_string(value,'$.table') as table_name, cast(json_extract(value,'$.data') as varchar) as data
      from op_envelopes where value is not null and json_valid(value))
    where data not in ('null','{}') and (table_name in ('user_info','sku_info')
      or (table_name in ('order_info','order_detail') and op_type='insert'))""",
    ("op_envelopes",),
)
def change_router_by_op(spark, sf):
    routed = R.route_by_rules(E.parse_envelopes(I.op_envelopes(spark, sf)))
    return R.publishable(routed, ["event_id"]).drop("key")


def user_rows(spark, sf):
    records = I.table(spark, sf, "customer").selectExpr(f"{I.USER_DOC} as value")
    return D.typed_users(records)


@query(
    "pf_user_typed",
    """select cast(c_custkey as int) as id, c_name as real_name, cast(c_custkey%3 as int) as status,
    cast(c_custkey%4 as int) as gender, cast(c_custkey%3 as int) as change_pass, cast(null as varchar) as email
    from customer""",
)
def pf_user_typed(spark, sf):
    return user_rows(spark, sf).select(
        "id",
        F.col("realName").alias("real_name"),
        "status",
        "gender",
        F.col("changePass").alias("change_pass"),
        "email",
    )


@query(
    "pf_label_status",
    """select cast(c_custkey as int) as id, case c_custkey%3 when 1 then '冻结' when 0 then '非冻结' end as status_name
    from customer""",
)
def pf_label_status(spark, sf):
    return D.with_user_labels(user_rows(spark, sf)).select("id", F.col("statusName").alias("status_name"))


@query(
    "pf_label_gender",
    """select cast(c_custkey as int) as id, case c_custkey%4 when 0 then '神秘人' when 1 then '男' when 2 then '女' end
    as gender_name from customer""",
)
def pf_label_gender(spark, sf):
    return D.with_user_labels(user_rows(spark, sf)).select("id", F.col("genderName").alias("gender_name"))


@query(
    "pf_label_change_pass",
    """select cast(c_custkey as int) as id, case c_custkey%3 when 0 then '未改过密码' when 1 then '改过密码' end
    as change_pass_name from customer""",
)
def pf_label_change_pass(spark, sf):
    return D.with_user_labels(user_rows(spark, sf)).select(
        "id", F.col("changePassName").alias("change_pass_name")
    )


@query(
    "pf_ns_split",
    """select ts, split_part(ns,'.',1) as database, substr(ns,strpos(ns,'.')+1) as collection,
    split_part(ns,'.',2) as base_table, cast(split_part(ns,'.',3) as int) as tenant_id from oplog""",
    ("oplog",),
)
def pf_ns_split(spark, sf):
    return O.with_namespace_parts(I.oplog(spark, sf)).select(
        "ts", "database", "collection", "base_table", "tenant_id"
    )


@query(
    "pf_op_dispatch",
    "select ts, case op when 'i' then 'insert' when 'u' then 'update' else 'delete' end as type "
    "from oplog where op in ('i','u','d')",
    ("oplog",),
)
def pf_op_dispatch(spark, sf):
    return O.dispatched(I.oplog(spark, sf)).select("ts", "type")


@query(
    "pf_update_set",
    """select ts, cast(json_extract(o,'$."$set"') as varchar) as changed_fields from oplog where op='u'""",
    ("oplog",),
)
def pf_update_set(spark, sf):
    updates = I.oplog(spark, sf).filter(F.col("op") == "u")
    return updates.select("ts", P.to_text(O.changed_fields(F.col("o"))).alias("changed_fields"))


@query(
    "pf_drop_key",
    """select ts, case op when 'i' then concat('{"score":',ts%100,'}') when 'd' then '{}' else o end as doc
    from oplog""",
    ("oplog",),
)
def pf_drop_key(spark, sf):
    return I.oplog(spark, sf).select("ts", P.to_text(P.drop_key(F.col("o"), "_id")).alias("doc"))


@query(
    "pf_build_envelope",
    """select ts, concat('{"data":{"score":',ts%100,'},"database":"crm","table":"',substr(ns,5),
    '","type":"insert"}') as value from oplog where op='i'""",
    ("oplog",),
)
def pf_build_envelope(spark, sf):
    inserts = O.dispatched(O.with_namespace_parts(I.oplog(spark, sf))).filter(F.col("op") == "i")
    return inserts.select(
        "ts",
        E.envelope_text(F.col("o"), F.col("database"), F.col("collection"), F.col("type")).alias("value"),
    )


@query("pf_to_json", "select id, doc from clue_docs", ("clue_docs",))
def pf_to_json(spark, sf):
    return I.clue_payloads(spark, sf).select("id", P.to_text(F.col("payload")).alias("doc"))
