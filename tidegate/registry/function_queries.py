"""Queries of the scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.functions import payload as P, text as X
from tidegate.operators.decode import tenant_key
from tidegate.operators.envelopes import accepted, parse_envelopes
from tidegate.operators.lookup import lookup_join
from tidegate.operators.routing import is_exact_table
from tidegate.registry import inputs as I
from tidegate.registry.core import query


@query(
    "fn_json_get_string",
    """select id, cast(tenant_id as varchar) as tenant, cast(creator_id as varchar) as creator,
    order_priority as priority, cast(null as varchar) as missing from clues""",
    ("clues",),
)
def fn_json_get_string(spark, sf):
    obj = F.col("payload")
    return I.clue_payloads(spark, sf).select(
        "id",
        P.get_string(obj, "tenantId").alias("tenant"),
        P.get_string(obj, "creatorId").alias("creator"),
        P.get_string(obj, "orderPriority").alias("priority"),
        P.get_string(obj, "missing").alias("missing"),
    )


@query(
    "fn_json_get_int",
    """select id, cast(creator_id as int) as creator, cast(public_sea_id as int) as sea,
    cast(null as int) as status from clues""",
    ("clues",),
)
def fn_json_get_int(spark, sf):
    obj = F.col("payload")
    return I.clue_payloads(spark, sf).select(
        "id",
        P.get_int(obj, "creatorId").alias("creator"),
        P.get_int(obj, "publicSeaId").alias("sea"),
        P.get_int(obj, "orderStatus").alias("status"),
    )


@query(
    "fn_json_get_object",
    """select event_id, nullif(cast(json_extract(value,'$.data') as varchar),'null') as data
    from envelopes where value is not null and json_valid(value)""",
    ("envelopes",),
)
def fn_json_get_object(spark, sf):
    rows = I.envelopes(spark, sf).withColumn("obj", P.parse_object(F.col("value")))
    data = P.get_object(F.col("obj"), "data")
    return rows.filter(F.col("obj").isNotNull()).select("event_id", P.to_text(data).alias("data"))


@query(
    "fn_json_get_or_zero",
    """select id, cast(coalesce(creator_id,0) as int) as creator, cast(last_charger as bigint) as charger,
    cast(0 as bigint) as missing from clues""",
    ("clues",),
)
def fn_json_get_or_zero(spark, sf):
    obj = F.col("payload")
    return I.clue_payloads(spark, sf).select(
        "id",
        P.get_int_or_zero(obj, "creatorId").alias("creator"),
        P.get_long_or_zero(obj, "lastCharger").alias("charger"),
        P.get_long_or_zero(obj, "missing").alias("missing"),
    )


@query(
    "fn_json_has_key",
    "select ts, op='i' as has_score, op in ('u','n') as has_set from oplog",
    ("oplog",),
)
def fn_json_has_key(spark, sf):
    return I.oplog(spark, sf).select(
        "ts", P.has_key(F.col("o"), "score").alias("has_score"), P.has_key(F.col("o"), "$set").alias("has_set")
    )


@query(
    "fn_json_put",
    """select id, concat(replace(substr(doc,1,length(doc)-1), concat('"lastCharger":',last_charger,','), ''),
    ',"lastCharger":"',id,'"}') as doc from clue_docs join clues using (id)""",
    ("clue_docs", "clues"),
)
def fn_json_put(spark, sf):
    text = F.col("id").cast("string")
    return I.clue_payloads(spark, sf).select(
        "id", P.to_text(P.put(F.col("payload"), "lastCharger", text)).alias("doc")
    )


@query(
    "fn_json_is_empty",
    "select event_id, data = '{}' as empty from parsed",
    ("parsed",),
)
def fn_json_is_empty(spark, sf):
    rows = accepted(parse_envelopes(I.envelopes(spark, sf)))
    return rows.select("event_id", P.is_empty(F.col("data")).alias("empty"))


@query(
    "fn_to_json",
    """select ts, concat('{"o":',o,',"o2":',o2,'}') as entry from oplog""",
    ("oplog",),
)
def fn_to_json(spark, sf):
    return I.oplog(spark, sf).select("ts", P.to_text(F.struct("o", "o2")).alias("entry"))


@query(
    "fn_is_not_blank",
    "select id, trim(order_priority) <> '' as priority, creator_id is not null as creator from clues",
    ("clues",),
)
def fn_is_not_blank(spark, sf):
    return I.clues(spark, sf).select(
        "id",
        X.is_not_blank(F.col("order_priority")).alias("priority"),
        X.is_not_blank(F.col("creator_id").cast("string")).alias("creator"),
    )


@query(
    "fn_starts_with",
    "select ts, starts_with(ns,'crm.saas_clue') or starts_with(ns,'crm.saas_record') as followed from oplog",
    ("oplog",),
)
def fn_starts_with(spark, sf):
    followed = X.starts_with_any(F.col("ns"), ["crm.saas_clue", "crm.saas_record"])
    return I.oplog(spark, sf).select("ts", followed.alias("followed"))


@query(
    "fn_split_first_last",
    """select ts, split_part(ns,'.',1) as before_first, substr(ns,strpos(ns,'.')+1) as after_first,
    regexp_extract(ns,'^(.*)\\.([^.]*)$',1) as before_last, regexp_extract(ns,'^(.*)\\.([^.]*)$',2) as after_last
    from oplog""",
    ("oplog",),
)
def fn_split_first_last(spark, sf):
    ns = F.col("ns")
    return I.oplog(spark, sf).select(
        "ts",
        X.before_first_dot(ns).alias("before_first"),
        X.after_first_dot(ns).alias("after_first"),
        X.before_last_dot(ns).alias("before_last"),
        X.after_last_dot(ns).alias("after_last"),
    )


@query(
    "fn_to_int",
    """select id, cast(public_sea_id as int) as sea, cast(null as int) as priority, cast(-id as int) as negative
    from clues""",
    ("clues",),
)
def fn_to_int(spark, sf):
    return I.clues(spark, sf).select(
        "id",
        X.to_int(F.col("public_sea_id")).alias("sea"),
        X.to_int(F.col("order_priority")).alias("priority"),
        X.to_int((-F.col("id")).cast("string")).alias("negative"),
    )


@query(
    "fn_null_safe_key",
    """select c.id, r.r_name as region from clues c left join region r
    on nullif(case when c.tenant_id=5 then 0 else c.tenant_id end,0) is not distinct from nullif(r.r_regionkey,0)""",
    ("clues",),
)
def fn_null_safe_key(spark, sf):
    """A missing tenant meets the region whose key is missing."""
    regions = I.table(spark, sf, "region").select(tenant_key(F.expr("nullif(r_regionkey,0)")).alias("tenant"), F.col("r_name").alias("region"))
    tenant = F.expr("nullif(case when tenant_id=5 then 0 else tenant_id end,0)")
    clues = I.clues(spark, sf).select("id", tenant_key(tenant).alias("tenant"))
    return lookup_join(clues, regions, ["tenant"], ["id"]).select("id", "region")


@query(
    "fn_lookup_default",
    "select id, coalesce(creator_id_name,'') as creator from clue_names",
    ("clue_names",),
)
def fn_lookup_default(spark, sf):
    users = I.users(spark, sf).selectExpr("id as creator_id", "real_name")
    named = lookup_join(I.clues(spark, sf), users, ["creator_id"], ["id"])
    return named.select("id", F.coalesce("real_name", F.lit("")).alias("creator"))


@query(
    "fn_in_list",
    "select event_id, event_type in ('signup','view') as listed from events",
)
def fn_in_list(spark, sf):
    return I.table(spark, sf, "events").select(
        "event_id", is_exact_table(F.col("event_type"), ("signup", "view")).alias("listed")
    )


@query(
    "fn_code_label",
    "select id, case gender when 0 then 'unknown' when 1 then 'male' when 2 then 'female' end as label from users",
    ("users",),
)
def fn_code_label(spark, sf):
    labels = {0: "unknown", 1: "male", 2: "female"}
    return I.users(spark, sf).select("id", X.code_label(F.col("gender"), labels).alias("label"))


@query("fn_hex_id", "select c_custkey as id, lower(hex(encode(c_name))) as hex_id from customer")
def fn_hex_id(spark, sf):
    customers = I.table(spark, sf, "customer")
    return customers.select(
        F.col("c_custkey").alias("id"), X.hex_id(F.col("c_name").cast("binary")).alias("hex_id")
    )
