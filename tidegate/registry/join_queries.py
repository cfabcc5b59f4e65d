"""Queries of the dimension joins and of the operation-log images."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate import fixed_values as V
from tidegate.functions import payload as P
from tidegate.operators import decode as D, dimensions as M, oplog as O
from tidegate.operators.lookup import fits_broadcast, narrowed
from tidegate.plans.clue_enrichment import (
    ClueDimensions,
    LookupPlan,
    enrich_clues,
    lookup_sea,
    lookup_user,
)
from tidegate.plans.oplog_capture import capture_changes
from tidegate.registry import inputs as I
from tidegate.registry.core import query
from tidegate.workspace import workspace


def clue_dimensions(spark, sf) -> ClueDimensions:
    return ClueDimensions.from_tables(
        I.params(spark, sf), I.fields(spark, sf), I.seas(spark, sf), I.users(spark, sf)
    )


@query("join_param_field", "select tenant_id, field_id, param_id, display, field_key from keyed_params", ("keyed_params",))
def join_param_field(spark, sf):
    return M.join_param_fields(I.params(spark, sf), I.fields(spark, sf))


@query(
    "join_dynamic_decode",
    "select id, order_status_name, order_priority_name from clue_names",
    ("clue_names",),
)
def join_dynamic_decode(spark, sf):
    """Decoding alone, through a decoder map per tenant or through narrow rows, as sizes allow."""
    dims = clue_dimensions(spark, sf)
    plan = LookupPlan.measured(dims)
    clues = I.clue_payloads(spark, sf)
    tenant = P.get_int(F.col("payload"), V.TENANT_KEY)
    if plan.params == "maps":
        decoder = D.decode_maps(dims.params)
        named = clues.withColumn("tenant", D.tenant_key(tenant)).join(F.broadcast(decoder), "tenant", "left")
        named = named.withColumn("names", D.decode_with_maps(F.col("payload"), F.col("decoder")))
    else:
        hits = D.decode_by_join(clues, dims.params, ["id"], "payload", tenant, fits_broadcast(dims.params))
        names = hits.groupBy("id").agg(
            F.map_from_entries(F.collect_list(F.struct("key", F.col("name").cast("variant")))).alias("names")
        )
        named = clues.select("id").join(names, "id", "left")
    return named.select(
        "id",
        P.get_string(F.col("names"), "orderStatusName").alias("order_status_name"),
        P.get_string(F.col("names"), "orderPriorityName").alias("order_priority_name"),
    )


@query("join_public_sea", "select id, public_seas_name from clue_names", ("clue_names",))
def join_public_sea(spark, sf):
    clues = I.clue_payloads(spark, sf)
    return lookup_sea(clues, I.seas(spark, sf), ["id"]).select("id", "public_seas_name")


def user_role(spark, sf, role, into):
    clues = I.clue_payloads(spark, sf)
    return lookup_user(clues, I.users(spark, sf), role, into, ["id"]).select("id", into)


@query("join_user_creator", "select id, creator_id_name from clue_names", ("clue_names",))
def join_user_creator(spark, sf):
    return user_role(spark, sf, "creatorId", "creator_id_name")


@query("join_user_last_charger", "select id, last_charger_name from clue_names", ("clue_names",))
def join_user_last_charger(spark, sf):
    return user_role(spark, sf, "lastCharger", "last_charger_name")


@query("join_user_belong_to", "select id, belong_to_id_name from clue_names", ("clue_names",))
def join_user_belong_to(spark, sf):
    return user_role(spark, sf, "belongToId", "belong_to_id_name")


@query("join_users_narrowed", "select id, creator_id_name, last_charger_name from clue_names", ("clue_names",))
def join_users_narrowed(spark, sf):
    """Names of two roles from the users that the clues name, picked at the scan of the users."""
    roles = {"creator_id_name": "creatorId", "last_charger_name": "lastCharger"}
    ids = {f"_{into}": P.get_int(F.col("payload"), role) for into, role in roles.items()}
    clues = I.clue_payloads(spark, sf).withColumns(ids)
    users = I.users(spark, sf).select(F.col("id").cast("int").alias("_user"), F.col("real_name").alias("_name"))
    wanted = clues.select(F.explode(F.array(*ids)).alias("_user"))
    part = narrowed(users, wanted, ["_user"], workspace(spark, "narrowed"))
    for into, column in zip(roles, ids):
        keyed = clues.withColumnRenamed(column, "_user")
        clues = part.join(keyed, ["_user"], "left", ["id"]).drop("_user").withColumnRenamed("_name", into)
    return clues.select("id", *roles)


@query("clue_enriched", "select id, doc from enriched_docs", ("enriched_docs",))
def clue_enriched(spark, sf):
    """Whole enriched documents."""
    enriched = enrich_clues(I.clue_payloads(spark, sf), clue_dimensions(spark, sf), ["id"])
    return enriched.select("id", P.to_text(F.col("enriched")).alias("doc"))


@query(
    "oplog_update_image",
    """select l.ts, l.ns, cast(l.doc_id as varchar) as doc_id, d.name
    from oplog l join current_docs d on l.doc_id=d.doc_id where l.op='u'""",
    ("oplog", "current_docs"),
)
def oplog_update_image(spark, sf):
    updates = I.oplog(spark, sf).filter(F.col("op") == "u")
    keyed = O.with_document_key(updates, F.col("o2")).select("ts", "ns", "doc_id")
    current = I.current_docs(spark, sf).select("doc_id", "name")
    return O.with_image(keyed, current, ["doc_id"]).select("ts", "ns", "doc_id", "name")


@query(
    "oplog_delete_image",
    """select l.ts, l.ns, cast(l.doc_id as varchar) as doc_id, d.name
    from oplog l join current_docs d on l.doc_id=d.doc_id where l.op='d'""",
    ("oplog", "current_docs"),
)
def oplog_delete_image(spark, sf):
    deletes = I.oplog(spark, sf).filter(F.col("op") == "d")
    keyed = O.with_document_key(deletes, F.col("o")).select("ts", "ns", "doc_id")
    current = I.current_docs(spark, sf).select("doc_id", "name")
    return O.with_image(keyed, current, ["doc_id"]).select("ts", "ns", "doc_id", "name")


@query("oplog_ns_semi", "select ts, op, ns from followed_log", ("followed_log",))
def oplog_ns_semi(spark, sf):
    followed = O.namespaces(I.collections(spark, sf))
    return O.in_namespaces(I.oplog(spark, sf), followed).select("ts", "op", "ns")


OPLOG_ENVELOPES_SQL = """select ts, ns, type, doc_id, value from (
  select l.ts, l.ns, 'insert' as type, cast(l.doc_id as varchar) as doc_id,
    concat('{"data":{"score":',l.ts%100,'},"database":"crm","table":"',substr(l.ns,5),
      '","type":"insert"}') as value
  from followed_log l where l.op='i'
  union all
  select l.ts, l.ns, case l.op when 'u' then 'update' else 'delete' end, cast(l.doc_id as varchar),
    concat('{"data":{"name":"',d.name,'"},"database":"crm","table":"',substr(l.ns,5),'","type":"',
      case l.op when 'u' then 'update' else 'delete' end,'"}')
  from followed_log l join current_docs d on l.doc_id=d.doc_id where l.op in ('u','d'))"""


@query("oplog_to_envelopes", OPLOG_ENVELOPES_SQL, ("followed_log", "current_docs"))
def oplog_to_envelopes(spark, sf):
    followed = O.namespaces(I.collections(spark, sf))
    changes = capture_changes(I.oplog(spark, sf), I.current_docs(spark, sf), followed, ["doc_id"])
    return changes.select("ts", "ns", "type", "doc_id", "value")
