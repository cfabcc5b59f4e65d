"""Queries of latest state, cursors, counters and bounded reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.operators import dimensions as M, latest as T, ledger as L, oplog as O
from tidegate.registry import inputs as I
from tidegate.registry.core import query


@query(
    "agg_latest_per_key",
    """select user_id, event_id, event_type, props from events
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
)
def agg_latest_per_key(spark, sf):
    events = I.table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "props")
    return T.latest_per_key(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query(
    "agg_param_key_set",
    "select distinct field_key from keyed_params where field_key is not null",
    ("keyed_params",),
)
def agg_param_key_set(spark, sf):
    return M.param_keys(M.join_param_fields(I.params(spark, sf), I.fields(spark, sf)))


@query(
    "agg_until_offset",
    "select topic, partition_id, max(record_offset)+1 as until_offset from kafka_like group by all",
    ("kafka_like",),
)
def agg_until_offset(spark, sf):
    return L.until_offsets(I.records(spark, sf))


@query("agg_cursor_hwm", "select ns, max(ts) as cursor_ts from oplog group by ns", ("oplog",))
def agg_cursor_hwm(spark, sf):
    return O.high_water_mark(I.oplog(spark, sf), ["ns"])


@query("agg_cursor_first", "select min(ts) as cursor_ts from oplog", ("oplog",))
def agg_cursor_first(spark, sf):
    return O.first_cursor(I.oplog(spark, sf))


@query("agg_change_counts", "select ns, op, count(*) as entries from oplog group by all", ("oplog",))
def agg_change_counts(spark, sf):
    return O.change_counts(I.oplog(spark, sf))


@query(
    "agg_dim_key_dedupe",
    """select id, tenant_id, field_id, display from params_dup
    qualify row_number() over (partition by tenant_id, field_id order by id desc) = 1""",
    ("params_dup",),
)
def agg_dim_key_dedupe(spark, sf):
    return M.dedupe_dimension(I.params_dup(spark, sf), ["tenant_id", "field_id"])


@query("limit_first_entry", "select ts, op, ns from oplog order by ts limit 1", ("oplog",))
def limit_first_entry(spark, sf):
    return O.first_entry(I.oplog(spark, sf).select("ts", "op", "ns"))


@query("limit_bounded_batch", "select ts, op, ns from oplog order by ts limit 2000", ("oplog",))
def limit_bounded_batch(spark, sf):
    return O.bounded_read(I.oplog(spark, sf).select("ts", "op", "ns"))
