"""Routing of change envelopes to topics by table name, tenant and operation."""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidegate import fixed_values as V
from tidegate.functions import payload as P, text as X
from tidegate.operators.envelopes import DUPLICATE_KEY, MALFORMED, NULL_RECORD

NO_TABLE = "no_table"
BAD_TENANT = "bad_tenant"
REJECT_TOPIC = "rejected"
# Why the router rejects a record.
REASONS = (NULL_RECORD, MALFORMED, DUPLICATE_KEY, NO_TABLE, BAD_TENANT)


def is_exact_table(table: Column, names: Iterable[str] = V.EXACT_TABLES) -> Column:
    return F.coalesce(table.isin(*names), F.lit(False))


def has_tenant_prefix(table: Column, prefixes: Iterable[str] = V.TENANT_PREFIXES) -> Column:
    return F.coalesce(X.starts_with_any(table, prefixes), F.lit(False))


def base_table(table: Column) -> Column:
    return X.before_last_dot(table)


def tenant_id(table: Column) -> Column:
    return X.to_int(X.after_last_dot(table))


def topic_name(table: Column) -> Column:
    return F.concat(F.lit(V.TOPIC_PREFIX), table)


def route_by_table(
    envelopes: DataFrame,
    exact_tables: Sequence[str] = V.EXACT_TABLES,
    tenant_prefixes: Sequence[str] = V.TENANT_PREFIXES,
) -> DataFrame:
    """Add ``base_table``, ``tenant_id``, ``topic`` and ``payload`` to parsed envelopes.

    Exact names go first, then tenant prefixes, whose tenant is written into the payload. A row
    that neither admits, or without payload, gets no topic. A row that cannot be judged gets a
    ``reject_reason``.
    """
    table = F.col("table")
    usable = F.col("reject_reason").isNull() & P.is_non_empty(F.col("data"))
    exact = usable & is_exact_table(table, exact_tables)
    tenanted = usable & ~is_exact_table(table, exact_tables) & has_tenant_prefix(table, tenant_prefixes)
    named = (
        envelopes.withColumn("_exact", exact)
        .withColumn("_tenanted", tenanted)
        .withColumn("base_table", F.when(F.col("_exact"), table).when(F.col("_tenanted"), base_table(table)))
        .withColumn("tenant_id", F.when(F.col("_tenanted"), tenant_id(table)))
    )
    reason = (
        F.when(F.col("reject_reason").isNotNull(), F.col("reject_reason"))
        .when(usable & table.isNull(), NO_TABLE)
        .when(F.col("_tenanted") & F.col("tenant_id").isNull(), BAD_TENANT)
    )
    return (
        named.withColumn("reject_reason", reason)
        .withColumn(
            "topic",
            F.when(F.col("reject_reason").isNull(), topic_name(F.col("base_table"))),
        )
        .withColumn(
            "payload",
            F.when(F.col("_tenanted"), P.put(F.col("data"), V.TENANT_KEY, F.col("tenant_id")))
            .when(F.col("_exact"), F.col("data")),
        )
        .drop("_exact", "_tenanted")
    )


def route_by_rules(
    envelopes: DataFrame, rules: Mapping[str, Sequence[str] | None] = V.OP_RULES
) -> DataFrame:
    """Routing by a table of rules: table name to the admitted operations (None admits all)."""
    any_op = [table for table, ops in rules.items() if ops is None]
    table, op = F.col("table"), F.col("type")
    admitted = table.isin(*any_op) if any_op else F.lit(False)
    for name, ops in rules.items():
        if ops is not None:
            admitted = admitted | ((table == name) & op.isin(*ops))
    usable = F.col("reject_reason").isNull() & P.is_non_empty(F.col("data"))
    routed = usable & F.coalesce(admitted, F.lit(False))
    return (
        envelopes.withColumn("topic", F.when(routed, topic_name(table)))
        .withColumn("payload", F.when(routed, F.col("data")))
        .withColumn(
            "reject_reason",
            F.coalesce(F.col("reject_reason"), F.when(usable & table.isNull(), NO_TABLE)),
        )
    )


def publishable(routed: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Messages ``topic, key, value`` of routed rows, keyed by entity id."""
    return routed.filter(F.col("topic").isNotNull()).select(
        "topic",
        P.get_string(F.col("payload"), "id").alias("key"),
        P.to_text(F.col("payload")).alias("value"),
        *carry,
    )


def publishable_with_rejects(
    routed: DataFrame, value: str = "value", carry: Sequence[str] = ()
) -> DataFrame:
    """As ``publishable``, with rejected records sent to a topic of their own in the same pass."""
    is_reject = F.col("reject_reason").isNotNull()
    return routed.filter(F.col("topic").isNotNull() | is_reject).select(
        F.when(is_reject, REJECT_TOPIC).otherwise(F.col("topic")).alias("topic"),
        P.get_string(F.col("payload"), "id").alias("key"),
        F.when(is_reject, F.col(value)).otherwise(P.to_text(F.col("payload"))).alias("value"),
        "reject_reason",
        *carry,
    )
