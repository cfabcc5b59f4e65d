"""Decoding of tenant-defined custom fields in payloads."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidegate import fixed_values as V
from tidegate.functions import payload as P, text as X
from tidegate.operators.dimensions import param_keys
from tidegate.operators.lookup import lookup_join

# Stands for a missing tenant, so that a missing tenant meets a missing tenant in an equi-join.
NO_TENANT = "<none>"


def tenant_key(tenant: Column) -> Column:
    return F.coalesce(tenant.cast("string"), F.lit(NO_TENANT))


def decode_maps(params: DataFrame) -> DataFrame:
    """One row per tenant: field key -> param -> display. For parameter tables of checked size."""
    display = F.col("display").cast("variant").alias("display")
    per_field = params.groupBy("tenant", "field_key").agg(
        F.map_from_entries(F.collect_list(F.struct("param_id", display))).alias("displays")
    )
    by_tenant = per_field.groupBy("tenant").agg(
        F.collect_list(F.struct("field_key", "displays")).alias("_fields")
    )
    in_key_order = F.array_sort("_fields", lambda a, b: F.when(a["field_key"] < b["field_key"], -1).otherwise(1))
    return by_tenant.select("tenant", F.map_from_entries(in_key_order).alias("decoder"))


def decode_with_maps(payload: Column, decoder: Column) -> Column:
    """``<key>Name`` -> display for each custom field of the payload that the decoder knows."""
    displays = F.transform_values(
        decoder, lambda key, shown: F.element_at(shown, P.value_string(F.element_at(payload, key)))
    )
    found = F.map_filter(displays, lambda _, display: display.isNotNull())
    return F.transform_keys(found, lambda key, _: F.concat(key, F.lit(V.NAME_SUFFIX)))


def custom_values(docs: DataFrame, row_key: Sequence[str], payload: str, tenant: Column) -> DataFrame:
    """One narrow row per non-blank scalar of the payload: row key, tenant, key and value."""
    entries = F.transform(
        F.map_entries(F.col(payload)),
        lambda e: F.struct(e["key"].alias("field_key"), P.value_string(e["value"]).alias("param_id")),
    )
    filled = F.filter(entries, lambda e: X.is_not_blank(e["param_id"]))
    return (
        docs.select(*row_key, tenant_key(tenant).alias("tenant"), F.explode(filled).alias("_e"))
        .select(*row_key, "tenant", "_e.field_key", "_e.param_id")
    )


def decode_by_join(
    docs: DataFrame,
    params: DataFrame,
    row_key: Sequence[str],
    payload: str,
    tenant: Column,
    broadcast: bool,
) -> DataFrame:
    """Displays of custom fields as narrow rows ``row key, key, name``, for any parameter table."""
    values = custom_values(docs, row_key, payload, tenant)
    if not broadcast:
        values = lookup_join(values, param_keys(params), ["field_key"], row_key, how="left_semi")
    hits = lookup_join(
        values,
        params,
        ["tenant", "field_key", "param_id"],
        spread=row_key,
        how="inner",
        broadcast=broadcast,
    )
    return hits.select(
        *row_key,
        F.concat("field_key", F.lit(V.NAME_SUFFIX)).alias("key"),
        F.col("display").alias("name"),
    )
