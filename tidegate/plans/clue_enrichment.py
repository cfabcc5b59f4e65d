"""Wide clue documents: custom fields decoded, public sea and user names added.

Four shapes of plan, chosen by the measured size of the dimensions:

* all fit a broadcast: one narrow stage over the documents, nothing is shuffled;
* seas or users do not fit, but the rows that these documents name do: the distinct ids pick them at the
  scan of the dimension, and the plan is the one above. It takes a ``place`` to keep them;
* a dimension does not fit in any way: only ``row key + looked-up id`` goes through its join, in which ids
  counted as hot are spread. All such results are gathered per document once and meet the documents in one join,
  so a payload is shuffled once at most, however many lookups are large;
* custom parameters fit a broadcast but one tenant has too many to scan per value: they are
  hash-joined instead, as narrow rows.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidegate import fixed_values as V
from tidegate.functions import payload as P, text as X
from tidegate.operators import decode as D
from tidegate.operators.computed import with_computed
from tidegate.operators.dimensions import dedupe_dimension, join_param_fields
from tidegate.operators.latest import latest_per_key
from tidegate.operators.lookup import (
    Narrowed,
    broadcast_limit,
    hot_rows_of,
    lookup_join,
    narrowed,
    row_bytes,
    split_hot_keys_join,
    surely_large,
)

# A decoder map is scanned entry by entry, so it must stay short.
DECODER_ENTRIES_MAX = 512


# Order of the names in a document: custom fields, public sea, users by role.
CUSTOM, SEA = 0, 1


@dataclass(frozen=True)
class ClueDimensions:
    """``params``: tenant, field_key, param_id, display; ``seas``: id, name; ``users``: id, name.

    ``decoder`` (see ``decode_maps``) and ``plan`` are worked out per batch unless they are given. ``find_users`` opens the
    users of given ids (``id``) without reading all of a large table.
    """

    params: DataFrame
    seas: DataFrame
    users: DataFrame
    decoder: DataFrame | None = None
    plan: LookupPlan | None = None
    find_users: Callable[[DataFrame], DataFrame] | None = None

    @classmethod
    def from_tables(
        cls,
        params: DataFrame,
        fields: DataFrame,
        seas: DataFrame,
        users: DataFrame,
        find_users: Callable[[DataFrame], DataFrame] | None = None,
    ) -> ClueDimensions:
        """From the dimension tables; a duplicate composite key keeps its highest ``id``."""
        tie = "id" if "id" in params.columns else "display"
        keyed = join_param_fields(params, dedupe_dimension(fields, ["tenant_id", "field_id"]))
        keyed = keyed.filter(F.col("field_key").isNotNull() & F.col("param_id").isNotNull())
        decodable = latest_per_key(
            keyed.select(
                D.tenant_key(F.col("tenant_id")).alias("tenant"),
                "field_key",
                F.col("param_id").cast("string").alias("param_id"),
                "display",
                F.col(tie).alias("_tie"),
            ),
            ["tenant", "field_key", "param_id"],
            ["_tie"],
        ).drop("_tie")
        return cls(
            decodable.filter(X.is_not_blank(F.col("display")) & X.is_not_blank(F.col("param_id"))),
            seas.select(F.col("id").cast("string").alias("id"), F.col("public_seas_name").alias("name"))
            .filter(X.is_not_blank(F.col("name"))),
            users.select(F.col("id").cast("int").alias("id"), F.col("real_name").alias("name")),
            find_users=find_users,
        )


@dataclass(frozen=True)
class LookupPlan:
    """How each dimension is reached; ``params`` is ``maps``, ``broadcast`` or ``shuffle``."""

    params: str
    seas: bool
    users: bool

    @classmethod
    def measured(cls, dims: ClueDimensions) -> LookupPlan:
        """From one aggregation over the dimensions."""
        limit = broadcast_limit(dims.users)
        per_field = dims.params.groupBy("tenant", "field_key").agg(
            F.count(F.lit(1)).alias("params"), F.sum(row_bytes(dims.params)).alias("bytes")
        )
        per_tenant = per_field.groupBy("tenant").agg(
            F.greatest(F.max("params"), F.count(F.lit(1))).alias("entries"), F.sum("bytes").alias("bytes")
        )
        sizes = [per_tenant.agg(F.lit("params").alias("name"), F.max("entries").alias("entries"), F.sum("bytes").alias("bytes"))]
        for name, table in (("seas", dims.seas), ("users", dims.users)):
            if not surely_large(table):
                size = F.sum(row_bytes(table)).alias("bytes")
                sizes.append(table.agg(F.lit(name).alias("name"), F.lit(0).cast("bigint").alias("entries"), size))
        found = {row["name"]: row for row in reduce(DataFrame.unionByName, sizes).collect()}

        def fits(name: str) -> bool:
            return name in found and (found[name]["bytes"] or 0) <= limit

        params = "shuffle"
        if fits("params"):
            short = (found["params"]["entries"] or 0) <= DECODER_ENTRIES_MAX
            params = "maps" if short else "broadcast"
        return cls(params, fits("seas"), fits("users"))


def _ids(payload: Column) -> dict[str, Column]:
    """The looked-up ids of a payload, each read once."""
    ids = {"_tenant": P.get_int(payload, V.TENANT_KEY), "_sea": P.get_string(payload, V.SEA_KEY)}
    ids.update({f"_user{i}": P.get_int(payload, role) for i, role in enumerate(V.USER_ROLE_KEYS)})
    return ids


def _bad_integer(payload: Column) -> Column:
    """Name of the first id key that holds no integer. Ids that were read settle most rows."""
    read = {"_tenant": V.TENANT_KEY, **{f"_user{i}": role for i, role in enumerate(V.USER_ROLE_KEYS)}}
    return F.coalesce(
        *(
            F.when(F.col(column).isNull() & P.holds_text(payload, key), F.lit(f"bad_int:{key}"))
            for column, key in read.items()
        )
    )


def _one_name(key: str, name: Column, hit: Column) -> Column:
    entry = F.create_map(F.lit(key), P.as_json_value(name))
    return F.when(hit, entry).otherwise(P.empty_object())


def _in_place_names(
    docs: DataFrame, dims: ClueDimensions, plan: LookupPlan, payload: str
) -> DataFrame:
    """Add ``custom_names`` and ``_fixed_names`` from the dimensions that are broadcast."""
    fixed = []
    custom = P.empty_object()
    if plan.params == "maps":
        decoder = D.decode_maps(dims.params) if dims.decoder is None else dims.decoder
        decoder = decoder.withColumnRenamed("tenant", "_tenant_key")
        docs = docs.withColumn("_tenant_key", D.tenant_key(F.col("_tenant")))
        docs = docs.join(F.broadcast(decoder), "_tenant_key", "left")
        custom = F.coalesce(D.decode_with_maps(F.col(payload), F.col("decoder")), custom)
    if plan.seas:
        seas = dims.seas.toDF("_sea_id", "_sea_name")
        docs = docs.join(F.broadcast(seas), F.col("_sea") == F.col("_sea_id"), "left")
        fixed.append(_one_name(V.SEA_NAME_KEY, F.col("_sea_name"), F.col("_sea_name").isNotNull()))
    if plan.users:
        # The three sides are one relation under other names, so Spark broadcasts it once.
        for i, role in enumerate(V.USER_ROLE_KEYS):
            users = F.broadcast(dims.users.toDF(f"_id{i}", f"_name{i}"))
            docs = docs.join(users, F.col(f"_user{i}") == F.col(f"_id{i}"), "left")
            fixed.append(_one_name(role + V.NAME_SUFFIX, F.col(f"_name{i}"), F.col(f"_id{i}").isNotNull()))
    fixed_names = F.map_concat(*fixed) if fixed else P.empty_object()
    return docs.withColumns({"custom_names": custom, "_fixed_names": fixed_names})


def _found(row_key: Sequence[str], hits: DataFrame, slot: Column, key: Column) -> DataFrame:
    return hits.select(*row_key, slot.alias("_slot"), key.alias("_key"), F.col("name").alias("_name"))


def _wanted_seas(docs: DataFrame, row_key: Sequence[str]) -> DataFrame:
    """One row per document with a sea: row key and ``_ref``, its id."""
    return docs.select(*row_key, F.col("_sea").alias("_ref")).filter(X.is_not_blank(F.col("_ref")))


def _wanted_users(docs: DataFrame, row_key: Sequence[str]) -> DataFrame:
    """One row per document and role that names a user: row key, ``_slot``, ``_key`` of the name, and ``_ref``."""
    roles = F.array(
        *(
            F.struct(
                F.lit(SEA + 1 + i).alias("_slot"),
                F.lit(role + V.NAME_SUFFIX).alias("_key"),
                F.col(f"_user{i}").alias("_ref"),
            )
            for i, role in enumerate(V.USER_ROLE_KEYS)
        )
    )
    return docs.select(*row_key, F.inline(roles)).filter(F.col("_ref").isNotNull())


def _narrowed(
    docs: DataFrame, dims: ClueDimensions, plan: LookupPlan, place: str
) -> tuple[ClueDimensions, LookupPlan, Mapping[str, DataFrame]]:
    """Large seas and users cut down to what ``docs`` name, the plan that follows, and the counted ids."""
    parts: dict[str, Narrowed] = {}
    if not plan.seas:
        parts["seas"] = narrowed(dims.seas, _wanted_seas(docs, []).toDF("id"), ["id"], f"{place}/seas")
    if not plan.users:
        users = _wanted_users(docs, []).select(F.col("_ref").alias("id"))
        parts["users"] = narrowed(dims.users, users, ["id"], f"{place}/users", dims.find_users)
    dims = replace(dims, **{name: part.rows for name, part in parts.items()})
    plan = replace(plan, **{name: part.fits for name, part in parts.items()})
    return dims, plan, {name: part.counts for name, part in parts.items()}


def _shuffled_names(
    docs: DataFrame,
    dims: ClueDimensions,
    plan: LookupPlan,
    row_key: Sequence[str],
    payload: str,
    counts: Mapping[str, DataFrame],
) -> DataFrame | None:
    """Names from the dimensions that are not broadcast, one row per document."""
    hot = hot_rows_of(docs)
    parts = []
    if plan.params != "maps":
        decoded = D.decode_by_join(
            docs, dims.params, row_key, payload, F.col("_tenant"), plan.params == "broadcast"
        )
        parts.append(_found(row_key, decoded, F.lit(CUSTOM), F.col("key")))
    if not plan.seas:
        wanted = _wanted_seas(docs, row_key)
        seas = dims.seas.toDF("_ref", "name")
        hits = split_hot_keys_join(wanted, seas, ["_ref"], "inner", row_key, hot, counts=_counted(counts, "seas"))
        parts.append(_found(row_key, hits, F.lit(SEA), F.lit(V.SEA_NAME_KEY)))
    if not plan.users:
        wanted = _wanted_users(docs, row_key)
        users = dims.users.toDF("_ref", "name")
        spread = [*row_key, "_slot"]
        hits = split_hot_keys_join(wanted, users, ["_ref"], "inner", spread, hot, counts=_counted(counts, "users"))
        parts.append(_found(row_key, hits, F.col("_slot"), F.col("_key")))
    if not parts:
        return None
    # A group is one document: its custom fields and four fixed names.
    entry = F.struct("_slot", "_key", "_name")
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy(*row_key)
        .agg(F.array_sort(F.collect_list(entry)).alias("_found"))
    )


def _counted(counts: Mapping[str, DataFrame], name: str) -> DataFrame | None:
    return counts[name].withColumnRenamed("id", "_ref") if name in counts else None


def _found_names(custom: bool) -> Column:
    chosen = F.filter(F.col("_found"), lambda f: (f["_slot"] == CUSTOM) == F.lit(custom))
    entries = F.transform(
        chosen, lambda f: F.struct(f["_key"].alias("key"), P.as_json_value(f["_name"]).alias("value"))
    )
    return F.coalesce(F.map_from_entries(entries), P.empty_object())


def enrich_clues(
    docs: DataFrame,
    dims: ClueDimensions,
    row_key: Sequence[str],
    payload: str = "payload",
    plan: LookupPlan | None = None,
    place: str | None = None,
) -> DataFrame:
    """Add ``enriched`` and ``custom_names`` to documents; ``row_key`` must be unique.

    A payload whose id keys hold no integers is not enriched but gets a ``reject_reason``. With a folder ``place``, large
    seas and users are narrowed at once to what these documents name; the result reads them there. Use a new one per call.
    """
    plan = plan or dims.plan or LookupPlan.measured(dims)
    columns = [c for c in docs.columns if c != "reject_reason"]
    reason = _bad_integer(F.col(payload))
    if "reject_reason" in docs.columns:
        reason = F.coalesce(F.col("reject_reason"), reason)
    keyed = with_computed(docs, **_ids(F.col(payload))).withColumn("reject_reason", reason)
    counts: Mapping[str, DataFrame] = {}
    if place and not (plan.seas and plan.users):
        dims, plan, counts = _narrowed(keyed, dims, plan, place)
    named = _in_place_names(keyed, dims, plan, payload)
    custom, fixed = F.col("custom_names"), F.col("_fixed_names")
    found = _shuffled_names(keyed, dims, plan, row_key, payload, counts)
    if found is not None:
        named = named.join(found, list(row_key), "left")
        custom = custom if plan.params == "maps" else _found_names(custom=True)
        fixed = F.map_concat(fixed, _found_names(custom=False))
        named = with_computed(named, custom_names=custom, _fixed_names=fixed)
    merged = P.overlay(F.col(payload), F.col("custom_names"), F.col("_fixed_names"))
    return named.select(
        *columns,
        "reject_reason",
        "custom_names",
        F.when(F.col("reject_reason").isNull(), merged).alias("enriched"),
    )


def lookup_sea(docs: DataFrame, seas: DataFrame, row_key: Sequence[str], payload: str = "payload") -> DataFrame:
    """Documents with ``public_seas_name`` of their sea; a blank name counts as none."""
    named = seas.select(
        F.col("id").cast("string").alias("_sea"), F.col("public_seas_name")
    ).filter(X.is_not_blank(F.col("public_seas_name")))
    keyed = docs.withColumn("_sea", P.get_string(F.col(payload), V.SEA_KEY))
    return lookup_join(keyed, named, ["_sea"], row_key).drop("_sea")


def lookup_user(
    docs: DataFrame,
    users: DataFrame,
    role: str,
    into: str,
    row_key: Sequence[str],
    payload: str = "payload",
) -> DataFrame:
    """Documents with the name of the user that ``role`` points to."""
    named = users.select(F.col("id").cast("int").alias("_user"), F.col("real_name").alias(into))
    keyed = docs.withColumn("_user", P.get_int(F.col(payload), role))
    return lookup_join(keyed, named, ["_user"], row_key).drop("_user")
