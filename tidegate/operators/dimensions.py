"""Dimension rows: typed users with labels, tenant fields and their parameters."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidegate import fixed_values as V
from tidegate.functions import payload as P, text as X
from tidegate.operators.computed import with_computed
from tidegate.operators.latest import latest_per_key
from tidegate.schemas import USER


def user_columns(user: Column) -> list[Column]:
    """The fields of a user payload; one that does not fit its type is NULL, numeric text is a number."""
    return [F.try_variant_get(user[f.name], "$", f.dataType.simpleString()).alias(f.name) for f in USER]


def typed_users(records: DataFrame, value: str = "value") -> DataFrame:
    """User documents as typed columns beside the record's own columns; NULL where ``value`` is no payload."""
    carried = [c for c in records.columns if c != value]
    return with_computed(records, _user=P.parse_object(F.col(value))).select(
        *(F.col(c).alias(f"record_{c}") if c in USER.fieldNames() else c for c in carried),
        *user_columns(F.col("_user")),
    )


def with_user_labels(
    users: DataFrame,
    status: Mapping[int, str] = V.STATUS_LABELS,
    gender: Mapping[int, str] = V.GENDER_LABELS,
    change_pass: Mapping[int, str] = V.CHANGE_PASS_LABELS,
) -> DataFrame:
    return users.withColumns(
        {
            "statusName": X.code_label(F.col("status"), dict(status)),
            "genderName": X.code_label(F.col("gender"), dict(gender)),
            "changePassName": X.code_label(F.col("changePass"), dict(change_pass)),
        }
    )


def dedupe_dimension(rows: DataFrame, keys: Sequence[str], tie_break: str = "id") -> DataFrame:
    """One row per composite key; the highest ``tie_break`` stays."""
    return latest_per_key(rows, keys, [tie_break])


def join_param_fields(params: DataFrame, fields: DataFrame) -> DataFrame:
    """Params with the key of their field; a param without field keeps a NULL key.

    A NULL tenant or field id matches NULL. Spark broadcasts the fields only if it knows them to be
    below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    keyed = fields.select(
        F.col("tenant_id").alias("_tenant"), F.col("field_id").alias("_field"), "field_key"
    )
    same_field = params["tenant_id"].eqNullSafe(F.col("_tenant")) & params["field_id"].eqNullSafe(
        F.col("_field")
    )
    return params.join(keyed, same_field, "left").drop("_tenant", "_field")


def param_keys(keyed_params: DataFrame) -> DataFrame:
    return keyed_params.select("field_key").filter(F.col("field_key").isNotNull()).distinct()
