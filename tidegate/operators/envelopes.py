"""Change envelopes: JSON text in, typed columns and a reject reason out, and back to text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions import payload as P
from tidegate.operators.computed import with_computed
from tidegate.schemas import ENVELOPE

NULL_RECORD = "null_record"
MALFORMED = "malformed"
DUPLICATE_KEY = "duplicate_key"
BAD_ID = "bad_id"

ENVELOPE_FIELDS = ("database", "table", "type", "ts", "xid", "xoffset", "data", "old")


def _no_record(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "null")


def parse_payloads(records: DataFrame, value: str = "value", into: str = "payload") -> DataFrame:
    """Add the JSON object of ``value`` and, for rows without one, ``reject_reason``."""
    text = F.col(value)
    parsed = with_computed(records, **{into: P.parse_object(text)})
    reason = F.when(_no_record(text), NULL_RECORD).when(F.col(into).isNull(), MALFORMED)
    return parsed.withColumn("reject_reason", reason)


def parse_envelopes(records: DataFrame, value: str = "value") -> DataFrame:
    """Add the envelope fields and ``reject_reason``; one parse per record, no row is lost."""
    text = F.col(value)
    parsed = with_computed(
        records,
        _envelope=F.from_json(text, ENVELOPE),
        _whole=P.is_single_json_value(text),
    )
    broken = ~F.col("_whole") | F.col("_envelope._corrupt_record").isNotNull()
    ambiguous = F.coalesce(P.has_duplicate_keys(F.col("_envelope.data")), F.lit(False))
    reason = F.when(_no_record(text), NULL_RECORD).when(broken, MALFORMED).when(ambiguous, DUPLICATE_KEY)
    judged = with_computed(parsed, reject_reason=reason)
    usable = F.col("reject_reason").isNull()
    fields = (F.when(usable, F.col(f"_envelope.{f}")).alias(f) for f in ENVELOPE_FIELDS)
    return judged.select(*records.columns, *fields, "reject_reason")


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reject_reason").isNull())


def rejected(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reject_reason").isNotNull())


def non_null_records(rows: DataFrame) -> DataFrame:
    """Drop the records without an object; malformed ones stay visible through their reason."""
    return rows.filter(~F.col("reject_reason").eqNullSafe(NULL_RECORD))


def non_empty_payloads(rows: DataFrame, payload: str = "data") -> DataFrame:
    return rows.filter(P.is_non_empty(F.col(payload)))


def require_ids(rows: DataFrame, payload: str = "payload", key: str = "id") -> DataFrame:
    """Add the INT ``id`` of each payload; a payload without one is rejected."""
    identified = rows.withColumn("id", P.get_int(F.col(payload), key))
    return identified.withColumn(
        "reject_reason",
        F.coalesce(F.col("reject_reason"), F.when(F.col("id").isNull(), BAD_ID)),
    )


def envelope_text(data: Column, database: Column, table: Column, op: Column, whole: bool = False) -> Column:
    """Envelope JSON of a document; ``_id`` is no field of the document and stays only in ``whole``."""
    return F.to_json(
        F.struct(
            (data if whole else P.drop_key(data, "_id")).alias("data"),
            database.alias("database"),
            table.alias("table"),
            op.alias("type"),
        )
    )
