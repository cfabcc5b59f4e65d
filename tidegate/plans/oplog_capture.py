"""Operation log to change envelopes."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from tidegate.functions import payload as P
from tidegate.operators import oplog as O
from tidegate.operators.envelopes import accepted, envelope_text

NO_DOCUMENT = "no_document"
NO_KEY = "no_key"


def judged_entries(log: DataFrame, followed: DataFrame) -> DataFrame:
    """Followed entries with ``doc_id`` and ``reject_reason``.

    An insert needs a document with more than its ``_id``, an update or delete needs a key.
    """
    entries = O.dispatched(O.with_namespace_parts(O.in_namespaces(log, followed)))
    is_insert = F.col("op") == "i"
    keyed = O.with_document_key(entries, F.when(F.col("op") == "u", F.col("o2")).otherwise(F.col("o")))
    reason = F.when(is_insert & ~P.is_non_empty(P.drop_key(F.col("o"), "_id")), NO_DOCUMENT)
    return keyed.withColumn("reject_reason", reason.when(~is_insert & F.col("doc_id").isNull(), NO_KEY))


def capture_entries(
    entries: DataFrame,
    current: DataFrame,
    on: Sequence[str] = ("ns", "doc_id"),
    tombstones: bool = False,
) -> DataFrame:
    """Envelopes of entries that ``judged_entries`` accepts, see ``capture_changes``."""
    fields = ["ts", "ns", "database", "collection", "type", "doc_id"]
    inserts = entries.filter(F.col("op") == "i").select(*fields, F.col("o").alias("doc"))
    looked_up = ("u",) if tombstones else ("u", "d")
    keyed = entries.filter(F.col("op").isin(*looked_up)).select(*fields)
    changes = inserts.unionByName(O.with_image(keyed, current.select(*on, "doc"), on).select(*fields, "doc"))
    place = (F.col("database"), F.col("collection"), F.col("type"))
    value = envelope_text(F.col("doc"), *place)
    if tombstones:
        key_only = P.keep_key(F.col("o"), "_id")
        gone = entries.filter(F.col("op") == "d").select(*fields, key_only.alias("doc"))
        changes = changes.unionByName(gone)
        value = F.when(F.col("type") == "delete", envelope_text(F.col("doc"), *place, whole=True)).otherwise(value)
    return changes.select("ts", "ns", "type", "doc_id", F.col("collection").alias("table"), value.alias("value"))


def capture_changes(
    log: DataFrame,
    current: DataFrame,
    followed: DataFrame,
    on: Sequence[str] = ("ns", "doc_id"),
    tombstones: bool = False,
) -> DataFrame:
    """Envelopes ``ts, ns, type, doc_id, table, value`` of followed entries.

    ``log`` has ``ts, ns, op, o, o2`` with payload maps, ``current`` the ``on`` columns and the
    document ``doc``. Inserts carry their own document and are not shuffled. Updates carry the
    current document. So do deletes, which mostly find none; ``tombstones`` makes them carry their
    key instead, under its own name ``_id``, as the document with its fields is gone. Entries without
    document or key are left out; ``judged_entries`` tells them.
    """
    return capture_entries(accepted(judged_entries(log, followed)), current, on, tombstones)
