"""Operation-log entries: namespaces, bounded scans, dispatch, images and cursors."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate import fixed_values as V
from tidegate.functions import payload as P, text as X
from tidegate.operators.computed import with_computed
from tidegate.operators.lookup import broadcast_limit, estimated_bytes, fits_broadcast, lookup_join, split_hot_keys_join

# Entries of one document above this count are spread over several tasks.
HOT_DOCUMENT_ENTRIES = 1_000_000


def namespaces(
    collections: DataFrame,
    name: str = "name",
    database: str = V.OPLOG_DATABASE,
    tables: Iterable[str] = V.TENANT_TABLES,
) -> DataFrame:
    """Namespaces of the followed collections; prefixes are taken without a closing dot."""
    ns = F.concat(F.lit(database + "."), F.col(name))
    return (
        collections.select(ns.alias("ns"))
        .filter(X.is_not_blank(F.col("ns")))
        .filter(X.starts_with_any(F.col("ns"), [f"{database}.{t}" for t in tables]))
        .distinct()
    )


def in_namespaces(log: DataFrame, followed: DataFrame) -> DataFrame:
    """Entries of followed namespaces. Most entries may lie in a single one."""
    return lookup_join(log, followed, ["ns"], ["ts"], "left_semi")


def first_entry(log: DataFrame) -> DataFrame:
    return log.orderBy("ts").limit(1)


def first_cursor(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return log.groupBy(*by).agg(F.min("ts").alias("cursor_ts"))


def high_water_mark(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cursor after these entries; entries that emit nothing move it too."""
    return log.groupBy(*by).agg(F.max("ts").alias("cursor_ts"))


def start_cursor(log: DataFrame, saved: DataFrame | None, by: Sequence[str] = ()) -> DataFrame:
    """The saved cursor, else the first entry; per ``by`` (such as the shard)."""
    first = first_cursor(log, by)
    if saved is None:
        return first
    unknown = F.lit(None).cast("bigint")
    known = saved.select(*by, F.col("cursor_ts").alias("_saved"), unknown.alias("_first"))
    started = first.select(*by, unknown.alias("_saved"), F.col("cursor_ts").alias("_first"))
    return (
        started.unionByName(known)
        .groupBy(*by)
        .agg(F.max("_saved").alias("_saved"), F.min("_first").alias("_first"))
        .filter(F.col("_first").isNotNull())
        .select(*by, F.coalesce("_saved", "_first").alias("cursor_ts"))
    )


def after_cursor(log: DataFrame, cursor: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Entries behind the cursor. There is one cursor per log or shard."""
    if not by:
        return log.filter(F.col("ts") > cursor.select("cursor_ts").scalar())
    at = lookup_join(log, cursor, by, ["ts"], "inner")
    return at.filter(F.col("ts") > F.col("cursor_ts")).drop("cursor_ts")


def bounded_read(log: DataFrame, rows: int = V.OPLOG_READ_ROWS, by: Sequence[str] = ()) -> DataFrame:
    """The next ``rows`` entries in log order, per ``by`` (such as the shard), and all of the same ``ts`` as the last one.

    A read that ended within a ``ts`` would lose the rest of it, as the next read begins behind the cursor. Only
    the ``ts`` of the first rows is ordered, as a top-k.
    """
    if not by:
        last = log.select("ts").orderBy("ts").limit(rows).agg(F.max("ts").alias("last_ts"))
        return log.filter(F.col("ts") <= last.select("last_ts").scalar())
    place = F.row_number().over(Window.partitionBy(*by).orderBy("ts"))
    last = log.select(*by, "ts").withColumn("place", place).filter(F.col("place") <= rows)
    last = last.groupBy(*by).agg(F.max("ts").alias("last_ts"))
    return lookup_join(log, last, by, ["ts"], "inner").filter(F.col("ts") <= F.col("last_ts")).drop("last_ts")


def with_namespace_parts(log: DataFrame) -> DataFrame:
    """Add ``database``, ``collection``, ``base_table`` and ``tenant_id`` of the namespace.

    A namespace with one dot has no tenant; its base table is the collection.
    """
    collection = F.col("collection")
    tenanted = collection.contains(".")
    return (
        log.withColumn("database", X.before_first_dot(F.col("ns")))
        .withColumn("collection", X.after_first_dot(F.col("ns")))
        .withColumn("base_table", F.when(tenanted, X.before_last_dot(collection)).otherwise(collection))
        .withColumn("tenant_id", F.when(tenanted, X.to_int(X.after_last_dot(collection))))
    )


def op_name(op: Column) -> Column:
    name = F.lit(None).cast("string")
    for code, text in V.OP_NAMES.items():
        name = F.when(op == code, text).otherwise(name)
    return name


def dispatched(log: DataFrame) -> DataFrame:
    return log.withColumn("type", op_name(F.col("op"))).filter(F.col("type").isNotNull())


def changed_fields(o: Column) -> Column:
    """The update document of an entry, if it has one."""
    return P.get_object(o, "$set")


def document_key(entry: Column) -> Column:
    return P.get_string(entry, "_id")


def with_document_key(log: DataFrame, entry: Column) -> DataFrame:
    """Add ``doc_id``, computed once, since joins on it also test it for NULL."""
    return with_computed(log, doc_id=document_key(entry))


def change_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("ns", "op").agg(F.count(F.lit(1)).alias("entries"))


def touched_documents(log: DataFrame, current: DataFrame, on: Sequence[str]) -> DataFrame:
    """Current state of the documents that updates and deletes of the log name.

    Keys are made distinct first, so a document with many entries costs one row. If they fit a broadcast, as
    those of a batch do, the collection is not shuffled.
    """
    keys = log.select(*on).distinct()
    return current.join(F.broadcast(keys) if fits_broadcast(keys) else keys, list(on), "left_semi")


def with_image(
    entries: DataFrame,
    current: DataFrame,
    on: Sequence[str],
    hot_rows: int = HOT_DOCUMENT_ENTRIES,
) -> DataFrame:
    """Entries with the current document of their key: state at read time, none if it is gone.

    A collection that is estimated and measured to be small is broadcast. Otherwise the keys of the entries are
    measured, and if they are few, only the documents that they name are shuffled.
    """
    if estimated_bytes(current) <= broadcast_limit(current) and fits_broadcast(current):
        return entries.join(F.broadcast(current), list(on), "inner")
    keys = entries.select(*on).distinct()
    if fits_broadcast(keys):
        current = current.join(F.broadcast(keys), list(on), "left_semi")
    return split_hot_keys_join(entries, current, on, "inner", ["ts"], hot_rows)
