"""Joins to lookup tables whose plan depends on measured sizes: of the table, and of the keys that are looked up.

A table that fits is broadcast. One that does not is narrowed to the rows that a batch names (``narrowed``): the distinct
keys of the batch go to the table's scan, not the table to the batch. Where the keys are too many for that, both sides are
shuffled, and only keys counted as hot are spread, each by its rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

BROADCAST_LIMIT_CONF = "spark.tidegate.broadcast.maxBytes"
BROADCAST_LIMIT_DEFAULT = 64 * 1024 * 1024
SALTS_CONF = "spark.tidegate.join.salts"
SALTS_DEFAULT = 16
HOT_ROWS_CONF = "spark.tidegate.join.hotRows"
HOT_ROWS_DEFAULT = 1_000_000
ROW_OVERHEAD_BYTES = 32
SURELY_LARGE_FACTOR = 64
UNKNOWN_SIZE = 2**60
# Places over which rows without a key are spread; they meet nothing in any of them.
NULL_PLACES = 4096


def broadcast_limit(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get(BROADCAST_LIMIT_CONF, str(BROADCAST_LIMIT_DEFAULT)))


def salt_count(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get(SALTS_CONF, str(SALTS_DEFAULT)))


def hot_rows_of(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get(HOT_ROWS_CONF, str(HOT_ROWS_DEFAULT)))


def row_bytes(frame: DataFrame) -> Column:
    """Bytes that a row takes in memory, from above."""
    widths = (
        F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in frame.columns
    )
    return reduce(lambda a, b: a + b, widths, F.lit(ROW_OVERHEAD_BYTES)).cast("bigint")


def measure_bytes(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Bytes that each table would take in memory, from one aggregation over all of them."""
    sized = (
        t.select(F.lit(name).alias("name"), row_bytes(t).alias("bytes"))
        for name, t in tables.items()
    )
    totals = (
        reduce(DataFrame.unionAll, sized).groupBy("name").agg(F.sum("bytes").alias("bytes"))
    )
    found = {row["name"]: row["bytes"] for row in totals.collect()}
    return {name: found.get(name, 0) for name in tables}


def estimated_bytes(table: DataFrame) -> int:
    """The planner's estimate, taken without a job."""
    return int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def surely_large(table: DataFrame) -> bool:
    """The planner's estimate is so far above the limit that measuring would be wasted.

    An estimate beyond all storage means that the planner knows nothing of the table.
    """
    return SURELY_LARGE_FACTOR * broadcast_limit(table) < estimated_bytes(table) < UNKNOWN_SIZE


def fits_broadcast(table: DataFrame) -> bool:
    if surely_large(table):
        return False
    return measure_bytes({"table": table})["table"] <= broadcast_limit(table)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    spread: Sequence[str],
    salts: int | None = None,
) -> DataFrame:
    """Join by shuffle that spreads each key over ``salts`` partitions.

    Rows of the left side are spread by the hash of their ``spread`` columns; the right side is
    repeated per salt, so every left row still meets all its partners exactly once. Only for a
    narrow right side, and for joins that keep rows of the left side only.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salting cannot keep a {how} join exact")
    salts = salts or salt_count(left)
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def lookup_join(
    left: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    spread: Sequence[str],
    how: str = "left",
    broadcast: bool | None = None,
) -> DataFrame:
    """Equi-join to a lookup table: broadcast if its measured size allows, else with its hot keys spread."""
    if broadcast is None:
        broadcast = fits_broadcast(table)
    if broadcast:
        return left.join(F.broadcast(table), list(on), how)
    return split_hot_keys_join(left, table, on, how, spread, hot_rows_of(left))


def split_hot_keys_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    spread: Sequence[str],
    hot_rows: int,
    salts: int | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """As ``salted_join``, for a right side of any width: only keys with over ``hot_rows`` rows are spread.

    The hot keys come from a count that is reduced before its shuffle, or from ``counts`` (the keys with ``_n``). Each is
    spread over as many partitions as it holds times ``hot_rows`` rows, or over ``salts``. Their table is broadcast if its
    measured size allows. Rows with a NULL in their key meet nothing and are spread without being counted.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"spreading keys cannot keep a {how} join exact")
    whole = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in on))
    spread_over = F.lit(salts) if salts else F.ceil(F.col("_n") / hot_rows).cast("int")
    hot = key_counts(left, on) if counts is None else counts
    hot = hot.filter((F.col("_n") > hot_rows) & whole).select(*on, spread_over.alias("_salts"))
    if fits_broadcast(hot):
        hot = F.broadcast(hot)
    places = F.coalesce("_salts", F.when(whole, 1).otherwise(NULL_PLACES))
    salted = left.join(hot, list(on), "left").withColumn("_salt", F.pmod(F.xxhash64(*spread), places).cast("int"))
    repeated = (
        right.join(hot, list(on), "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_salts")
    )
    return salted.drop("_salts").join(repeated, [*on, "_salt"], how).drop("_salt")


def key_counts(left: DataFrame, on: Sequence[str]) -> DataFrame:
    """The keys of ``left``, each once, with its number of rows ``_n``; a hot key is reduced within each task."""
    return left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))


def kept(frame: DataFrame, place: str) -> tuple[DataFrame, int]:
    """``frame`` written below ``place`` and read again, and the bytes that it takes in memory, from the write itself."""
    seen = Observation()
    size = F.coalesce(F.sum(row_bytes(frame)), F.lit(0)).alias("bytes")
    frame.observe(seen, size).write.parquet(place)
    return frame.sparkSession.read.schema(frame.schema).parquet(place), seen.get["bytes"]


def rows_of(table: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows of ``table`` whose key is in ``keys``, which are broadcast: the table stays where it is scanned."""
    return table.join(F.broadcast(keys), list(on), "left_semi")


@dataclass(frozen=True)
class Narrowed:
    """What a batch needs of a lookup table: ``rows``, whether they fit a broadcast, and the counted keys of the batch."""

    rows: DataFrame
    fits: bool
    counts: DataFrame

    def join(self, left: DataFrame, on: Sequence[str], how: str, spread: Sequence[str]) -> DataFrame:
        if self.fits:
            return left.join(F.broadcast(self.rows), list(on), how)
        return split_hot_keys_join(left, self.rows, on, how, spread, hot_rows_of(left), counts=self.counts)


def narrowed(
    table: DataFrame,
    wanted: DataFrame,
    on: Sequence[str],
    place: str,
    find: Callable[[DataFrame], DataFrame] | None = None,
) -> Narrowed:
    """The part of a large ``table`` that the keys ``wanted`` (the columns ``on``) name.

    The keys are counted in one pass and kept below ``place``. If their distinct ones fit a broadcast, they pick their rows
    at the table's scan, or through ``find``, which gets the keys and reads only what it needs of the table; these rows are
    kept below ``place`` as well and measured. So neither the table nor the batch is shuffled, however large the table is.
    Keys that do not fit leave the table as it is.
    """
    whole = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in on))
    counts, size = kept(key_counts(wanted.filter(whole), on), f"{place}/keys")
    if size > broadcast_limit(wanted):
        return Narrowed(table, False, counts)
    keys = counts.select(*on)
    rows, size = kept(rows_of(table, keys, on) if find is None else find(keys), f"{place}/rows")
    return Narrowed(rows, size <= broadcast_limit(wanted), counts)
