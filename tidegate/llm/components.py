"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegate.llm.store import stored


def components(edges: DataFrame) -> DataFrame:
    """Columns node, root for each node of ``edges`` (a, b) that is not the smallest of its component.

    Each round shortens all paths to the smallest node, so their number grows with the logarithm of the longest
    path. Minima are aggregated before the shuffle; the hub of a star meets its rows in joins whose large
    partitions can be split.
    """
    now = stored(edges.filter("a <> b").selectExpr("greatest(a, b) as u", "least(a, b) as v").distinct(), "edges")
    known = _mark(now)
    while known[0]:
        both = now.union(now.selectExpr("v as u", "u as v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) as m")
        large = both.join(least, "u").filter("v > u").selectExpr("v as u", "m as v").filter("u <> v").distinct()
        large = stored(large.selectExpr("greatest(u, v) as u", "least(u, v) as v"), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").selectExpr("v as u", "m as v").union(least.selectExpr("u", "m as v"))
        now = stored(small.filter("u <> v").selectExpr("greatest(u, v) as u", "least(u, v) as v").distinct(), "small-star")
        if (mark := _mark(now)) == known:
            break
        known = mark
    return now.selectExpr("u as node", "v as root")


def _mark(edges: DataFrame) -> tuple:
    """Tells sets of edges apart."""
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(cast(pmod(xxhash64(v, u), 1000000007) as decimal(30, 0)))")).first())
