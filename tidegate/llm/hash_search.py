"""Nearest neighbours by multi-index hashing of learned binary codes.

Vectors are centred and rotated so that the signs of the coordinates lose little (alternating the code and the
best rotation to it, on a bounded sample). A code is cut into substrings, each with an index of its own. Two codes within
``radius`` bits agree in at least one substring up to ``radius / substrings`` bits, so probing each index that
far retrieves every code within the radius; these are ranked by their vectors. The radius is the one that holds the
true neighbours within the sample, which are farther apart than in the whole table.

Index rows are dealt over shards; each block of queries meets each shard once and takes the best few from it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.llm.store import stored

#: Rows that the rotation and the radius are fitted on, at most (in expectation; drawn by a hash).
SAMPLE = 4_096
BITS, SUBSTRINGS = 64, 4
SHARD_ROWS, QUERY_ROWS = 8_192, 2_048
#: Share of the true neighbours in the sample that the radius holds.
HELD = 0.97


@dataclass
class Codes:
    """Centre, rotation (columns are bits) and probing radius."""

    centre: np.ndarray
    rotation: np.ndarray
    radius: int

    def of(self, vectors: np.ndarray) -> np.ndarray:
        bits = (_unit(vectors) - self.centre) @ self.rotation > 0
        padded = np.zeros((len(bits), BITS), bool)
        padded[:, : bits.shape[1]] = bits
        return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)[:, 0]


def usable(vector: Column) -> Column:
    """Neither null nor zero, no null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(vectors: np.ndarray) -> np.ndarray:
    scale = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / scale
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _cosine(units: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Row by row in the same order of sums, so equal vectors get equal scores."""
    return (units * query).sum(axis=1)


def learned_codes(sample: np.ndarray, neighbours: int, seed: int = 1, rounds: int = 30) -> Codes:
    units = _unit(sample)
    centre = units.mean(axis=0)
    _, _, axes = np.linalg.svd(units - centre, full_matrices=False)
    axes = axes[:BITS].T
    rng = np.random.default_rng(seed)
    turn, _ = np.linalg.qr(rng.normal(size=(axes.shape[1], axes.shape[1])))
    flat = (units - centre) @ axes
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.sign(flat @ turn).T @ flat)
        turn = (left @ right).T
    made = Codes(centre, axes @ turn, BITS)
    codes, away = made.of(sample), []
    for i in range(0, len(sample), max(1, len(sample) // 512)):
        score = _cosine(units, units[i])
        score[i] = -np.inf
        best = np.argsort(-score)[: min(neighbours, len(sample) - 1)]
        away.extend(np.bitwise_count(codes[best] ^ codes[i]).tolist())
    made.radius = int(np.quantile(away, HELD)) if away else BITS
    return made


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.combine_chunks()
    return rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)


def _retrieved(codes: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """Mask (query, row) of the codes within the radius, through the index of each substring."""
    width = BITS // SUBSTRINGS
    found = np.zeros((len(queries), len(codes)), bool)
    for s in range(SUBSTRINGS):
        part = lambda c: (c >> np.uint64(s * width)) & np.uint64((1 << width) - 1)
        buckets, bucket_of = np.unique(part(codes), return_inverse=True)
        probed = np.bitwise_count(part(queries)[:, None] ^ buckets[None, :]) <= radius // SUBSTRINGS
        found |= probed[:, bucket_of]
    return found & (np.bitwise_count(queries[:, None] ^ codes[None, :]) <= radius)


def _search(radius: int, k: int):
    def run(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy(zero_copy_only=False)
        rid, vec_id, code = (group.column(c).to_numpy(zero_copy_only=False) for c in ("rid", "order_id", "code"))
        units, code = _unit(_vectors(group.column("vector"))), code.view(np.uint64)
        at = np.nonzero(~asks)[0]
        out: dict[str, list] = {"query": [], "found": [], "score": []}
        rows = np.nonzero(asks)[0]
        for start in range(0, len(rows), 64):
            block = rows[start : start + 64]
            near = _retrieved(code[at], code[block], radius)
            for q, hits in zip(block, near):
                hits = at[hits]
                hits = hits[rid[hits] != rid[q]]
                score = _cosine(units[hits], units[q])
                best = np.lexsort((rid[hits], vec_id[hits], -score))[:k]
                out["query"] += [rid[q]] * len(best)
                out["found"] += rid[hits[best]].tolist()
                out["score"] += score[best].tolist()
        return pa.table({"query": pa.array(out["query"], pa.int64()), "found": pa.array(out["found"], pa.int64()), "score": pa.array(out["score"], pa.float64())})

    return run


def _best(rows: DataFrame, n: int, asked: DataFrame, n_asked: int, radius: int, k: int) -> DataFrame:
    """query, found (row numbers), score, rank: the best of all shards."""
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-n_asked // QUERY_ROWS))
    named = ["rid", "order_id", "code", "vector"]
    index = rows.select(F.pmod(F.xxhash64("rid"), F.lit(shards)).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), *named, F.lit(False).alias("asks"))
    asks = asked.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.pmod(F.xxhash64("rid"), F.lit(blocks)).cast("int").alias("block"), *named, F.lit(True).alias("asks"))
    met = index.union(asks).groupBy("shard", "block").applyInArrow(_search(radius, k), "query long, found long, score double")
    met = met.join(rows.select(F.col("rid").alias("found"), "order_id"), "found")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "order_id", "found")
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query", "found", "score", "rank")


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of largest cosine found for each row that ``is_query`` holds for.

    All rows but the query's own are candidates; ties go to the smaller id, null last. Vectors that are null, zero
    or hold null or non-finite components take no part. Only vectors of one length are neighbours; each length has
    codes of its own and is searched by itself. A query for
    which the radius holds fewer than ``k`` rows is asked again over all of them. Repeated rows are rows of their own. Empty
    without queries.
    """
    given = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(vector, lambda x: x.cast("double")).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    given = given.filter(usable(F.col("vector")))
    lengths = given.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"), F.bool_or("asks").alias("asked")).orderBy("length").collect()
    found = [_nearest(given.filter(F.size("vector") == r["length"]), r["length"], r["n"], k) for r in lengths if r["asked"] and r["n"] > 1]
    if not found:
        return given.selectExpr("vec_id as query_id", "0 as rank", "vec_id", "0D as score").limit(0)
    return reduce(DataFrame.unionByName, found)


def _nearest(given: DataFrame, length: int, n: int, k: int) -> DataFrame:
    """As ``nearest`` for the ``n`` usable vectors of one length."""
    share = min(1.0, SAMPLE / n)
    drawn = given.filter(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(1_000_000)) < max(1, int(share * 1_000_000))) if share < 1 else given
    drawn = drawn.select("vector").orderBy("vector").collect()
    codes = learned_codes(np.array([r.vector for r in drawn] or [[1.0] * length]), k)

    def coded(batches):
        for batch in batches:
            column = batch.column("vector")
            if len(column):
                code = codes.of(_vectors(pa.chunked_array([column]))).view(np.int64)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code)], [*batch.schema.names, "code"])

    rows = given.withColumn("rid", F.monotonically_increasing_id()).withColumn("order_id", F.coalesce("vec_id", F.lit((1 << 63) - 1)))
    rows = stored(rows.mapInArrow(coded, "vec_id long, vector array<double>, asks boolean, rid long, order_id long, code long"), "search-codes")
    asked = rows.filter("asks")
    n_asked = asked.count()
    found = stored(_best(rows, n, asked, n_asked, codes.radius, k), "search-found")
    full = found.groupBy("query").count().filter(F.col("count") >= min(k, n - 1)).select(F.col("query").alias("rid"))
    short = stored(asked.join(full, "rid", "leftanti"), "search-short")
    if n_short := short.count():
        found = found.join(short.select(F.col("rid").alias("query")), "query", "leftanti").unionByName(_best(rows, n, short, n_short, BITS, k))
    named = lambda role, name: rows.select(F.col("rid").alias(role), F.col("vec_id").alias(name))
    return found.join(named("query", "query_id"), "query").join(named("found", "vec_id"), "found").select("query_id", "rank", "vec_id", "score")
