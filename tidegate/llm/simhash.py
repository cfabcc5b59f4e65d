"""SimHash near-duplicates by a vantage-point tree over the fingerprints.

Each inner node of the tree has a vantage fingerprint and a radius; fingerprints within the radius are on its near
side. The tree is built on a bounded sample. Each distinct fingerprint has one home leaf. By the triangle inequality, a
pair within ``RADIUS`` bits that parts at a node lies within ``RADIUS`` of its boundary, so a fingerprint also
visits the other side where it is that close. Of a pair that parts, the one on the near side visits, so each pair
meets exactly in the home leaf of the other one. Leaves compare all that meets, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidegate.llm.components import components
from tidegate.llm.store import stored

BITS, RADIUS, SHINGLE, SEED = 64, 3, 3, 42
#: Fingerprints that the tree is built on, at most (in expectation; drawn by a hash).
SAMPLE = 100_000
LEAF = 1_000
#: Home fingerprints and visitors that one task holds, at most some.
HOME_BLOCK, VISIT_BLOCK = 4_096, 65_536
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_PIECE = 1 << 16


def fingerprint(text: str | None) -> int:
    """Signed 64-bit fingerprint of a whole text; 0 if it has no words."""
    words = (text or "").encode().translate(_LOWER).split()  # bytes split at \x20 and \x09-\x0d
    if not words:
        return 0
    if len(words) < SHINGLE:
        words = [b" ".join(words)]
        shingles = words
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))
    digest, counts, n = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), 0
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    for start in range(0, len(hashes), _PIECE):
        piece = hashes[start : start + _PIECE]
        counts += np.unpackbits(piece.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(piece)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp for each row; a null text has no words."""
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(t.as_py()) for t in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), fps], ["doc_id", "fp"])

    return given.mapInArrow(run, f"doc_id {dict(given.dtypes)['doc_id']}, fp long")


class Tree:
    """Arrays by node: vantage, radius, near and far child; a leaf has children of -1 and the number ``leaf``."""

    def __init__(self, sample: np.ndarray, leaves: int, seed: int = 1):
        self.vantage, self.radius, self.near, self.far, self.leaf = [], [], [], [], []
        self.leaves = 0
        rng = np.random.default_rng(seed)
        depth = max(0, int(np.ceil(np.log2(max(leaves, 1)))))
        self._grow(sample, depth, rng)
        self.vantage = np.array(self.vantage, np.uint64)
        for name in ("radius", "near", "far", "leaf"):
            setattr(self, name, np.array(getattr(self, name), np.int64))

    def _grow(self, points: np.ndarray, depth: int, rng) -> int:
        at = len(self.vantage)
        for a in (self.vantage, self.radius, self.near, self.far, self.leaf):
            a.append(-1 if a is not self.vantage else 0)
        if depth and len(points) > 8:
            vantage = points[rng.integers(len(points))]
            away = np.bitwise_count(points ^ vantage)
            radius = int(np.median(away))
            near = away <= radius
            if near.all():
                radius -= 1
                near = away <= radius
            if near.any():
                self.vantage[at], self.radius[at] = vantage, radius
                self.near[at] = self._grow(points[near], depth - 1, rng)
                self.far[at] = self._grow(points[~near], depth - 1, rng)
                return at
        self.leaf[at] = self.leaves
        self.leaves += 1
        return at

    def routes(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, leaf and whether the leaf is its home, for every leaf that each fingerprint must be in."""
        row, node, home = np.arange(len(fps)), np.zeros(len(fps), np.int64), np.ones(len(fps), bool)
        out = []
        while len(row):
            ended = self.leaf[node] >= 0
            out.append((row[ended], self.leaf[node[ended]], home[ended]))
            row, node, home = row[~ended], node[~ended], home[~ended]
            away = np.bitwise_count(fps[row] ^ self.vantage[node]).astype(np.int64) - self.radius[node]
            near = away <= 0
            cross = np.where(near, away > -RADIUS, ~home & (away <= RADIUS))
            other = np.where(near, self.far[node], self.near[node])[cross]
            own = np.where(near, self.near[node], self.far[node])
            row, node, home = np.concatenate([row, row[cross]]), np.concatenate([own, other]), np.concatenate([home, np.zeros(cross.sum(), bool)])
        return tuple(np.concatenate(parts) for parts in zip(*out))


def _linked(homes: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links between both: pairs of a fingerprint and another one of its component."""
    points, at = np.unique(np.concatenate([homes, others]), return_inverse=True)
    at_home, at_other = at[: len(homes)], at[len(homes) :]
    left, right = [], []
    step = max(1, 4_000_000 // max(len(homes), 1))
    for start in range(0, len(others), step):
        block = others[start : start + step]
        i, j = np.nonzero(np.bitwise_count(block[:, None] ^ homes[None, :]) <= RADIUS)
        a, b = at_other[start + i], at_home[j]
        differs = a != b
        left.append(a[differs]), right.append(b[differs])
    a, b = np.concatenate([*left, at[:0]]), np.concatenate([*right, at[:0]])
    label = np.arange(len(points))
    while True:  # each point takes the least label around it, then that label's own
        least = label.copy()
        np.minimum.at(least, a, label[b])
        np.minimum.at(least, b, label[a])
        least = least[least]
        if (least == label).all():
            break
        label = least
    moved = label != np.arange(len(points))
    return points[moved], points[label[moved]]


def near_links(fps: DataFrame) -> DataFrame:
    """Columns a, b: links that join all fingerprints within RADIUS bits. ``fps`` has distinct values of ``fp``.

    Links inside a leaf are given as a forest, not as all pairs. Leaves are cut into blocks by their counted rows,
    so that a dense leaf is spread over many tasks.
    """
    n = fps.count()
    share = min(1.0, SAMPLE / max(n, 1))
    drawn = fps.filter(F.pmod(F.xxhash64("fp"), F.lit(1_000_000)) < int(share * 1_000_000)) if share < 1 else fps
    sample = np.array([r.fp for r in drawn.orderBy("fp").collect()], np.int64).view(np.uint64)
    tree = Tree(sample, n // LEAF)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2_000):
                values = batch.column("fp").slice(start, 2_000).to_numpy().view(np.uint64)
                row, leaf, home = tree.routes(values)
                yield pa.RecordBatch.from_pydict({"leaf": leaf, "fp": values[row].view(np.int64), "home": home})

    def compare(group: pa.Table) -> pa.Table:
        values, homes = group.column("fp").to_numpy().view(np.uint64), group.column("member").to_numpy(zero_copy_only=False)
        a, b = _linked(values[homes], values[~homes])
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    routed = stored(fps.select("fp").mapInArrow(route, "leaf long, fp long, home boolean"), "vp-routes")
    sizes = routed.groupBy("leaf").agg(
        F.ceil(F.sum(F.col("home").cast("long")) / HOME_BLOCK).alias("home_blocks"), F.ceil(F.count("*") / VISIT_BLOCK).alias("visit_blocks")
    )
    placed = routed.join(sizes.filter("home_blocks > 0"), "leaf").withColumn("h", F.xxhash64("fp"))
    homes = placed.filter("home").selectExpr(
        "leaf", "pmod(h, home_blocks) as i", "explode(sequence(0L, visit_blocks - 1)) as j", "fp", "true as member"
    )
    visits = placed.selectExpr("leaf", "explode(sequence(0L, home_blocks - 1)) as i", "pmod(h, visit_blocks) as j", "fp", "false as member")
    met = homes.union(visits).groupBy("leaf", "i", "j").applyInArrow(compare, "a long, b long")
    return stored(met.distinct(), "vp-links")


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint, component_id for each row of ``docs``; exact for all pairs of fingerprints.

    Words are the runs of non-space characters with A-Z lower-cased; a text of fewer than three words is one shingle,
    one without words has fingerprint 0 and links like any other. component_id is the smallest doc_id that can be
    reached over links, null only if no row of the component has an id. Equal fingerprints are compared once,
    however many rows have them. Other columns are not looked at; an empty table gives an empty result.
    """
    rows = stored(fingerprints(docs, doc_id, text), "simhash-rows")
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-fps")
    roots = components(near_links(fps))
    placed = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    placed = stored(placed, "simhash-roots")
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(smallest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each component of ``docs``, with all columns: the one of the smallest doc_id, null last.

    Of several rows with this id the one whose text has the least hash stays; of equal rows, one.
    """
    hashed = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.select(F.struct("doc_id", hashed.alias("h")).alias("row_id"), "text")
    classes = stored(near_classes(rows, "row_id", "text"), "simhash-classes")
    best = classes.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id.doc_id").isNull(), "doc_id")).alias("best"), F.count("*").alias("n"))
    best = best.select(F.col("best.doc_id.doc_id").alias("k_doc_id"), F.col("best.doc_id.h").alias("k_h"))
    same = classes.groupBy("doc_id").count().filter("count > 1")
    packed = docs.select("doc_id", hashed.alias("h"), F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"))
    kept = packed.join(best, F.col("doc_id").eqNullSafe(F.col("k_doc_id")) & (F.col("h") == F.col("k_h")), "leftsemi")
    if not same.isEmpty():
        kept = kept.dropDuplicates(["doc_id", "h"])
    return kept.select("row.*")
