"""Latest-state tables on shared storage: bucketed snapshots for dimensions, a levelled log for the index.

What makes up a table is told by its newest manifest (see ``manifests``). One writer per table; readers take no notice of
it, and with a lease their files stay however long they read.
"""

from __future__ import annotations

import json
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from typing import Iterator, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidegate.operators.latest import latest_per_key, live
from tidegate.sinks.manifests import Leases, Manifests, drop_folder, filesystem, folder_bytes, names

# Versions that stay: some eight minutes of batches every five seconds.
VERSIONS_KEPT = 100
# Bytes of files that a bucket has on the average before the number of buckets is doubled.
BUCKET_BYTES = 64 * 1024 * 1024
# Rows of a bucket on the average, likewise: one task sorts them, and files say little of their size in memory.
BUCKET_ROWS = 250_000
# Runs of a level that are folded into one of the next level.
FANOUT = 8
LEASE_SECONDS = 3600.0


def committed_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path`` that Spark has written to their end, in order."""
    fs, root = filesystem(spark, path)
    if not fs.exists(root):
        return []
    folders = (status.getPath() for status in fs.listStatus(root) if status.isDirectory())
    committed = (
        f.getName() for f in folders if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))
    )
    return sorted(committed)


def version_folder(number: int) -> str:
    return f"v={number:012d}"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _doubled(buckets: int, rows: int, bucket_rows: int, size: int = 0, bucket_bytes: int = BUCKET_BYTES) -> int:
    """``buckets`` doubled until they hold no more than the given rows and bytes on the average."""
    while rows > buckets * bucket_rows or size > buckets * bucket_bytes:
        buckets *= 2
    return buckets


def _read(spark: SparkSession, schema: str, folders: Sequence[str]) -> DataFrame:
    struct = StructType.fromJson(json.loads(schema))
    return spark.read.schema(struct).parquet(*folders) if folders else spark.createDataFrame([], struct)


@dataclass(frozen=True)
class SnapshotTable:
    """A dimension: hash buckets of its keys, of which an upsert rewrites those that it touches.

    A manifest per version names one folder for each bucket, that of the version that wrote it last. Readers take the
    newest manifest, so they see a batch whole or not at all. The buckets begin as ``buckets`` and are doubled by an
    upsert that finds them larger than ``bucket_bytes``, or gives them more than ``bucket_rows``, on the average, so that
    small tables are one file and no task holds a large one.

    A version stays while it is one of the newest ``keep``, younger than ``hold_seconds``, or held by a reader's lease.
    Deleted keys stay as marked rows, so that a late or replayed older change cannot bring them back.
    """

    spark: SparkSession
    path: str
    keys: Sequence[str]
    version: Sequence[str]
    keep: int = VERSIONS_KEPT
    buckets: int = 1
    bucket_bytes: int = BUCKET_BYTES
    hold_seconds: float = 0.0
    bucket_rows: int = BUCKET_ROWS

    @property
    def manifests(self) -> Manifests:
        return Manifests(self.spark, f"{self.path}/_manifests")

    @property
    def leases(self) -> Leases:
        return Leases(self.spark, f"{self.path}/_leases")

    def newest_version(self) -> int:
        """Number of the newest version, -1 before the first. What is derived from a version can be kept by it."""
        numbers = self.manifests.numbers()
        return numbers[-1] if numbers else -1

    def _folder(self, bucket: int | str, version: int) -> str:
        return f"{self.path}/{version_folder(version)}/_bucket={bucket}"

    def _folders(self, manifest: dict, buckets: Sequence[int] | None = None) -> list[str]:
        wanted = manifest["folders"] if buckets is None else [str(b) for b in buckets if str(b) in manifest["folders"]]
        return [self._folder(b, manifest["folders"][b]) for b in wanted]

    def _opened(self, manifest: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        return _read(self.spark, manifest["schema"], self._folders(manifest, buckets))

    def state(self) -> DataFrame | None:
        """The newest state with deleted keys, None before the first upsert."""
        _, manifest = self.manifests.newest()
        return None if manifest is None else self._opened(manifest)

    def _existing(self) -> tuple[int, dict]:
        number, manifest = self.manifests.newest()
        if manifest is None:
            raise ValueError(f"no committed version below {self.path}")
        return number, manifest

    def read(self) -> DataFrame:
        return _live(self._opened(self._existing()[1]))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows whose key is in ``keys`` (its columns are the table's keys); only their buckets are read.

        One job over ``keys`` tells the buckets, of which there are as many as the table has at the most.
        """
        _, manifest = self._existing()
        touched = keys.select(bucket_of(self.keys, manifest["buckets"]).alias("b")).distinct().collect()
        state = self._opened(manifest, sorted(row["b"] for row in touched))
        return _live(state).join(keys.select(*self.keys).distinct(), list(self.keys), "left_semi")

    @contextmanager
    def reading(self, seconds: float = LEASE_SECONDS) -> Iterator[DataFrame]:
        """The newest state, whose files stay until the block ends, or for ``seconds`` if it never does."""
        while True:
            number, _ = self._existing()
            lease = self.leases.take(number, seconds)
            try:
                manifest = self.manifests.read(number)
                break
            except Exception as error:  # expired before the lease was there
                self.leases.give_back(lease)
                if "FileNotFound" not in str(error):
                    raise
        try:
            yield _live(self._opened(manifest))
        finally:
            self.leases.give_back(lease)

    def upsert(self, changes: DataFrame) -> None:
        """Merge ``changes``; older versions in them lose, so a replay changes nothing. Keys are not NULL.

        ``changes`` is read once. The reduced changes are kept for the count of touched buckets and for the write.
        """
        number, manifest = self.manifests.newest()
        buckets = manifest["buckets"] if manifest else self.buckets
        newest = latest_per_key(changes, self.keys, self.version).withColumn("_bucket", bucket_of(self.keys, buckets))
        newest = newest.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            found = {row["_bucket"]: row["count"] for row in newest.groupBy("_bucket").count().collect()}
            touched = sorted(found)
            if not touched and manifest is not None:
                return
            rows = sum(found.values()) + (self._opened(manifest).count() if manifest else 0)  # new keys at the most
            size = sum(manifest["bytes"].values()) if manifest else 0
            wanted = _doubled(buckets, rows, self.bucket_rows, size, self.bucket_bytes)
            if wanted > buckets and size <= buckets * self.bucket_bytes and manifest:  # replaced rows are no growth
                rows = self._opened(manifest).select(*self.keys).union(newest.select(*self.keys)).distinct().count()
                wanted = _doubled(buckets, rows, self.bucket_rows)
            grown, buckets = wanted > buckets, wanted
            dealt = newest.withColumn("_bucket", bucket_of(self.keys, buckets)) if grown else newest
            self._write(dealt, number + 1, manifest, buckets, None if grown else touched)
        finally:
            newest.unpersist()
        self.expire(self.keep)

    def _write(self, newest: DataFrame, number: int, manifest: dict | None, buckets: int, touched: list[int] | None) -> None:
        """Write the touched buckets (None: all, dealt anew) as version ``number``, then its manifest."""
        merged, schema = newest, newest.drop("_bucket").schema
        if manifest is not None:
            before = self._opened(manifest, touched).withColumn("_bucket", bucket_of(self.keys, buckets))
            both = before.unionByName(newest)
            dealt = both.repartition(len(touched) if touched else buckets, "_bucket")  # the groups are in these already
            merged = latest_per_key(dealt, ["_bucket", *self.keys], self.version)
        else:
            merged = merged.repartition(max(1, len(touched) if touched is not None else buckets), "_bucket")
        folder = f"{self.path}/{version_folder(number)}"
        merged.write.mode("overwrite").partitionBy("_bucket").parquet(folder)
        written = [name.removeprefix("_bucket=") for name in names(self.spark, folder) if name.startswith("_bucket=")]
        kept = manifest if manifest is not None and touched is not None else {"folders": {}, "bytes": {}}
        self.manifests.commit(
            number,
            {
                "buckets": buckets,
                "schema": manifest["schema"] if manifest else schema.json(),
                "folders": {**kept["folders"], **{b: number for b in written}},
                "bytes": {**kept["bytes"], **{b: folder_bytes(self.spark, f"{folder}/_bucket={b}") for b in written}},
            },
        )

    def expire(self, keep: int) -> None:
        """Drop the versions that have to stay for none of the reasons, and the buckets that only these name."""
        numbers = self.manifests.numbers()
        old = numbers[:-keep] if keep else []
        if not old:
            return
        held, gone, stay = set(self.leases.held()), {}, []
        for number in old:
            manifest = self.manifests.read(number)
            if number not in held and manifest["at"] + self.hold_seconds <= time.time():
                gone[number] = manifest
                continue
            stay.append(manifest)
            if number not in held:  # the following ones are younger
                break
        else:
            stay.append(self.manifests.read(numbers[len(old)]))
        # A bucket never goes back to an older folder, so the oldest version that stays names all that later ones share with older ones.
        named = {(b, v) for m in stay for b, v in m["folders"].items()}
        versions = {v for _, v in named}
        dropped = {(b, v) for m in gone.values() for b, v in m["folders"].items()} - named
        for number in gone:  # a version without manifest is not read any more, so its files go after it
            self.manifests.drop(number)
        for bucket, version in dropped:
            if version in versions:
                drop_folder(self.spark, self._folder(bucket, version))
        for version in ({v for _, v in dropped} | set(gone)) - versions:
            drop_folder(self.spark, f"{self.path}/{version_folder(version)}")


def _live(state: DataFrame) -> DataFrame:
    return live(state).drop("deleted") if "deleted" in state.columns else state


@dataclass(frozen=True)
class IndexTable:
    """A large keyed table: a batch is appended as its own folder, reads take the latest per key.

    A write costs what the batch holds, whatever the table's size. A replayed batch replaces its own folder. ``fold``
    merges ``fanout`` batches into a run of the first level, ``fanout`` runs of a level into one of the next, so a row is
    written once per level, and a reader opens no more than ``fanout`` folders of each of a logarithmic number of levels.
    Runs are bucketed by key, which ``lookup`` uses; a run has ``buckets``, doubled to ``bucket_rows`` and ``BUCKET_BYTES`` each.

    Folded folders stay for readers that opened the table before: until ``hold_seconds`` have passed, and longer for those
    that took a lease.
    """

    spark: SparkSession
    path: str
    keys: Sequence[str]
    version: Sequence[str]
    fanout: int = FANOUT
    buckets: int = 1
    hold_seconds: float = 0.0
    bucket_rows: int = BUCKET_ROWS

    def __post_init__(self) -> None:
        if self.fanout < 2:
            raise ValueError("a fold takes two folders or more")

    @property
    def manifests(self) -> Manifests:
        return Manifests(self.spark, f"{self.path}/_manifests")

    @property
    def leases(self) -> Leases:
        return Leases(self.spark, f"{self.path}/_leases")

    def write(self, documents: DataFrame, batch_key: str) -> None:
        documents.write.mode("overwrite").parquet(f"{self.path}/batches/batch={batch_key}")

    def _newest(self) -> tuple[int, dict]:
        number, manifest = self.manifests.newest()
        return number, manifest or {"levels": [], "retired": []}

    def _batches(self, manifest: dict) -> list[str]:
        """Committed batches that are in no run. One that is written again after its folder went only repeats rows."""
        folded = {retired["folder"] for retired in manifest["retired"]}
        found = (f"batches/{name}" for name in committed_folders(self.spark, f"{self.path}/batches"))
        return [folder for folder in found if folder not in folded]

    def folders(self) -> list[str]:
        """The folders that a reader opens now."""
        _, manifest = self._newest()
        return [*self._batches(manifest), *(run for level in manifest["levels"] for run in level)]

    def _merged(self, folders: Sequence[str]) -> DataFrame:
        both = reduce(
            DataFrame.unionByName, (self.spark.read.parquet(*group) for group in self._alike(folders))
        )
        return latest_per_key(both, self.keys, self.version)

    def _alike(self, folders: Sequence[str]) -> list[list[str]]:
        """Batches, and the buckets of the runs, each as paths that Spark reads at once."""
        batches = [f"{self.path}/{f}" for f in folders if f.startswith("batches/")]
        runs = [f"{self.path}/{f}/{b}" for f in folders if not f.startswith("batches/") for b in names(self.spark, f"{self.path}/{f}") if b.startswith("_bucket=")]
        return [group for group in (batches, runs) if group]

    def state(self) -> DataFrame:
        folders = self.folders()
        if not folders:
            raise ValueError(f"no committed batch below {self.path}")
        return self._merged(folders)

    def read(self) -> DataFrame:
        return _live(self.state())

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys`` (its columns are the table's keys): from batches, and from their buckets of the runs."""
        folders = self.folders()
        if not folders:
            raise ValueError(f"no committed batch below {self.path}")
        named = keys.select(*self.keys).distinct()
        numbers = {int(run.rsplit("-", 1)[1]) for run in folders if run.startswith("runs/")}
        touched = {(n, row["b"]) for n in numbers for row in named.select(bucket_of(self.keys, n).alias("b")).distinct().collect()}

        def wanted(path: str) -> bool:
            if "/batches/batch=" in path:
                return True
            run, bucket = path.rsplit("/", 2)[1:]
            return (int(run.rsplit("-", 1)[1]), int(bucket.removeprefix("_bucket="))) in touched

        groups = [[path for path in group if wanted(path)] for group in self._alike(folders)]
        parts = [self.spark.read.parquet(*group) for group in groups if group]
        if not parts:
            return self.read().limit(0)
        found = (part.join(named, list(self.keys), "left_semi") for part in parts)
        return _live(latest_per_key(reduce(DataFrame.unionByName, found), self.keys, self.version))

    @contextmanager
    def reading(self, seconds: float = LEASE_SECONDS) -> Iterator[DataFrame]:
        """The rows as they are now; their files stay until the block ends, or for ``seconds`` if it never does."""
        lease = self.leases.take(self.manifests.newest()[0], seconds)  # before the folders are looked up
        try:
            yield self.read()
        finally:
            self.leases.give_back(lease)

    def fold(self) -> int:
        """Fold each level that is full, from the batches up. Returns the number of folds; readers may go on."""
        folds, level = 0, 0
        while True:
            number, manifest = self._newest()
            levels = [self._batches(manifest), *manifest["levels"]]
            if level >= len(levels):
                break
            if len(levels[level]) >= self.fanout:
                self._replace(number, manifest, levels, level, level)
                folds += 1
            level += 1
        self.sweep()
        return folds

    def compact(self) -> None:
        """Fold everything into one run."""
        number, manifest = self._newest()
        levels = [self._batches(manifest), *manifest["levels"]]
        if sum(map(len, levels)) > (0 if levels[0] else 1):
            self._replace(number, manifest, levels, 0, len(levels) - 1)
        self.sweep()

    def _replace(self, number: int, manifest: dict, levels: list[list[str]], first: int, last: int) -> None:
        """One run of the level behind ``last`` for all that is in the levels from ``first`` on."""
        folded = [folder for level in levels[first : last + 1] for folder in level]
        rows = sum(self.spark.read.parquet(*group).count() for group in self._alike(folded))  # told by the files' footers
        buckets = _doubled(self.buckets, rows, self.bucket_rows, sum(folder_bytes(self.spark, f"{self.path}/{f}") for f in folded))
        run = f"runs/{uuid.uuid4().hex}-{buckets}"
        merged = self._merged(folded).withColumn("_bucket", bucket_of(self.keys, buckets))
        merged.repartition(buckets, "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{run}")
        target = last + 1 if first == last else last
        runs = [[] if first <= i <= last else list(level) for i, level in enumerate(levels)] + [[]]
        runs[max(target, 1)].append(run)
        kept = runs[1:]
        while kept and not kept[-1]:
            kept.pop()
        retired = manifest["retired"] + [{"folder": folder, "number": number + 1, "at": time.time()} for folder in folded]
        self.manifests.commit(number + 1, {"levels": kept, "retired": retired})

    def sweep(self) -> None:
        """Delete folded folders that no reader can have open, old manifests, and runs of failed folds."""
        number, manifest = self._newest()
        if number < 0:
            return
        oldest = min(self.leases.held(), default=number)
        now = time.time()
        done = [r for r in manifest["retired"] if r["number"] <= oldest and r["at"] + self.hold_seconds <= now]
        for retired in done:
            drop_folder(self.spark, f"{self.path}/{retired['folder']}")
        named = {run for level in manifest["levels"] for run in level} | {r["folder"] for r in manifest["retired"]}
        for run in names(self.spark, f"{self.path}/runs"):
            if f"runs/{run}" not in named:
                drop_folder(self.spark, f"{self.path}/runs/{run}")
        if done:
            left = [r for r in manifest["retired"] if r not in done]
            self.manifests.commit(number + 1, {"levels": manifest["levels"], "retired": left})
        for old in self.manifests.numbers()[:-2]:
            self.manifests.drop(old)
