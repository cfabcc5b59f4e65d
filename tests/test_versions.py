"""Bucketed snapshots and the levelled index: what is rewritten, crashes, readers beside writers, expiry."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from tidegate.sinks import tables as T
from tidegate.sinks.manifests import Leases, Manifests, write_json
from tidegate.streaming import pipelines as S


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.fixture
def table(spark, tmp_path):
    return T.SnapshotTable(spark, f"{tmp_path}/dim", ["id"], ["v"], buckets=8)


@pytest.fixture
def change(spark):
    def made(first, last, v, doc="x"):
        return spark.range(first, last).selectExpr("cast(id as int) as id", f"{v} as v", f"concat('{doc}', id) as doc")

    return made


def test_one_key_rewrites_one_bucket(spark, table, change):
    table.upsert(change(0, 200, 1))
    table.upsert(change(7, 8, 2, "y"))
    assert len(glob.glob(f"{table.path}/v=000000000000/_bucket=*")) == 8
    assert len(glob.glob(f"{table.path}/v=000000000001/_bucket=*")) == 1
    assert rows(table.read()) == [(i, 1 + (i == 7), f"{'y' if i == 7 else 'x'}{i}") for i in range(200)]
    _, manifest = table.manifests.newest()
    assert sorted(manifest["folders"].values()) == [0] * 7 + [1]


def test_repeated_and_older_changes(table, change):
    for first, last, v in ((0, 50, 1), (20, 60, 3), (20, 60, 3), (0, 60, 2)):
        table.upsert(change(first, last, v, f"d{v}-"))
    assert rows(table.read()) == [(i, 2 if i < 20 else 3, f"d{2 if i < 20 else 3}-{i}") for i in range(60)]


def test_a_crash_before_the_manifest_leaves_the_old_version(table, change, monkeypatch):
    table.upsert(change(0, 20, 1))
    before = rows(table.read())

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(Manifests, "commit", crash)
        with pytest.raises(RuntimeError):
            table.upsert(change(0, 20, 2, "y"))
    assert os.path.exists(f"{table.path}/v=000000000001") and rows(table.read()) == before
    table.upsert(change(3, 4, 2, "z"))
    assert rows(table.read()) == [(i, 1 + (i == 3), f"{'z' if i == 3 else 'x'}{i}") for i in range(20)]


def test_a_manifest_is_written_once(spark, tmp_path):
    write_json(spark, f"{tmp_path}/m.json", {"a": 1})
    with pytest.raises(FileExistsError):
        write_json(spark, f"{tmp_path}/m.json", {"a": 2})
    assert [f for f in os.listdir(tmp_path) if not f.startswith(".")] == ["m.json"]


def test_buckets_are_doubled_as_the_table_grows(spark, tmp_path, change):
    table = T.SnapshotTable(spark, f"{tmp_path}/dim", ["id"], ["v"], bucket_bytes=4_000)
    for part in range(4):
        table.upsert(change(part * 1_000, part * 1_000 + 1_000, 1))
    _, manifest = table.manifests.newest()
    assert manifest["buckets"] >= 4 and len(manifest["folders"]) == manifest["buckets"]
    assert rows(table.read()) == [(i, 1, f"x{i}") for i in range(4_000)]
    table.expire(1)
    assert rows(table.lookup(spark.createDataFrame([(5,), (3_999,), (9_999,)], "id int"))) == [(5, 1, "x5"), (3999, 1, "x3999")]


def test_an_empty_batch(spark, table, change):
    table.upsert(change(0, 0, 1))
    assert rows(table.read()) == [] and table.newest_version() == 0
    table.upsert(change(1, 2, 1))
    table.upsert(change(0, 0, 1))
    assert rows(table.read()) == [(1, 1, "x1")] and table.newest_version() == 1


def test_lookup_reads_few_buckets(spark, tmp_path, change):
    table = T.SnapshotTable(spark, f"{tmp_path}/dim", ["id"], ["v"], buckets=256)
    table.upsert(change(0, 100_000, 1))
    found = table.lookup(spark.range(10).selectExpr("cast(id * 997 as int) as id", "'more' as more"))
    assert len(found.inputFiles()) <= 11  # the keys' own plan reads no files
    assert rows(found) == [(i * 997, 1, f"x{i * 997}") for i in range(10)]
    assert table.lookup(spark.range(0).selectExpr("cast(id as int) as id")).count() == 0


def test_versions_stay_for_their_reasons(spark, tmp_path, change):
    table = T.SnapshotTable(spark, f"{tmp_path}/dim", ["id"], ["v"], keep=1, buckets=4)
    table.upsert(change(0, 40, 1))
    with table.reading() as held:
        for v in range(2, 5):
            table.upsert(change(0, 1, v))
        assert table.manifests.numbers() == [0, 3]
        assert rows(held) == [(i, 1, f"x{i}") for i in range(40)]
        assert rows(table.read())[0] == (0, 4, "x0")
    table.upsert(change(0, 1, 9))
    assert table.manifests.numbers() == [4]
    assert rows(table.read()) == [(i, 9 if i == 0 else 1, f"x{i}") for i in range(40)]
    kept = T.SnapshotTable(spark, table.path, ["id"], ["v"], keep=1, buckets=4, hold_seconds=60)
    kept.upsert(change(0, 1, 10))
    kept.upsert(change(0, 1, 11))
    assert table.manifests.numbers() == [4, 5, 6]
    table.expire(1)
    assert table.manifests.numbers() == [6] and len(glob.glob(f"{table.path}/v=*/_bucket=*")) == 4


def test_leases_end(spark, tmp_path):
    leases = Leases(spark, f"{tmp_path}/leases")
    assert list(leases.held()) == []
    name = leases.take(3, 60)
    leases.take(1, 0.01)
    time.sleep(0.1)
    assert list(leases.held()) == [3]
    leases.give_back(name)
    assert list(leases.held()) == []


@pytest.fixture
def index(spark, tmp_path):
    return T.IndexTable(spark, f"{tmp_path}/index", ["id"], ["v"], fanout=3, buckets=4)


def test_levels_are_few(index, change):
    most = 0
    for n in range(20):
        index.write(change(n, n + 5, n), f"q-{n:012d}")
        index.fold()
        most = max(most, len(index.folders()))
    assert most <= 2 * 3  # 3 levels of 2 at the most
    _, manifest = index.manifests.newest()
    assert [len(level) for level in manifest["levels"]] == [0, 2]
    assert rows(index.read()) == [(i, min(i, 19), f"x{i}") for i in range(24)]
    index.compact()
    assert len(index.folders()) == 1 and rows(index.read()) == [(i, min(i, 19), f"x{i}") for i in range(24)]


def test_a_reader_keeps_its_rows_across_folds(spark, index, change):
    for n in range(2):
        index.write(change(0, 10, n), f"q-{n}")
    with index.reading() as held:
        for n in range(2, 8):
            index.write(change(0, 10, n), f"q-{n}")
            index.fold()
        index.compact()
        assert rows(held) == [(i, 1, f"x{i}") for i in range(10)]
        assert rows(index.read()) == [(i, 7, f"x{i}") for i in range(10)]
    index.sweep()
    assert len(glob.glob(f"{index.path}/batches/batch=*")) == 0 and len(glob.glob(f"{index.path}/runs/*")) == 1
    assert rows(index.read()) == [(i, 7, f"x{i}") for i in range(10)]


def test_folded_folders_stay_for_a_while(spark, tmp_path, change):
    index = T.IndexTable(spark, f"{tmp_path}/index", ["id"], ["v"], fanout=2, hold_seconds=60)
    for n in range(2):
        index.write(change(0, 10, n), f"q-{n}")
    before = index.read()
    index.fold()
    assert rows(before) == rows(index.read()) == [(i, 1, f"x{i}") for i in range(10)]
    assert len(glob.glob(f"{index.path}/batches/batch=*")) == 2 and len(index.folders()) == 1


def test_a_failed_fold_leaves_the_rows(index, change, monkeypatch):
    for n in range(3):
        index.write(change(0, 10, n), f"q-{n}")

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(Manifests, "commit", crash)
        with pytest.raises(RuntimeError):
            index.fold()
    assert rows(index.read()) == [(i, 2, f"x{i}") for i in range(10)]
    index.fold()
    assert len(glob.glob(f"{index.path}/runs/*")) == 1 and rows(index.read()) == [(i, 2, f"x{i}") for i in range(10)]


def test_lookup_in_batches_and_runs(spark, index, change):
    for n in range(4):
        index.write(change(n, 100, n), f"q-{n}")
        index.fold()
    keys = spark.createDataFrame([(0,), (50,), (700,)], "id int")
    assert rows(index.lookup(keys)) == [(0, 0, "x0"), (50, 3, "x50")]
    other = T.IndexTable(spark, index.path, ["id"], ["v"], fanout=3, buckets=7)  # a run has the buckets that it was written with
    for n in (8, 9):
        other.write(change(50, 51, n), f"q-{n}")
    other.fold()
    assert sorted(run.rsplit("-", 1)[1] for run in other.folders()) == ["4", "7"]
    assert rows(other.lookup(keys)) == rows(index.lookup(keys)) == [(0, 0, "x0"), (50, 9, "x50")]


def test_a_fold_needs_two(spark, index):
    with pytest.raises(ValueError):
        T.IndexTable(spark, index.path, ["id"], ["v"], fanout=1)


def test_folding_goes_by_the_number_of_the_batch(index, change):
    fold = S.folding(index)
    for n in range(3):
        index.write(change(0, 5, n), f"query-{n:012d}")
        fold(None, f"query-{n:012d}")
    assert [f.split("/")[0] for f in index.folders()] == ["runs"]


def test_one_scan_of_the_changes(spark, table, change):
    """The batch is evaluated once, whatever the upsert takes from it."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    table.upsert(change(0, 100, 1))
    changes = change(50, 150, 2)
    table.upsert(changes.mapInArrow(count, changes.schema))
    assert seen.value == 100 and table.read().count() == 150
    assert table.read().agg(F.sum("v")).first()[0] == 50 + 200


@pytest.mark.parametrize("buckets", [1, 3])
def test_many_rows_are_many_buckets(spark, tmp_path, buckets):
    """No bucket holds much more than its rows, from the first upsert and the first run on; replaced rows add none."""
    rows = spark.range(1000).selectExpr("id", "0 as version", "'x' as name")
    dim = T.SnapshotTable(spark, f"{tmp_path}/dim", ["id"], ["version"], buckets=buckets, bucket_rows=100)
    dim.upsert(rows)
    sizes = [r["count"] for r in dim.read().groupBy(T.bucket_of(["id"], dim.manifests.newest()[1]["buckets"])).count().collect()]
    assert len(sizes) >= 10 and max(sizes) < 200
    before = dim.manifests.newest()[1]["buckets"]
    dim.upsert(rows.selectExpr("id", "1 as version", "'y' as name"))
    assert dim.manifests.newest()[1]["buckets"] == before
    dim.upsert(spark.range(1000, 3000).selectExpr("id", "2 as version", "'z' as name"))
    assert dim.manifests.newest()[1]["buckets"] > before and dim.read().count() == 3000
    assert dim.read().groupBy("name").count().collect() and dim.lookup(spark.range(2990, 3010)).count() == 10
    index = T.IndexTable(spark, f"{tmp_path}/index", ["id"], ["version"], buckets=buckets, bucket_rows=100)
    index.write(rows, "a")
    index.compact()
    (run,) = index.folders()
    written = spark.read.parquet(f"{tmp_path}/index/{run}").groupBy("_bucket").count().collect()
    assert len(written) >= 10 and max(r["count"] for r in written) < 200
    index.write(rows.selectExpr("id", "1 as version", "'y' as name"), "b")
    assert index.read().filter("name = 'y'").count() == 1000 and index.lookup(spark.range(5)).count() == 5
