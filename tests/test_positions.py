"""Positions that are saved while a batch is read, not by reading it again."""

import pytest
from pyspark.sql import functions as F

from tidegate.operators import ledger as L
from tidegate.sinks.tables import SnapshotTable
from tidegate.streaming import pipelines as S

SCHEMA = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"


def append(spark, folder, *places):
    data = [(None, '{"id":%d,"n":%d}' % (offset % 5, offset), "t", partition, offset) for partition, offset in places]
    frame = spark.createDataFrame(data, "key string, value string, topic string, partition int, offset bigint")
    frame.withColumn("timestamp", F.timestamp_seconds(F.col("offset"))).select("key", "value", "topic", "partition", "offset", "timestamp").coalesce(1).write.mode("append").parquet(folder)


def counted(records, seen):
    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return records.mapInArrow(count, records.schema)


@pytest.fixture
def stream(spark, tmp_path):
    """Runs a sink over what is there; gives the rows that were read, and the ledger."""
    ledger = S.positions_table(spark, f"{tmp_path}/positions")

    def run(sink, *places):
        append(spark, f"{tmp_path}/source", *places)
        seen = spark.sparkContext.accumulator(0)
        records = counted(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/source"), seen)
        S.start(records, S.with_positions(sink, ledger, "g"), f"{tmp_path}/checkpoint").awaitTermination()
        return seen.value, {r["partition_id"]: r["until_offset"] for r in ledger.read().collect()}

    return run


def sinks(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/dim", ["id"], list(S.POSITION))
    return {
        "router": S.router_sink(f"{tmp_path}/topics", on_counts=lambda *_: None),
        "dimension": S.dimension_sink(table, f"{tmp_path}/rejects"),
    }


@pytest.mark.parametrize("name", ["router", "dimension"])
def test_a_batch_is_read_once(spark, tmp_path, stream, name):
    sink = sinks(spark, tmp_path)[name]
    assert stream(sink, (0, 1), (0, 2), (1, 7))[1] == {0: 3, 1: 8}  # partitions not known yet
    assert stream(sink, (0, 3), (1, 8), (1, 9)) == (3, {0: 4, 1: 10})
    assert stream(sink, (1, 10)) == (1, {0: 4, 1: 11})
    read, positions = stream(sink, (0, 4), (2, 50))  # a new partition
    assert read == 4 and positions == {0: 5, 1: 11, 2: 51}
    assert stream(sink, (2, 51), (0, 5)) == (2, {0: 6, 1: 11, 2: 52})


def test_many_partitions_are_read_again(spark, tmp_path, stream, monkeypatch):
    sink = sinks(spark, tmp_path)["router"]
    monkeypatch.setattr(S, "OBSERVED_PARTITIONS", 1)
    stream(sink, (0, 1), (1, 1))
    assert stream(sink, (0, 2), (1, 2)) == (4, {0: 3, 1: 3})


def test_a_crash_before_the_ledger_repeats_the_batch(spark, tmp_path, stream, monkeypatch):
    table = SnapshotTable(spark, f"{tmp_path}/dim", ["id"], list(S.POSITION))
    sink = S.dimension_sink(table, f"{tmp_path}/rejects")
    stream(sink, (0, 1), (0, 2))
    upsert = SnapshotTable.upsert

    def crash(self, changes):
        if self.path.endswith("/positions"):
            raise RuntimeError("lost")
        upsert(self, changes)

    with monkeypatch.context() as patched:
        patched.setattr(SnapshotTable, "upsert", crash)
        with pytest.raises(Exception, match="lost"):
            stream(sink, (0, 3), (0, 6))
    assert stream(sink, (0, 9))[1] == {0: 10}
    after = dict(map(tuple, table.read().select("id", "doc").collect()))
    assert after == {1: '{"id":1,"n":6}', 2: '{"id":2,"n":2}', 3: '{"id":3,"n":3}', 4: '{"id":4,"n":9}'}


def test_observed_positions(spark):
    from pyspark.sql import Observation

    records = spark.createDataFrame([("t", 0, 4), ("t", 0, 9), ("t", 1, 2), ("u", 0, 7), (None, None, 1)], "topic string, partition int, offset bigint")
    seen = Observation()
    assert L.observed_positions(records, [("t", 0), ("t", 1), ("t", 5)], seen).count() == 5
    assert seen.get == {"end_0": 10, "end_1": 3, "end_2": None, "others": 2}
