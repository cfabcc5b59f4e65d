"""Messages that are published again are known by their id, and a reader takes each once."""

import json

from pyspark.sql import functions as F

from tidegate.operators import oplog as O
from tidegate.sinks.publish import MESSAGE_ID, header_text, message_headers, message_id
from tidegate.sinks.tables import SnapshotTable
from tidegate.sources.change_stream import once
from tidegate.streaming import pipelines as S

LOG = "topic string, key string, value string, partition int, offset bigint, message_id string"


def recording(path):
    """A log without any knowledge of batches, as a broker is: each call appends."""

    def publish(messages, _):
        row = [F.col(c) for c in ("topic", "value", MESSAGE_ID)]
        key = F.col("key") if "key" in messages.columns else F.lit(None).cast("string")
        place = [F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset")]
        messages.select(*row, key.alias("key"), *place).write.mode("append").parquet(path)

    return publish


def envelopes(spark, first, n):
    rows = [
        ("changes", p, o, json.dumps({"table": "sys_user2", "type": "update", "data": {"id": o % 3, "v": "same"}, "ts": 5, "xid": 5}))
        for p in (0, 1)
        for o in range(first, first + n)
    ]
    rows += [("changes", 0, first + n, None), ("changes", 0, first + n + 1, "{")]
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string").withColumn(
        "timestamp", F.timestamp_seconds(F.lit(0))
    )


def read_once(spark, path, folder):
    stream = once(spark.readStream.schema(LOG).parquet(path))
    out = f"{folder}/out"
    sink = lambda batch, key: batch.write.mode("overwrite").parquet(f"{out}/batch={key}")
    S.start(stream, sink, f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(out)


def test_a_repeated_batch_is_read_once(spark, tmp_path):
    log, reader = str(tmp_path / "log"), str(tmp_path / "reader")
    sink = S.router_sink(recording(log))
    sink(envelopes(spark, 0, 10), "a-0")
    sink(envelopes(spark, 0, 10), "a-0")  # the crash came before the commit
    assert spark.read.parquet(log).count() == 44
    got = read_once(spark, log, reader)
    assert got.count() == got.select(MESSAGE_ID).distinct().count() == 22  # equal values of different records stay
    sink(envelopes(spark, 0, 10), "b-0")  # a new query without checkpoint reads it all again
    sink(envelopes(spark, 20, 10), "b-1")
    got = read_once(spark, log, reader)  # the reader was restarted too
    assert got.count() == got.select(MESSAGE_ID).distinct().count() == 44
    assert got.filter("topic = 'rejected'").count() == 4


def test_a_repeated_log_batch_has_the_same_ids(spark, tmp_path):
    entries = spark.sql(
        """select * from values (1L, 'crm.a', 'i', 'x', 's1'), (1L, 'crm.a', 'i', 'y', 's1'), (2L, 'crm.a', 'u', 'x', 's1'), (2L, 'crm.a', 'd', 'y', 's2')
        as t(ts, ns, op, k, shard)"""
    ).selectExpr(
        "ts", "ns", "op", "shard",
        "map('_id', to_variant_object(named_struct('x', k)), 'v', cast(1 as variant)) as o",
        "map('_id', to_variant_object(named_struct('x', k))) as o2",
    )
    followed = spark.createDataFrame([("crm.a",)], "ns string")
    keyed = O.with_document_key(entries.filter("op = 'i'"), F.col("o")).select("ns", "doc_id", F.col("o").alias("doc"))
    log = str(tmp_path / "log")
    cursors = SnapshotTable(spark, str(tmp_path / "cursors"), ["shard"], ["cursor_ts"])
    sink = S.oplog_sink(lambda: keyed, followed, recording(log), cursors, ("ns", "doc_id"))
    for _ in range(2):
        sink(entries, "a-0")
    ids = spark.read.parquet(log).groupBy(MESSAGE_ID).count().collect()
    assert ids and {row["count"] for row in ids} == {2}


def test_a_batch_keeps_the_first_and_all_without_id(spark):
    rows = [("t", 0, 1, "a", "m"), ("t", 0, 2, "b", "m"), ("t", 1, 0, "c", None), ("t", 1, 1, "c", None), ("t", 1, 2, "d", '["t","1","1"]')]
    records = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string, message_id string")
    got = once(records)
    assert got.columns == records.columns
    assert sorted(r["value"] for r in got.collect()) == ["a", "c", "c", "d"]
    assert once(records.limit(0)).count() == 0


def test_ids_do_not_run_together(spark):
    rows = spark.createDataFrame([("a/b", "c"), ("a", "b/c"), ('a","b', "c"), (None, "a"), ("", "a")], "x string, y string")
    assert rows.select(message_id("o", F.col("x"), F.col("y")).alias("m")).distinct().count() == 5


def test_the_id_goes_through_the_headers(spark):
    rows = spark.createDataFrame([("v", "id-1", 1, 2, 3)], "value string, message_id string, source_ts bigint, xid bigint, xoffset bigint")
    headed = rows.withColumn("headers", message_headers(rows.columns))
    assert headed.select(header_text(F.col("headers"), MESSAGE_ID).alias("m")).first()["m"] == "id-1"
    assert len(headed.first()["headers"]) == 4 and message_headers(["value"]) is None
