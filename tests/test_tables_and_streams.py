"""Sinks and streams: several batches, restarts, replays, updates of a running query."""

import json

import pytest
from pyspark.sql import functions as F

from tidegate.operators.routing import REJECT_TOPIC
from tidegate.plans.clue_enrichment import ClueDimensions
from tidegate.sinks.publish import index_options, kafka_sink_options, publish_to_files
from tidegate.sinks.tables import IndexTable, SnapshotTable, committed_folders
from tidegate.sources.change_stream import file_stream, kafka_options
from tidegate.sources.relational import as_json_objects, jdbc_options
from tidegate.streaming import pipelines as S


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def records(spark, values, topic="t", start=0):
    data = [(None, v, topic, 0, start + i, start + i) for i, v in enumerate(values)]
    frame = spark.createDataFrame(data, "key string, value string, topic string, partition int, offset bigint, s bigint")
    return frame.select("key", "value", "topic", "partition", "offset", F.timestamp_seconds("s").alias("timestamp"))


def append(frame, path):
    frame.coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


# ---- tables ---------------------------------------------------------------------------------


def test_snapshots(spark, folder):
    table = SnapshotTable(spark, f"{folder}/dim", ["id"], ["v"])
    with pytest.raises(ValueError):
        table.read()

    def change(*data):
        return spark.createDataFrame(data, "id int, v int, doc string, deleted boolean")

    table.upsert(change((1, 1, "a", False), (2, 1, "b", False)))
    table.upsert(change((1, 2, "c", False), (2, 2, None, True)))
    assert rows(table.read()) == [(1, 2, "c")]
    table.upsert(change((2, 1, "b", False), (1, 1, "a", False)))  # a replay
    assert rows(table.read()) == [(1, 2, "c")]
    table.upsert(change((2, 3, "back", False)))
    assert rows(table.read()) == [(1, 2, "c"), (2, 3, "back")]
    table.expire(keep=2)
    assert committed_folders(spark, f"{folder}/dim") == ["v=000000000002", "v=000000000003"]
    assert rows(table.read()) == [(1, 2, "c"), (2, 3, "back")]


def test_old_versions_expire(spark, folder):
    table = SnapshotTable(spark, f"{folder}/dim", ["id"], ["v"], keep=2)
    for v in range(4):
        table.upsert(spark.createDataFrame([(1, v)], "id int, v int"))
    assert committed_folders(spark, f"{folder}/dim") == ["v=000000000002", "v=000000000003"]
    assert rows(table.read()) == [(1, 3)]


def test_an_uncommitted_version_is_not_read(spark, folder):
    table = SnapshotTable(spark, f"{folder}/dim", ["id"], ["v"])
    table.upsert(spark.createDataFrame([(1, 1)], "id int, v int"))
    broken = spark.createDataFrame([(1, 9)], "id int, v int")
    broken.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{folder}/dim/v=000000000001"
    )
    assert rows(table.read()) == [(1, 1)]
    table.upsert(spark.createDataFrame([(1, 2)], "id int, v int"))
    assert rows(table.read()) == [(1, 2)]


def test_index_batches_replay_and_compaction(spark, folder):
    index = IndexTable(spark, f"{folder}/index", ["id"], ["v"])
    with pytest.raises(ValueError):
        index.read()

    def docs(*data):
        return spark.createDataFrame(data, "id string, v int, doc string")

    index.write(docs(("a", 1, "a1"), ("b", 1, "b1")), "q-0")
    index.write(docs(("a", 2, "a2")), "q-1")
    index.write(docs(("a", 2, "a2")), "q-1")
    want = [("a", 2, "a2"), ("b", 1, "b1")]
    assert rows(index.read()) == want
    index.compact()
    assert rows(index.read()) == want
    index.write(docs(("a", 2, "a2")), "q-1")  # replayed after it was folded in
    index.write(docs(("b", 3, "b3")), "q-2")
    assert rows(index.read()) == [("a", 2, "a2"), ("b", 3, "b3")]
    index.compact()
    index.compact()
    assert rows(index.read()) == [("a", 2, "a2"), ("b", 3, "b3")]


def test_publish_replaces_a_replayed_batch(spark, folder):
    messages = spark.createDataFrame([("t", "1"), ("u", "2")], "topic string, value string")
    for key in ("q-0", "q-1", "q-1"):
        publish_to_files(messages, folder, key)
    assert spark.read.parquet(folder).count() == 4


# ---- streams --------------------------------------------------------------------------------


def test_stream_goes_on_where_it_stopped(spark, folder):
    source, table = f"{folder}/source", SnapshotTable(spark, f"{folder}/dim", ["id"], list(S.POSITION))

    def run():
        stream = file_stream(spark, source, max_files_per_trigger=1)
        S.start(stream, S.dimension_sink(table, f"{folder}/rejects"), f"{folder}/checkpoint").awaitTermination()

    append(records(spark, ['{"id":1,"n":"a"}', '{"id":2,"n":"b"}', "{bad", '{"id":"x"}', None]), source)
    append(records(spark, ['{"id":1,"n":"c"}'], start=10), source)
    run()
    assert len(committed_folders(spark, f"{folder}/dim")) == 2  # one version per batch
    append(records(spark, ['{"id":2,"n":"d"}', '{"id":3,"n":"e"}'], start=20), source)
    run()
    got = {r["id"]: json.loads(r["doc"])["n"] for r in table.read().collect()}
    assert got == {1: "c", 2: "d", 3: "e"}
    assert len(committed_folders(spark, f"{folder}/dim")) == 3
    reasons = [r["reject_reason"] for r in spark.read.parquet(f"{folder}/rejects").collect()]
    assert sorted(reasons) == ["bad_id", "malformed", "null_record"]


def test_deletes_apply_only_when_asked(spark, folder):
    changes = records(spark, ['{"id":1}', '{"id":2}', '{"id":1}']).withColumn(
        "op", F.when(F.col("offset") == 2, "delete").otherwise("insert")
    )
    for op, ids in ((None, [1, 2]), ("op", [2])):
        table = SnapshotTable(spark, f"{folder}/dim-{op}", ["id"], list(S.POSITION))
        S.dimension_sink(table, f"{folder}/rejects-{op}", op)(changes, "q-0")
        assert sorted(r["id"] for r in table.read().collect()) == ids


def test_stream_result_equals_batch_result_and_replay(spark, folder):
    source = f"{folder}/source"
    values = [f'{{"table":"saas_clue.{i % 3}","type":"insert","data":{{"id":{i}}}}}' for i in range(9)] + ["{bad"]
    for i in range(5):
        append(records(spark, values[2 * i : 2 * i + 2], start=2 * i), source)
    for run, files in (("one", 1), ("all", None)):
        stream = file_stream(spark, source, max_files_per_trigger=files)
        S.start(stream, S.router_sink(f"{folder}/{run}"), f"{folder}/c-{run}").awaitTermination()
    one, both = (spark.read.parquet(f"{folder}/{run}").select("topic", "key", "value", "offset") for run in ("one", "all"))
    assert rows(one) == rows(both) and one.count() == 10
    assert one.filter(F.col("topic") == REJECT_TOPIC).count() == 1


def test_a_running_query_sees_new_dimension_rows(spark, folder):
    source = f"{folder}/source"
    users = SnapshotTable(spark, f"{folder}/users", ["id"], ["v"])
    empty_params = spark.createDataFrame([], "id int, tenant_id int, field_id int, param_id string, display string")
    empty_fields = spark.createDataFrame([], "id int, tenant_id int, field_id int, field_key string")
    seas = spark.createDataFrame([("1", "North")], "id string, public_seas_name string")

    def open_dimensions():
        return ClueDimensions.from_tables(empty_params, empty_fields, seas, users.read())

    def name(text, v):
        users.upsert(spark.createDataFrame([(5, text, v)], "id int, real_name string, v int"))

    index = IndexTable(spark, f"{folder}/index", ["id"], list(S.POSITION))
    sink = S.enrichment_sink(open_dimensions, index, f"{folder}/rejects")
    calls = []

    def sink_and_rename(batch, key):
        sink(batch, key)
        calls.append(key)
        name("second", 2)

    append(records(spark, ['{"id":"a","creatorId":5}']), source)
    append(records(spark, ['{"id":"b","creatorId":5,"publicSeaId":"1"}'], start=5), source)
    name("first", 1)
    stream = file_stream(spark, source, max_files_per_trigger=1)
    S.start(stream, sink_and_rename, f"{folder}/checkpoint").awaitTermination()
    got = {r["id"]: json.loads(r["doc"]) for r in index.read().collect()}
    assert len(set(calls)) == 2
    assert got["a"]["creatorIdName"] == "first"
    assert got["b"] == {"id": "b", "creatorId": 5, "publicSeaId": "1", "publicSeasName": "North", "creatorIdName": "second"}


def test_enrichment_keeps_what_it_cannot_index(spark, folder):
    index = IndexTable(spark, f"{folder}/index", ["id"], list(S.POSITION))
    dims = ClueDimensions.from_tables(
        spark.createDataFrame([], "id int, tenant_id int, field_id int, param_id string, display string"),
        spark.createDataFrame([], "id int, tenant_id int, field_id int, field_key string"),
        spark.createDataFrame([("1", "North")], "id string, public_seas_name string"),
        spark.createDataFrame([(1, "Ann")], "id int, real_name string"),
    )
    sink = S.enrichment_sink(lambda: dims, index, f"{folder}/rejects")
    values = ['{"id":"a"}', '{"n":1}', '{"n":2}', '{"id":"b","creatorId":"x"}', "{bad", None]
    sink(records(spark, values), "q-0")
    assert [r["id"] for r in index.read().collect()] == ["a"]
    reasons = [r["reject_reason"] for r in spark.read.parquet(f"{folder}/rejects").collect()]
    assert sorted(reasons) == ["bad_id", "bad_id", "bad_int:creatorId", "malformed", "null_record"]


def test_user_dimension(spark, folder):
    table = SnapshotTable(spark, f"{folder}/users", ["id"], list(S.POSITION))
    sink = S.user_dimension_sink(table, f"{folder}/rejects")
    sink(records(spark, ['{"id":1,"status":1,"password":"-"}', '{"id":1,"status":0}', '{"status":1}']), "q-0")
    row = table.read().collect()
    assert [(r["id"], r["statusName"]) for r in row] == [(1, "非冻结")] and "password" not in row[0]
    assert spark.read.parquet(f"{folder}/rejects").count() == 1


def test_users_are_parsed_like_other_payloads(spark, folder):
    table = SnapshotTable(spark, f"{folder}/users", ["id"], list(S.POSITION))
    values = ['{"id":"1","status":"1"}', '{"id":2,"status":1.0}', '{"id":4} x', '{"id":5,"id":6}', "{bad", None, '{"n":1}']
    S.user_dimension_sink(table, f"{folder}/rejects")(records(spark, values), "q-0")
    assert {r["id"]: r["statusName"] for r in table.read().collect()} == {1: "冻结", 2: "冻结"}
    reasons = sorted(r["reject_reason"] for r in spark.read.parquet(f"{folder}/rejects").collect())
    assert reasons == ["bad_id", "malformed", "malformed", "malformed", "null_record"]


def test_the_offset_wins_over_an_earlier_timestamp_and_the_source_over_both(spark, folder):
    table = SnapshotTable(spark, f"{folder}/dim", ["id"], list(S.POSITION))
    sink = S.dimension_sink(table, f"{folder}/rejects")
    late = records(spark, ['{"id":1,"n":"old"}', '{"id":1,"n":"new"}'])
    sink(late.withColumn("timestamp", F.timestamp_seconds(100 - F.col("offset"))), "q-0")
    assert [json.loads(r["doc"])["n"] for r in table.read().collect()] == ["new"]
    by_source = records(spark, ['{"id":1,"n":"later"}', '{"id":1,"n":"earlier"}'], start=2).withColumns(
        {"source_ts": F.lit(7).cast("bigint"), "xid": F.lit(1).cast("bigint"), "xoffset": 9 - F.col("offset")}
    )
    sink(by_source, "q-1")
    assert [json.loads(r["doc"])["n"] for r in table.read().collect()] == ["later"]


def test_router_writes_to_any_publisher_and_carries_the_source_position(spark):
    from tidegate.sinks.publish import header_long, position_headers

    seen, counts = [], {}

    def write(messages, key):
        headed = messages.withColumn("headers", position_headers())
        back = [header_long(F.col("headers"), c).alias(f"h_{c}") for c in ("source_ts", "xid", "xoffset")]
        seen.extend((key, r["topic"], r["h_source_ts"], r["h_xid"], r["h_xoffset"]) for r in headed.select("topic", *back).collect())

    value = '{"table":"sys_user2","type":"insert","ts":5,"xid":6,"data":{"id":1}}'
    S.router_sink(write, on_counts=counts.__setitem__)(records(spark, [value, "{bad"]), "q-0")
    assert sorted(seen, key=str) == [("q-0", "ods_sys_user2", 5, 6, None), ("q-0", "rejected", None, None, None)]
    assert counts == {"q-0": {"ok": 1, "failed": 1}}


def test_oplog_entries_without_document_or_key_are_kept(spark, folder):
    from tidegate.functions import payload as P
    from tidegate.operators import oplog as O

    raw = [
        (1, "crm.saas_clue.7", "i", '{"_id":"a","id":1}', None),
        (2, "crm.saas_clue.7", "i", "{bad", None),
        (3, "crm.saas_clue.7", "i", '{"_id":"b"}', None),
        (4, "crm.saas_clue.7", "u", '{"$set":{}}', "{bad"),
        (5, "crm.saas_clue.7", "d", "{}", None),
    ]
    log = spark.createDataFrame(raw, "ts bigint, ns string, op string, o string, o2 string").withColumn("shard", F.lit("s"))
    log = log.withColumns({c: P.parse_object(F.col(c)) for c in ("o", "o2")})
    current = spark.createDataFrame([], "ns string, doc_id string, doc string").withColumn("doc", P.parse_object(F.col("doc")))
    followed = O.namespaces(spark.createDataFrame([("saas_clue.7",)], "name string"))
    cursors, counts, sent = SnapshotTable(spark, f"{folder}/cursors", ["shard"], ["cursor_ts"]), {}, []
    write = lambda messages, _: sent.extend(r["ts"] for r in messages.collect())
    sink = S.oplog_sink(lambda: current, followed, write, cursors, ["ns", "doc_id"], f"{folder}/rejects", counts.__setitem__)
    sink(log, "q-0")
    assert sent == [1] and counts == {"q-0": {"ok": 1, "failed": 4}}
    kept = {r["ts"]: r["reject_reason"] for r in spark.read.parquet(f"{folder}/rejects").collect()}
    assert kept == {2: "no_document", 3: "no_document", 4: "no_key", 5: "no_key"}
    assert rows(cursors.read()) == [("s", 5)]


def test_a_topic_starts_behind_its_saved_positions(spark, folder):
    from tidegate.streaming import apps as A

    assert A.topic_start(spark, folder, "t") == "latest"
    site = A.Site(spark, lambda topic: file_stream(spark, f"{folder}/source"), folder, seconds=None)
    append(records(spark, ["1", "2"]), f"{folder}/source")
    seen = []
    site.start_topic("q", "t", lambda batch, _: seen.append(batch.count())).awaitTermination()
    partitions = spark.createDataFrame([("t", 0), ("t", 1)], "topic string, partition_id int")
    assert seen == [2] and A.topic_start(spark, folder, "t", partitions) == '{"t":{"0":2,"1":-2}}'


def test_enrichment_fills_a_given_writer(spark, folder):
    from tidegate.streaming import apps as A

    site = A.Site(spark, lambda topic: file_stream(spark, f"{folder}/source"), folder, seconds=None)
    append(records(spark, ['{"id":"a"}', "{bad"]), f"{folder}/source")
    seen = []
    A.start_clues(site, lambda docs, _: seen.extend((r["id"], r["doc"]) for r in docs.collect())).awaitTermination()
    assert seen == [("a", '{"id":"a"}')]


def test_outcomes_of_a_batch_are_reported(spark, folder):
    reported, written = {}, []
    sink = S.split_sink(
        S.dimension_changes, lambda rows, key: written.append(rows.count()), f"{folder}/rejects", reported.__setitem__
    )
    sink(records(spark, ['{"id":1}', '{"id":2}', "{bad", None]), "q-0")
    sink(records(spark, []), "q-1")
    assert reported == {"q-0": {"ok": 2, "failed": 2}, "q-1": {"ok": 0, "failed": 0}} and written == [2, 0]


def test_fixed_interval(spark, folder):
    source = f"{folder}/source"
    append(records(spark, ["1"]), source)
    sink = lambda batch, key: publish_to_files(batch, f"{folder}/out", key)
    query = S.start(file_stream(spark, source), sink, f"{folder}/checkpoint", seconds=1)
    try:
        query.processAllAvailable()
        append(records(spark, ["2"], start=1), source)
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(spark.read.parquet(f"{folder}/out").select("value", "offset")) == [("1", 0), ("2", 1)]


def test_router_takes_the_rules_by_operation(spark, folder):
    from tidegate.operators.routing import route_by_rules

    values = [f'{{"table":"order_info","type":"{op}","data":{{"id":1}}}}' for op in ("insert", "update")]
    S.router_sink(folder, route_by_rules)(records(spark, values), "q-0")
    assert rows(spark.read.parquet(folder).select("topic", "offset")) == [("ods_order_info", 0)]


def test_failed_sink_is_repeated_by_the_next_start(spark, folder):
    source, out = f"{folder}/source", f"{folder}/out"
    append(records(spark, ["1", "2"]), source)
    attempts = []

    def sink(batch, key):
        attempts.append(key)
        publish_to_files(batch, out, key)
        if len(attempts) == 1:
            raise RuntimeError("executor lost")

    for _ in range(2):
        query = S.start(file_stream(spark, source), sink, f"{folder}/checkpoint")
        try:
            query.awaitTermination()
        except Exception:
            pass
    assert len(attempts) == 2 and len(set(attempts)) == 1
    assert spark.read.parquet(out).count() == 2


def test_positions_mirror(spark, folder):
    ledger = S.positions_table(spark, f"{folder}/ledger")
    save = S.positions_sink(ledger, "g")
    save(records(spark, ["1", "2"]), "q-0")
    save(records(spark, ["3"], start=2), "q-1")
    save(records(spark, ["1", "2"]), "q-0")
    assert rows(ledger.read()) == [("t", "g", 0, 3)]


def test_a_few_pieces_are_spread_and_many_are_left(spark):
    from tidegate.sources.spread import spread_few_pieces

    cores = spark.sparkContext.defaultParallelism
    few, many = spark.range(100, numPartitions=1), spark.range(100, numPartitions=cores)
    assert spread_few_pieces(few, "id").rdd.getNumPartitions() == cores
    assert spread_few_pieces(many, "id") is many


def test_workspace_lies_below_the_shared_folder(spark):
    from tidegate.workspace import workspace

    one, two = workspace(spark, "x"), workspace(spark, "x")
    assert one != two and one.startswith(spark.conf.get("spark.checkpoint.dir"))


# ---- options --------------------------------------------------------------------------------


def test_kafka_options():
    options = kafka_options("host:1", "changes", max_offsets_per_trigger=5)
    assert options["startingOffsets"] == "latest" and options["kafka.group.id"] == "changes_group3"
    assert options["maxOffsetsPerTrigger"] == "5"
    assert kafka_options("host:1", "changes", "g", "earliest")["kafka.group.id"] == "g"
    assert kafka_sink_options("host:1")["kafka.enable.idempotence"] == "true"
    assert index_options("host:2")["es.batch.size.entries"] == "1000"


def test_jdbc_options():
    assert jdbc_options("jdbc:x", query="select 1")["query"] == "select 1"
    split = jdbc_options("jdbc:x", query="select 1", split=("id", 0, 100, 8))
    assert split["dbtable"] == "(select 1) q" and split["numPartitions"] == "8" and "query" not in split
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x")


def test_rows_as_objects_keep_nulls(spark):
    frame = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    assert as_json_objects(frame).first()["object"] == '{"a":1,"b":null,"c":"x"}'
