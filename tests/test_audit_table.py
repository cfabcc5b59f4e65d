"""Outcome counts that are kept per batch and reason."""

import json

from pyspark.sql import functions as F

from tidegate.operators import envelopes as E, routing as R
from tidegate.sinks.audit import AuditTable, observed_audit, write_audit
from tidegate.sinks.tables import SnapshotTable
from tidegate.streaming import pipelines as S


def records(spark, values, start=0):
    data = [(None, v, "t", 0, start + i) for i, v in enumerate(values)]
    frame = spark.createDataFrame(data, "key string, value string, topic string, partition int, offset bigint")
    return frame.withColumn("timestamp", F.timestamp_seconds("offset"))


def envelope(table):
    return json.dumps({"database": "crm", "table": table, "type": "insert", "data": {"id": 1}})


BATCHES = [
    [envelope("sys_user2"), "{bad", None, envelope("saas_clue.x"), envelope("saas_clue.7")],
    [envelope("sys_user2"), "null", "{bad", '{"data":{"a":1,"a":2},"table":"sys_user2"}', '{"data":{"id":1}}'],
]


def totals(frame):
    return sorted(map(tuple, frame.select("outcome", "reason", "docs").collect()))


def test_router_keeps_reasons_and_replays_change_nothing(spark, tmp_path):
    audit = AuditTable(spark, f"{tmp_path}/audit")
    sink = S.router_sink(f"{tmp_path}/topics", on_counts=lambda *_: None, audit=audit)
    for n in (0, 1, 1, 0):
        sink(records(spark, BATCHES[n], 10 * n), f"q-{n}")
    routed = R.publishable_with_rejects(R.route_by_table(E.parse_envelopes(records(spark, BATCHES[0] + BATCHES[1]).select("value"))))
    assert totals(audit.totals()) == totals(write_audit(routed))
    assert audit.read().select("batch").distinct().count() == 2


def test_dimension_keeps_reasons(spark, tmp_path):
    audit = AuditTable(spark, f"{tmp_path}/audit")
    table = SnapshotTable(spark, f"{tmp_path}/dim", ["id"], list(S.POSITION))
    sink = S.dimension_sink(table, f"{tmp_path}/rejects", audit=audit)
    batch = records(spark, ['{"id":1}', '{"id":"x"}', "{bad", None, '{"id":2}'])
    for _ in range(2):
        sink(batch, "q-0")
    assert totals(audit.totals()) == [("failed", "bad_id", 1), ("failed", "malformed", 1), ("failed", "null_record", 1), ("ok", "", 2)]
    assert totals(audit.totals()) == totals(write_audit(S.dimension_changes(batch)))


def test_reasons_that_were_not_asked_for():
    assert observed_audit({"ok": 0, "failed": 5, "reason_0": 2}, ["a"]) == [("failed", "a", 2), ("failed", "other", 3)]
