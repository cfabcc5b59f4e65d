"""Large lookup tables cut down to what a batch names: rows, plans, hot and missing keys, buckets, streams."""

import json
import os
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from test_enrichment import FIELDS, PARAMS, SEAS, USERS, documents, model
from tidegate.functions import payload as P
from tidegate.operators import lookup as K
from tidegate.plans import clue_enrichment as E
from tidegate.plans.clue_enrichment import ClueDimensions, LookupPlan, enrich_clues
from tidegate.sinks.tables import IndexTable, SnapshotTable
from tidegate.streaming import pipelines as S
from tidegate.workspace import scratch


@contextmanager
def limits(spark, **settings):
    for name, value in settings.items():
        spark.conf.set(getattr(K, name), str(value))
    try:
        yield
    finally:
        for name in settings:
            spark.conf.unset(getattr(K, name))


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def hot_rows(spark, n=20_000):
    """Two thirds of the rows have key 7, some have none or one that no user has."""
    key = F.when(F.col("id") % 3 != 0, 7).when(F.col("id") % 30 == 0, None).when(F.col("id") % 33 == 0, -1)
    return spark.range(n).select(F.col("id").alias("row"), key.otherwise(F.col("id")).cast("int").alias("k"))


def many_users(spark, n=10_000_000):
    return spark.range(n).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("u"), "id").alias("name"))


def pairs(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.mark.parametrize("rows_limit", [100, 1_000_000, 2**40])
def test_ten_million_users_and_one_hot_id(spark, tmp_path, rows_limit):
    """Ids that do not fit, ids that fit, and a table that fits: the same rows."""
    left, users = hot_rows(spark), many_users(spark)
    want = pairs(left.join(F.broadcast(users.filter("k < 20000")), ["k"], "left"))
    with limits(spark, BROADCAST_LIMIT_CONF=rows_limit, HOT_ROWS_CONF=1000):
        part = K.narrowed(users, left.select("k"), ["k"], str(tmp_path / "part"))
        assert part.fits == (rows_limit > 100)
        assert pairs(part.join(left, ["k"], "left", ["row"])) == want
        if part.fits:
            assert part.rows.count() == left.select("k").distinct().filter("k >= 0").count()


def test_the_large_table_is_not_exchanged(spark, tmp_path):
    many_users(spark, 100_000).write.parquet(str(tmp_path / "users"))
    users = spark.read.parquet(str(tmp_path / "users"))
    keys = spark.range(50).select(F.col("id").cast("int").alias("k"))
    keys.write.parquet(str(tmp_path / "keys"))
    plan = plan_of(K.rows_of(users, spark.read.parquet(str(tmp_path / "keys")), ["k"]))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_no_wanted_key_and_no_row(spark, tmp_path):
    users, left = many_users(spark, 10), hot_rows(spark).filter("k is null")
    part = K.narrowed(users, left.select("k"), ["k"], str(tmp_path / "a"))
    assert part.rows.count() == 0 and {r["name"] for r in part.join(left, ["k"], "left", ["row"]).collect()} == {None}
    empty = K.narrowed(users.limit(0), left.limit(0).select("k"), ["k"], str(tmp_path / "b"))
    assert empty.fits and empty.join(left.limit(0), ["k"], "inner", ["row"]).count() == 0


def test_hot_keys_alone_repeat_their_rows(spark):
    """With over 1000 rows per place, key 7 is the only one that is spread; rows without key are spread too."""
    left, users = hot_rows(spark), many_users(spark, 20_000)
    counts = K.key_counts(left, ["k"]).filter("_n > 1000 and k is not null")
    assert [r["k"] for r in counts.collect()] == [7]
    with limits(spark, BROADCAST_LIMIT_CONF=1, HOT_ROWS_CONF=1000):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            got = K.lookup_join(left, users, ["k"], ["row"])
            assert "SortMergeJoin" in plan_of(got)
            rows = pairs(got)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == pairs(left.join(users, ["k"], "left"))


def test_a_join_that_keeps_right_rows_is_refused(spark):
    with pytest.raises(ValueError):
        K.split_hot_keys_join(hot_rows(spark), hot_rows(spark), ["k"], "full", ["row"], 10)


def dimensions(spark, find_users=None):
    return ClueDimensions.from_tables(
        spark.createDataFrame(PARAMS, "id int, tenant_id int, field_id int, param_id string, display string"),
        spark.createDataFrame(FIELDS, "id int, tenant_id int, field_id int, field_key string"),
        spark.createDataFrame(SEAS, "id string, public_seas_name string"),
        spark.createDataFrame(USERS, "id int, real_name string"),
        find_users,
    )


def payloads(spark, docs):
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "n int, doc string").select("n", P.parse_object(F.col("doc")).alias("payload"))


@pytest.mark.parametrize("limit", [1, 100, 2**30])
@pytest.mark.parametrize("params", ["maps", "shuffle"])
def test_narrowed_enrichment_equals_the_model(spark, tmp_path, limit, params):
    docs = documents(300, seed=11)
    with limits(spark, BROADCAST_LIMIT_CONF=limit, HOT_ROWS_CONF=20):
        plan = LookupPlan(params, False, False)
        got = enrich_clues(payloads(spark, docs), dimensions(spark), ["n"], plan=plan, place=str(tmp_path / "p"))
        rows = got.select("n", F.to_json("enriched").alias("doc")).collect()
    assert len(rows) == len(docs)
    assert all(json.loads(row["doc"]) == model(docs[row["n"]]) for row in rows)


def test_narrowed_enrichment_moves_no_payload(spark, tmp_path):
    frame = payloads(spark, documents(50, seed=3))
    got = enrich_clues(frame, dimensions(spark), ["n"], plan=LookupPlan("maps", False, False), place=str(tmp_path / "p"))
    by_rows = enrich_clues(frame, dimensions(spark), ["n"], plan=LookupPlan("maps", False, False))
    assert "hashpartitioning(n#" not in plan_of(got)
    assert "hashpartitioning(n#" in plan_of(by_rows)


def test_users_are_found_in_their_buckets(spark, tmp_path, monkeypatch):
    table = SnapshotTable(spark, str(tmp_path / "users"), ["id"], ["offset"], buckets=64)
    rows = spark.range(5000).select(F.col("id").cast("int").alias("id"), F.concat(F.lit("u"), "id").alias("realName"), F.lit(1).alias("offset"))
    table.upsert(rows)
    opened = []
    real = SnapshotTable._opened

    def watched(self, manifest, buckets=None):
        opened.append(buckets)
        return real(self, manifest, buckets)

    monkeypatch.setattr(SnapshotTable, "_opened", watched)
    dims = dimensions(spark, lambda ids: table.lookup(ids).select("id", F.col("realName").alias("name")))
    docs = [{"creatorId": 40}, {"creatorId": 40, "lastCharger": 4999}, {"belongToId": 5000}]
    plan = LookupPlan("maps", True, False)
    got = enrich_clues(payloads(spark, docs), dims, ["n"], plan=plan, place=str(tmp_path / "p"))
    found = {r["n"]: json.loads(r["doc"]) for r in got.select("n", F.to_json("enriched").alias("doc")).collect()}
    assert [found[1]["creatorIdName"], found[1]["lastChargerName"]] == ["u40", "u4999"] and "belongToIdName" not in found[2]
    assert len(opened) == 1 and 1 <= len(opened[0]) <= 3  # of 64


def test_the_sink_narrows_and_leaves_nothing_behind(spark, tmp_path, monkeypatch):
    places = []
    real = E.narrowed
    monkeypatch.setattr(E, "narrowed", lambda *args: places.append(args[3]) or real(*args))
    records = spark.createDataFrame(
        [("c", 0, i, json.dumps({"id": str(i), "creatorId": 1, "publicSeaId": "1"})) for i in range(4)],
        "topic string, partition int, offset bigint, value string",
    ).withColumn("timestamp", F.timestamp_seconds(F.lit(0)))
    index = IndexTable(spark, str(tmp_path / "index"), ["id"], list(S.POSITION))
    with limits(spark, BROADCAST_LIMIT_CONF=60):
        S.enrichment_sink(lambda: dimensions(spark), index, str(tmp_path / "rejects"))(records, "q-0")
    docs = [json.loads(r["doc"]) for r in index.read().collect()]
    assert len(docs) == 4 and {(d["creatorIdName"], d["publicSeasName"]) for d in docs} == {("Ann", "North")}
    assert places and not any(os.path.exists(place) for place in places)


def test_scratch_goes_after_a_failure(spark):
    with pytest.raises(ZeroDivisionError):
        with scratch(spark, "x") as place:
            spark.range(1).write.parquet(f"{place}/a")
            1 / 0
    assert not os.path.exists(place)
