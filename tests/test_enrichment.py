"""Enrichment against a plain model of the per-document rules, under every shape of plan."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidegate.functions import payload as P
from tidegate.operators import dimensions as M
from tidegate.plans.clue_enrichment import ClueDimensions, LookupPlan, enrich_clues

FIELDS = [
    (1, 1, 10, "level"),
    (2, 1, 11, "source"),
    (3, 2, 10, "source"),
    (4, None, 10, "level"),
    (5, 1, 11, "origin"),  # a second row of (1, 11): the highest id stays
    (6, 2, 12, "creatorId"),  # its name clashes with that of the creator
]
PARAMS = [
    (1, 1, 10, "a", "High"),
    (2, 1, 10, "b", " "),
    (3, 1, 11, "x", "Web"),
    (4, 2, 10, "x", "Fair"),
    (5, None, 10, "a", "Nobody"),
    (6, 3, 10, "a", "lost"),  # no field of tenant 3
    (7, 1, 10, "a", "Highest"),  # replaces the first row
    (8, 2, 12, "1", "clash"),
    (9, 1, 10, "7", "Seven"),
]
SEAS = [("1", "North"), ("2", "\t"), ("3", None)]
USERS = [(1, "Ann"), (2, None), (3, "Bo")]


def model(doc):
    fields = {}
    for _, tenant, field, key in sorted(FIELDS):
        fields[(tenant, field)] = key
    params = {}
    for _, tenant, field, param, display in sorted(PARAMS):
        key = fields.get((tenant, field))
        if key is not None:
            params[(tenant, key, param)] = display
    seas, users = dict(SEAS), dict(USERS)
    out = dict(doc)
    for key, value in doc.items():
        if value is None or not str(value).strip():
            continue
        display = params.get((doc.get("tenantId"), key, str(value)))
        if display and display.strip():
            out[key + "Name"] = display
    sea = seas.get(doc.get("publicSeaId"))
    if sea and sea.strip():
        out["publicSeasName"] = sea
    for role in ("creatorId", "lastCharger", "belongToId"):
        if doc.get(role) in users:
            out[role + "Name"] = users[doc[role]]
    return out


def documents(n, seed):
    rng = random.Random(seed)
    docs = []
    for _ in range(n):
        doc = {}
        for key, values in {
            "tenantId": [1, 1, 1, 2, 3, None],
            "level": ["a", "b", "zz", "", "  ", None, 7],
            "source": ["x", "y", None],
            "origin": ["x", "q"],
            "publicSeaId": ["1", "2", "3", "9", "", None],
            "creatorId": [1, 1, 1, 2, 3, 4, None],
            "lastCharger": [1, 2, None],
            "belongToId": [3, 8],
            "levelName": ["old"],
            "creatorIdName": ["old"],
            "nested": [{"a": [1, None]}],
        }.items():
            if rng.random() < 0.7:
                doc[key] = rng.choice(values)
        docs.append(doc)
    return docs


@pytest.fixture(scope="module")
def dims(spark):
    return ClueDimensions.from_tables(
        spark.createDataFrame(PARAMS, "id int, tenant_id int, field_id int, param_id string, display string"),
        spark.createDataFrame(FIELDS, "id int, tenant_id int, field_id int, field_key string"),
        spark.createDataFrame(SEAS, "id string, public_seas_name string"),
        spark.createDataFrame(USERS, "id int, real_name string"),
    )


PLANS = [
    LookupPlan("maps", True, True),
    LookupPlan("broadcast", True, True),
    LookupPlan("shuffle", True, True),
    LookupPlan("maps", False, True),
    LookupPlan("maps", True, False),
    LookupPlan("shuffle", False, False),
]


@pytest.mark.parametrize("plan", PLANS, ids=str)
def test_every_plan_equals_the_model(spark, dims, plan):
    docs = documents(300, seed=7)
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)]
    frame = spark.createDataFrame(rows, "n int, doc string").select(
        "n", P.parse_object(F.col("doc")).alias("payload")
    )
    got = enrich_clues(frame, dims, ["n"], plan=plan).select("n", F.to_json("enriched").alias("doc")).collect()
    assert len(got) == len(docs)
    for row in got:
        assert json.loads(row["doc"]) == model(docs[row["n"]])


def test_small_dimensions_are_measured_as_such(dims):
    assert LookupPlan.measured(dims) == LookupPlan("maps", True, True)


def test_dimensions_over_the_limit_are_shuffled(spark, dims):
    spark.conf.set("spark.tidegate.broadcast.maxBytes", "10")
    try:
        assert LookupPlan.measured(dims) == LookupPlan("shuffle", False, False)
    finally:
        spark.conf.unset("spark.tidegate.broadcast.maxBytes")


def test_documents_are_not_shuffled_when_dimensions_are_small(spark, dims, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame([(1, '{"tenantId":1}')], "n int, doc string").write.parquet(path)
    docs = spark.read.parquet(path).select("n", P.parse_object(F.col("doc")).alias("payload"))
    plan = enrich_clues(docs, dims, ["n"], plan=PLANS[0])._jdf.queryExecution().optimizedPlan().toString()
    spine = enrich_clues(docs, dims, ["n"], plan=PLANS[0])
    text = spine._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text.split("BroadcastExchange")[0]
    assert plan.count("from_json") == 1  # one parse, however many lookups use it


def test_bad_ids_are_rejected_not_lost(spark, dims):
    rows = [(1, '{"tenantId":"x"}'), (2, '{"creatorId":"y"}'), (3, '{"tenantId":1,"level":"a"}'), (4, "{bad")]
    frame = spark.createDataFrame(rows, "n int, doc string").select(
        "n", P.parse_object(F.col("doc")).alias("payload")
    )
    got = {r["n"]: (r["reject_reason"], r["enriched"]) for r in enrich_clues(frame, dims, ["n"]).collect()}
    assert got[1] == ("bad_int:tenantId", None)
    assert got[2] == ("bad_int:creatorId", None)
    assert got[3][0] is None and got[3][1] is not None
    assert got[4][1] is None


def test_labels_and_typed_users(spark):
    rows = [
        ('{"id":1,"realName":"A","status":1,"gender":2,"changePass":0,"password":"-"}',),
        ('{"id":2,"status":5,"gender":null}',),
        ("{bad",),
    ]
    users = M.with_user_labels(M.typed_users(spark.createDataFrame(rows, "value string")))
    assert "password" not in users.columns
    got = {r["id"]: (r["statusName"], r["genderName"], r["changePassName"]) for r in users.collect()}
    assert got == {1: ("冻结", "女", "未改过密码"), 2: (None, None, None), None: (None, None, None)}
