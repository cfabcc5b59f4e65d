"""Dimensions that are derived once per version: jobs, new versions, restarts, rows."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidegate.functions import payload as P
from tidegate.plans.clue_enrichment import ClueDimensions, LookupPlan, enrich_clues
from tidegate.plans.derived_dimensions import DerivedDimensions
from tidegate.streaming import apps as A


class Tables:
    """Four dimension tables whose versions the test sets."""

    def __init__(self, spark):
        self.spark, self.versions, self.sea, self.opened = spark, {"params": 0, "fields": 0, "seas": 0, "users": 0}, "North", 0

    def open(self):
        self.opened += 1
        params = self.spark.createDataFrame([(1, 1, 10, "a", "High"), (2, 1, 10, "b", " ")], "id int, tenant_id int, field_id int, param_id string, display string")
        fields = self.spark.createDataFrame([(1, 1, 10, "level")], "id int, tenant_id int, field_id int, field_key string")
        seas = self.spark.createDataFrame([("1", self.sea)], "id string, public_seas_name string")
        users = self.spark.createDataFrame([(7, "Ann")], "id int, real_name string")
        return ClueDimensions.from_tables(params, fields, seas, users)


def names(spark, dims):
    doc = json.dumps({"id": "c", "tenantId": 1, "level": "a", "publicSeaId": "1", "creatorId": 7})
    docs = spark.createDataFrame([(0, doc)], "k int, doc string").select("k", P.parse_object(F.col("doc")).alias("payload"))
    found = json.loads(enrich_clues(docs, dims, ["k"]).select(P.to_text(F.col("enriched")).alias("e")).first()["e"])
    return found["levelName"], found["publicSeasName"], found["creatorIdName"]


@pytest.fixture
def measured(monkeypatch):
    calls = []
    real = LookupPlan.measured.__func__
    monkeypatch.setattr(LookupPlan, "measured", classmethod(lambda cls, dims: calls.append(1) or real(cls, dims)))
    return calls


def jobs(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        run()
    finally:
        spark.sparkContext.setJobGroup("other", "other")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_unchanged_versions_start_no_job(spark, tmp_path, measured):
    tables = Tables(spark)
    derived = DerivedDimensions(spark, str(tmp_path), lambda: tables.versions, tables.open)
    assert jobs(spark, "first", derived.current) > 0 and len(measured) == 1
    assert names(spark, derived.current()) == ("High", "North", "Ann")
    assert jobs(spark, "second", derived.current) == 0
    assert (len(measured), tables.opened) == (1, 1)


def test_a_new_process_finds_what_is_stored(spark, tmp_path, measured):
    tables = Tables(spark)
    DerivedDimensions(spark, str(tmp_path), lambda: tables.versions, tables.open).current()
    again = DerivedDimensions(spark, str(tmp_path), lambda: tables.versions, tables.open)
    assert jobs(spark, "restart", again.current) == 0 and len(measured) == 1
    assert names(spark, again.current()) == ("High", "North", "Ann")


def test_a_new_version_derives_its_part_anew(spark, tmp_path, measured):
    tables = Tables(spark)
    derived = DerivedDimensions(spark, str(tmp_path), lambda: tables.versions, tables.open)
    for version in range(1, 6):
        tables.versions, tables.sea = {**tables.versions, "seas": version}, f"Sea {version}"
        assert names(spark, derived.current()) == ("High", f"Sea {version}", "Ann")
    assert len(measured) == 5
    assert len(os.listdir(f"{tmp_path}/params")) == len(os.listdir(f"{tmp_path}/decoder")) == 1
    assert len(os.listdir(f"{tmp_path}/seas")) == 3


def test_the_application_derives_once(spark, tmp_path, measured):
    site = A.Site(spark, lambda topic: None, str(tmp_path), seconds=None)
    derived = A.derived_clue_dimensions(site)
    assert derived.current().params.count() == 0  # before any dimension
    position = "0L as source_ts, 0L as xid, 0L as xoffset, 1L as offset, 0 as partition, timestamp_seconds(0) as timestamp, false as deleted"
    rows = {
        A.FIELD_TABLE: '{"id":1,"tenant_id":1,"field_id":10,"field_key":"level"}',
        A.PARAM_TABLE: '{"id":1,"tenant_id":1,"field_id":10,"param_id":"a","display":"High"}',
        A.CLUE_SEA_TABLE: '{"id":1,"public_seas_name":"North"}',
    }
    for name, doc in rows.items():
        site.table(name).upsert(spark.sql(f"select 1 as id, '{doc}' as doc, {position}"))
    site.table(A.USER_TABLE).upsert(spark.sql(f"select 7 as id, 'Ann' as realName, {position}"))
    assert names(spark, derived.current()) == ("High", "North", "Ann")
    assert jobs(spark, "site", derived.current) == 0 and len(measured) == 2
