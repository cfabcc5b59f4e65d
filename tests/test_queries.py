"""Every named query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as contract
from oracle import difference
from tidegate.registry import ORACLES, QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_contract_holds_every_query():
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    assert difference(spark, sf_dir, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["id", "doc"]
    assert frame.limit(1).count() == 1


LOOKUPS = (
    "clue_enriched", "fn_lookup_default", "fn_null_safe_key", "join_dynamic_decode", "join_public_sea", "join_user_creator",
    "oplog_delete_image", "oplog_ns_semi", "oplog_to_envelopes", "oplog_update_image", "sink_dim_upsert", "src_current_docs",
)


@pytest.mark.parametrize("name", LOOKUPS)
def test_query_without_any_broadcast(spark, sf_dir, name):
    """The forms for large tables give what the broadcast forms give."""
    limits = {"spark.tidegate.broadcast.maxBytes": "1", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        assert difference(spark, sf_dir, QUERIES[name], ORACLES[name]) is None
    finally:
        for key in limits:
            spark.conf.unset(key)
