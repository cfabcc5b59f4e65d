"""The training-data queries that SQL can express, against DuckDB."""

import pytest

from oracle import difference
from tidegate.llm.queries import LLM_ORACLES, LLM_QUERIES


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query(spark, sf_dir, name):
    assert difference(spark, sf_dir, LLM_QUERIES[name], LLM_ORACLES[name]) is None
