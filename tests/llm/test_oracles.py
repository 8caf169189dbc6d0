"""Registered training-data queries against their DuckDB SQL on sf0.01, and the plans of those without Python."""

import re

import pytest

from tests.conftest import plan_of
from tests.parity import compare, duck
from tidewell.llm.common import documents
from tidewell.llm.oracles import LLM_ORACLES
from tidewell.llm.queries import LLM_QUERIES
from tidewell.llm.sharding import shard_documents

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_equals_oracle(spark, connection, name):
    assert compare(LLM_QUERIES[name](spark, FOLDER), connection, LLM_ORACLES[name]) is None


@pytest.mark.parametrize("limit", [1 << 18, 1 << 17])
def test_sharding_equals_its_sql_where_buckets_split(spark, connection, limit):
    """The registered limit holds all of these documents in one shard, so the SQL also walks directories of smaller ones.

    Above the largest document: one that exceeds the limit takes salted bits, which the SQL has not; see test_shaping.
    """
    found = shard_documents(documents(spark, FOLDER), limit=limit)
    assert found.select("shard").distinct().count() > 4
    assert compare(found, connection, LLM_ORACLES["op9_sharding"].replace(str(32 << 20), str(limit))) is None


@pytest.mark.parametrize("name", ["op7_quality", "op9_sharding", "op13_decontamination"])
def test_native_queries_run_no_python_and_pair_nothing(spark, name):
    plan = plan_of(LLM_QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert not re.search("Python|InArrow|InPandas|NestedLoopJoin|CartesianProduct", plan)
