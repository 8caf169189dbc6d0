"""Every registered query against its DuckDB oracle on sf0.01."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.parity import compare, duck
from tidewell.registry import REGISTRY, sample_lake

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(set(REGISTRY) & set(oracle_sql())))
def test_equals_oracle(spark, connection, name):
    assert compare(queries()[name](spark, FOLDER), connection, oracle_sql()[name]) is None


def test_every_query_of_the_lake_has_an_oracle():
    assert set(REGISTRY) <= set(oracle_sql())


def test_sample_rows_come_from_the_table(spark):
    sample = queries()["bronze_sample"](spark, FOLDER)
    customers = sample_lake(spark, FOLDER)["bronze_customer"]
    assert sample.count() == 10
    assert sample.join(customers, "c_customer_sk", "left_anti").count() == 0


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
