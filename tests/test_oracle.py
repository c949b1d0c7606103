"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
from custodia import plans
from tests.oracle_compare import compare, connect

SF = "/root/testdata/sf0.001"
NAMES = plans.all_queries().keys()
QUERIES, ORACLES = ({k: v for k, v in x.items() if k in NAMES} for x in (entry.queries(), entry.oracle_sql()))
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    diff, _ = compare(QUERIES[name](spark, SF), duck, ORACLES[name])
    assert not diff


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["request_id", "redacted", "pii_token_count"]
