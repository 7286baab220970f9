"""Every registered query with SQL equals that SQL on DuckDB."""

import pytest
from oracle_check import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from tidemark.plans.registry import ORACLES, PLANS


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_an_oracle():
    assert set(PLANS) == set(ORACLES)
    assert set(PLANS) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["seller_id", "channel", "gmv_total", "ticket_medio", "eventos"]
    assert df.count() > 0


@pytest.mark.parametrize("name", list(ORACLES))
def test_oracle(spark, small, con, name):
    assert compare(queries()[name](spark, small), con, oracle_sql()[name]) is None
