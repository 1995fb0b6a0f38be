"""Every registered query against its SQL oracle on whole tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from bindings import ORACLES, QUERIES
from tests.check_oracles import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, con, sf, name):
    problem, rows = compare(spark, con, name, QUERIES[name], ORACLES.get(name), sf)
    assert problem is None, problem
    assert rows > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries()) and set(QUERIES) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["n_name", "total_vol"]
    assert df.count() == 5
