"""The queries of this package that SQL can express, against it, on whole tables."""

import pytest

from steward.llm.bindings import ORACLES, QUERIES
from tests.check_oracles import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, sf, name):
    problem, rows = compare(spark, connect(sf), name, QUERIES[name], ORACLES[name], sf)
    assert problem is None, problem
    assert rows > 0


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
