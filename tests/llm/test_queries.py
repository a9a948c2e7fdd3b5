"""The registered queries beside their SQL, and their results' shape."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from ludoscope.llm import catalog


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, con, sf, name):
    problem, rows = compare(spark, con, catalog.QUERIES[name], catalog.ORACLES.get(name), sf)
    assert problem is None, problem
    assert rows > 0


def test_all_are_registered():
    assert set(catalog.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 14))
