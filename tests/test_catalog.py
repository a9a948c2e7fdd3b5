"""Every registered query beside its SQL twin."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry

from ludoscope.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf, name):
    problem, _ = compare(spark, con, QUERIES[name], ORACLES.get(name), sf)
    assert problem is None, problem


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES) and set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
