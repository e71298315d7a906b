"""Every query against its SQL twin on the smallest tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from pitchflow.bindings import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SMALL, name, QUERIES[name], ORACLES[name]) is None
