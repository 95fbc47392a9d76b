"""Every named query against its oracle SQL on the smallest tables."""

import os

import oracle
import pytest

from tidemark.plans import catalog

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connection(SF)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    assert oracle.difference(spark, con, catalog.QUERIES[name], catalog.ORACLES[name], SF) == ""


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
