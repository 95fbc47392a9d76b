"""The queries that have SQL, against it on the smallest given tables."""

import oracle
import pytest

from tidemark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    con = oracle.connection(SF)
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF).select(*names)
    assert oracle.rows(names, [tuple(r) for r in got.collect()]) == oracle.rows(names, want.fetchall())
