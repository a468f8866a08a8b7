"""Every registered query with an oracle equals its DuckDB SQL on sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"
import __spark_entry__ as E  # noqa: E402

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    from check_oracle import duck
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    from check_oracle import canon
    df = E.queries()[name](spark, SF)
    sc, sr = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLES[name])
    oc, orr = canon([d[0] for d in cur.description], cur.fetchall())
    assert sc == oc
    assert len(sr) == len(orr)
    assert sr == orr


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "health_risk_score" in df.columns


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(E.queries())
