"""Every registered query against its SQL oracle on the sf0.001 tables, and
the driver entry point."""
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from oracle_check import digest, duck  # noqa: E402

ORACLES = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_registered_with_callable():
    assert len(QUERIES) >= 40
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(rows, df.columns)[0] == digest(drows, dcols)[0]


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "fraud_rate" in df.columns
