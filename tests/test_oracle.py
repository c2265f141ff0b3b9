"""Every registered query against its DuckDB twin (the driver's check).

Runs at $ORACLE_SF_DIR (default sf0.001 for speed; the driver uses sf0.01).
"""

import os

import pytest

import __spark_entry__ as E
from oracle_compare import duck, rows_of

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(set(cols)) == len(cols)
        return
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    assert rows_of(cols, rows) == rows_of(dcols, cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["filename", "corpus", "total_redactions"]
