"""Every registered query against its DuckDB oracle (or a rows-only run when
it has none), on the smallest fixture so the whole suite stays quick.  The
driver's own check runs the same pairs at sf0.01."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlake.plans.registry import load_all  # noqa: E402
from oracle_harness import compare, duck

from conftest import SF001

REG = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(REG))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF001, con)
    assert r["status"] in ("ok", "rows-only"), r


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    rows = df.collect()
    assert df.columns == ["credit_grade", "customers", "pct"]
    assert len(rows) > 0
    q, s = e.queries(), e.oracle_sql()
    assert set(s) <= set(q)
