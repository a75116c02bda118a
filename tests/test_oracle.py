"""Every registered query against its DuckDB oracle, on the smallest scale factor.

The driver runs the same comparison at sf0.01; running it at sf0.001 here
checks a second scale and keeps the suite quick.
"""

import pytest

from conftest import SF_SMALL
from lakeops.plans.registry import all_queries
from tools.oracle_check import compare, duck_connect

REG = all_queries()


@pytest.fixture(scope="module")
def duck_small():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", sorted(REG))
def test_query_matches_oracle(spark, duck_small, name):
    r = REG[name]
    out = compare(spark, duck_small, name, r.fn, r.sql, SF_SMALL)
    assert out["status"] in ("ok", "rows-only"), out


def test_entry_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
