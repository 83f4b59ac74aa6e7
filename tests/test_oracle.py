"""Every registered query against its DuckDB oracle on the smallest test tables."""

import pytest

from conftest import SF_SMALL
from oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def _names():
    from __spark_entry__ import oracle_sql, queries

    q, o = queries(), oracle_sql()
    return [n for n in q if n in o]


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries

    r = compare(name, queries()[name](spark, SF_SMALL), con, oracle_sql()[name])
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r
    assert not r["type_diffs"], r


def test_every_query_has_an_oracle():
    from __spark_entry__ import oracle_sql
    from demandlens.plans.queries import QUERIES

    assert set(QUERIES) <= set(oracle_sql())


def test_entry_runs(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() >= 0 and "total_channel_views" in df.columns
