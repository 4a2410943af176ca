"""Every registered query against its DuckDB oracle (strict, bit for bit), at sf0.001."""

import pytest

import __spark_entry__ as entry
from fundlens.plans.queries import ORACLE_SQL, QUERIES
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert res["match"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 36 and df.count() > 0
