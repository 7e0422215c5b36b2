"""Every registered query against its DuckDB oracle (or rows-only when no SQL exists), on sf0.001."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_harness import compare, duck

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0


def test_every_query_has_unique_aliases():
    assert set(SQL) <= set(QUERIES)


#: what every row must satisfy, for queries without SQL
CONTRACTS = {
    "model_persistence": lambda r: r["rows"] > 0 and r["max_abs_diff"] == 0,
    "additivity_check": lambda r: r["additive"],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    if name in SQL:
        ok, msg = compare(df, con.execute(SQL[name]).df())
        assert ok, msg
    elif name in CONTRACTS:
        rows = df.collect()
        assert rows and all(CONTRACTS[name](r) for r in rows)
    else:
        assert df.count() > 0
