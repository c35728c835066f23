"""Every registered query against its DuckDB oracle on the smallest fixture."""

import os
import sys

import duckdb
import pytest

from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from oracle_check import TABLES, rows_of  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _names():
    from pitchlake.plans import catalog
    return sorted(catalog.registry())


def test_every_query_has_an_oracle():
    import __spark_entry__ as E
    from pitchlake.plans import oracle
    assert set(_names()) == set(oracle.oracle_sql())
    assert set(_names()) <= set(E.queries()) and set(oracle.oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    o_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(s_rows) == len(o_rows)
    assert rows_of(df.columns, s_rows) == rows_of(rel.columns, o_rows)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "strike_rate" in df.columns
