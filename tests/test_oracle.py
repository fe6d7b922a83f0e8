"""Every registered query against its DuckDB oracle (the driver's gate), at sf0.001."""

import pytest

import __spark_entry__ as entry
from ledgerlens.plans import catalog
from tests.conftest import SF_SMALL
from tests.oracle_check import duck, rows_of

NAMES = sorted(catalog.QUERIES)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.queries())
    missing = set(NAMES) - set(entry.oracle_sql())
    assert not missing, f"queries without oracle SQL: {sorted(missing)}"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "accountid" in df.columns


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
