"""The domain views are one SQL text for both engines: check they really agree."""

import pytest

from ledgerlens.plans import fixtures
from tests.conftest import SF_SMALL
from tests.oracle_check import duck, rows_of

VIEWS = ["contracts", "accounts", "linkedaccountantlog", "activitydaily", "users", "calendar", "snapshot",
         "crm_accounts", "previous_accounts", "appbillingproposal", "opportunities", "monthlyappusage",
         "contracteventtypes", "itemclassifications"]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("view", VIEWS)
def test_view_identical_on_both_engines(spark, con, view):
    df = fixtures.Fixtures(spark, SF_SMALL)[view]
    cur = con.execute(fixtures.with_views([view], [], f"SELECT * FROM {view}"))
    d_cols = [c[0] for c in cur.description]
    assert df.columns == d_cols
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(d_cols, cur.fetchall())


def test_snapshot_column_list_is_current(spark):
    assert fixtures.Fixtures(spark, SF_SMALL)["snapshot"].columns == fixtures.SNAPSHOT_COLUMNS
