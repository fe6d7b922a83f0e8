"""More hand-made edge fixtures (FIXTURES.md section 3)."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.functions.columns import environment_uk
from ledgerlens.operators import accounts, loads, monthly, summary, timeline
from tests.test_edges import AS_OF, CONTRACT_SCHEMA, line

D = dt.date


def test_deleted_latest_manager_row_drops_manager(spark):
    cols = ("accountmanagercode string, accountmanagername string, businesslinecode string, "
            "businesslinedescription string, environment string, eventdate string, meta_load_enddts string, "
            "meta_isdeleted string")
    snap = spark.createDataFrame([
        ("5", "Manager 5", "1", "Line", "NL", "2024-01-01", None, "false"),
        ("5", "Manager 5", "1", "Line", "NL", "2024-02-01", None, "true"),     # latest row deleted
        ("6", "Manager 6", "2", "Line", "NL", "2024-01-01", None, "false"),
        ("5.0", "Manager 5", "1", "Line", "NL", "2023-12-01", None, "false"),  # same code, older
    ], cols)
    users = spark.createDataFrame([("u6", "a", "NL", "Manager 6", "6")],
                                  "userid string, accountid string, environment string, fullname string, hid string")
    out = {r["accountmanagercode"]: r for r in loads.load_account_managers(snap, users).collect()}
    assert set(out) == {6}
    assert out[6]["accountmanagerid"] == "u6"


def test_tied_item_types(spark):
    cols = "environment string, itemcode string, itemdescription string, itemtype string, " \
           "meta_load_enddts string, meta_isdeleted boolean"
    rows = [("NL", "X", "Item X", t, None, False) for t in ["B", "B", "A", "A", "C", "C", "C"]]
    snap = spark.createDataFrame(rows, cols)
    least = loads.load_item_classifications(snap).first()["itemtype"]
    most = loads.load_item_classifications(snap, pick="most").first()["itemtype"]
    assert least == "A" and most == "C"


def test_gb_and_uk_rows_stay_apart_and_dummy_code(spark):
    df = spark.createDataFrame([
        ("GB", "7", "a1", "2024-01-01 00:00:00"), ("UK", "7", "a2", "2024-01-02 00:00:00"),
        ("UK", "7", "a3", "2023-01-02 00:00:00"), ("NL", "162697700000000000", "x", "2024-01-01 00:00:00"),
        ("NL", None, "y", "2024-01-01 00:00:00"),
    ], "environment string, code string, account string, lastmodified string")
    df = accounts.exclude_codes(df.withColumn("lastmodified", F.col("lastmodified").cast("timestamp")))
    assert df.count() == 3                        # dummy and NULL code dropped
    latest = accounts.latest_per_key(df, ["environment", "code"], "lastmodified")
    rows = sorted((r["account"], r["e"]) for r in latest.select("account", environment_uk("environment").alias("e"))
                  .collect())
    assert rows == [("a1", "UK"), ("a2", "UK")]  # ranked before GB -> UK, so both survive


def _activity_inputs(spark, link_date):
    c = spark.createDataFrame([tuple(line(eventdate=D(2023, 3, 1), startdate=D(2023, 3, 1), itemcode="PKG",
                                          eventtype="CN", valuepermonth=25.0, numberofusers=3).values())],
                              CONTRACT_SCHEMA).withColumn("packagecode", F.lit("Std"))
    acc = spark.createDataFrame([("NL", "1", "acc1", "EntrepreneurWithAccountant")],
                                "environment string, accountcode string, accountid string, "
                                "entrepreneuraccountantlinked string")
    log = spark.createDataFrame([("NL", "1", "Accountant Linked", link_date)],
                                "environment string, accountcode string, linkstatus string, date date")
    s = summary.contract_summary(c, acc, log, AS_OF)
    return c, log, s, acc


def test_link_before_first_contract_event(spark):
    c, log, s, acc = _activity_inputs(spark, D(2023, 1, 15))
    rows = {r["eventtype"]: r for r in timeline.contract_activity(c, log, s, acc).collect()}
    link = rows["LINK"]
    assert link["date"] == D(2023, 1, 15)
    assert (link["mrr"], link["numberofusers"], link["numberofadministrations"]) == (0.0, 0, 0)
    assert link["packagecode"] is None            # no earlier package day to back-fill from
    assert rows["CN"]["accountantorlinked"] is True   # linked before the change


def test_link_on_an_event_date_takes_that_days_values(spark):
    c, log, s, acc = _activity_inputs(spark, D(2023, 3, 1))
    rows = {r["eventtype"]: r for r in timeline.contract_activity(c, log, s, acc).collect()}
    link, cn = rows["LINK"], rows["CN"]
    assert link["date"] == D(2023, 3, 1)
    assert (link["mrr"], link["numberofusers"], link["packagecode"]) == (cn["mrr"], cn["numberofusers"], "std")


def test_month_end_start_dates(spark):
    c = spark.createDataFrame([tuple(line(startdate=D(2023, 11, 30), eventdate=D(2023, 11, 30),
                                          finaldate=D(2023, 12, 31)).values())], CONTRACT_SCHEMA)
    months = sorted(r["yearmonth"] for r in monthly.month_assignments(c, AS_OF).collect())
    # overlaps Nov (starts on its last day), Dec, and Jan is outside the 6-month grid ending Dec 2023
    assert months == [202311, 202312]


def test_negative_mrr_truncates_toward_zero(spark):
    c = spark.createDataFrame([tuple(line(valuepermonth=-12.7).values())], CONTRACT_SCHEMA)
    acc = spark.createDataFrame([("NL", "1", "acc1", "x")], "environment string, accountcode string, "
                                "accountid string, entrepreneuraccountantlinked string")
    log = spark.createDataFrame([], "environment string, accountcode string, linkstatus string, date date")
    assert summary.contract_summary(c, acc, log, AS_OF).first()["latestmrr"] == -12


def test_padded_mixed_case_keys_are_cleaned(spark):
    c = spark.createDataFrame([tuple(line(environment=" nl ", accountcode=" 1", itemcode=" pkg ").values())],
                              CONTRACT_SCHEMA)
    acc = spark.createDataFrame([("NL", "1 ", "acc1", "x")], "environment string, accountcode string, "
                                "accountid string, entrepreneuraccountantlinked string")
    log = spark.createDataFrame([], "environment string, accountcode string, linkstatus string, date date")
    r = summary.contract_summary(c, acc, log, AS_OF).first()
    assert (r["environment"], r["accountcode"], r["firstcommpackage"]) == ("NL", "1", "PKG")
