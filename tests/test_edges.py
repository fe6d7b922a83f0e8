"""Hand-made edge cases (NULLs, ties, date edges, skew) and brute-force equivalences."""

import base64
import datetime as dt
import hashlib

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from ledgerlens.functions.columns import account_hash, lenient_integer, month_end
from ledgerlens.operators import history, links, monthly, normalize, summary, timeline
from ledgerlens.plans.fixtures import AS_OF, LINK_CUTOFF, Fixtures
from tests.conftest import SF_SMALL

D = dt.date
CONTRACT_SCHEMA = ("environment string, accountcode string, contractnumber string, contracttype string, "
                   "startdate date, finaldate date, eventdate date, inflowoutflow string, itemcode string, "
                   "linepackage int, quantity int, numberofadministrations int, numberofusers int, "
                   "valuepermonth double, cancellationdate date, eventtype string")


def line(**kw):
    base = dict(environment="NL", accountcode="1", contractnumber="100", contracttype="C",
                startdate=D(2023, 1, 1), finaldate=D(2024, 12, 31), eventdate=D(2023, 1, 1),
                inflowoutflow="Inflow", itemcode="PKG", linepackage=1, quantity=1, numberofadministrations=1,
                numberofusers=1, valuepermonth=10.0, cancellationdate=None, eventtype="CN")
    base.update(kw)
    return base


def contracts_df(spark, rows):
    return spark.createDataFrame([tuple(line(**r).values()) for r in rows], CONTRACT_SCHEMA)


def accounts_df(spark, keys=(("NL", "1"),)):
    return spark.createDataFrame(
        [(e, a, f"acc{a}", "EntrepreneurWithAccountant") for e, a in keys],
        "environment string, accountcode string, accountid string, entrepreneuraccountantlinked string")


def empty_log(spark):
    return spark.createDataFrame([], "environment string, accountcode string, linkstatus string, date date")


def test_net_zero_downgrade_code_vs_sql(spark):
    # same item and final date: +1 and -1 on different event dates
    rows = [line(itemcode="A", quantity=1, eventdate=D(2023, 1, 1)),
            line(itemcode="A", quantity=-1, eventdate=D(2023, 2, 1)),
            line(itemcode="B", quantity=0, eventdate=D(2023, 3, 1))]
    c = contracts_df(spark, rows)
    r = summary.account_spine(c, accounts_df(spark))
    code = summary.add_latest_commercial(c, r, AS_OF, "code").first()["latestcommpackage"]
    sql = summary.add_latest_commercial(c, r, AS_OF, "sql").first()["latestcommpackage"]
    assert code == "A"          # best event-date group: +1
    assert sql == "B"           # summed across dates A nets to 0; tie on 0 -> larger item


def test_fused_equals_stepwise(spark):
    fx = Fixtures(spark, SF_SMALL)
    for kw in ({}, {"grouping": "sql", "method": "boundaries", "pick": "first"}):
        a = summary.contract_summary(fx.contracts, fx.accounts, fx.log, AS_OF, LINK_CUTOFF, **kw)
        b = summary.contract_summary_stepwise(fx.contracts, fx.accounts, fx.log, AS_OF, LINK_CUTOFF, **kw)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_one_row_per_account(spark):
    fx = Fixtures(spark, SF_SMALL)
    s = summary.contract_summary(fx.contracts, fx.accounts, fx.log, AS_OF, LINK_CUTOFF)
    # an account published twice has a row for each id
    assert s.count() == s.select("environment", "accountcode", "accountid").distinct().count()
    assert s.select("environment", "accountcode").distinct().count() < s.count()


def test_hot_account_skew(spark):
    """One account holding a third of all lines: fused and step-wise still agree."""
    fx = Fixtures(spark, SF_SMALL)
    c = fx.contracts
    hot_key = c.groupBy("environment", "accountcode").count().orderBy(F.desc("count")).first()
    hot = c.where((F.col("environment") == hot_key[0]) & (F.col("accountcode") == hot_key[1]))
    n = c.count() // (2 * hot.count()) + 1
    skewed = c.unionByName(hot.crossJoin(spark.range(n).select(F.col("id").alias("_r"))).drop("_r"))
    assert skewed.where(F.col("accountcode") == hot_key[1]).count() * 3 >= skewed.count()
    a = summary.contract_summary(skewed, fx.accounts, fx.log, AS_OF, LINK_CUTOFF)
    b = summary.contract_summary_stepwise(skewed, fx.accounts, fx.log, AS_OF, LINK_CUTOFF)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_finaldate_equal_as_of(spark):
    c = contracts_df(spark, [line(finaldate=AS_OF, eventdate=D(2023, 6, 1), numberofusers=7)])
    s = summary.contract_summary(c, accounts_df(spark), empty_log(spark), AS_OF).first()
    assert s["churned"] == 1                       # not after as_of
    assert s["latestnumberofusers"] == 7           # still active on as_of


def test_null_eventdate_and_item(spark):
    c = contracts_df(spark, [line(eventdate=None), line(itemcode=None, eventdate=D(2023, 5, 1))])
    s = summary.contract_summary(c, accounts_df(spark), empty_log(spark), AS_OF).first()
    assert s["firstcommpackage"] is None           # NULL item is the earliest pick
    assert s["latestcommpackage"] is None and s["latestcommstartdate"] is None


def test_link_log_null_status_kept(spark):
    new = spark.createDataFrame([("NL", "1", False, "A1")],
                                "environment string, accountcode string, accountantorlinked boolean, accountantcode string")
    prev = spark.createDataFrame([("NL", "1", False, "A2"), ],
                                 "environment string, accountcode string, accountantorlinked boolean, accountantcode string")
    out = links.link_log(links.link_changes(new, prev), AS_OF).collect()
    assert len(out) == 1 and out[0]["linkstatus"] is None and out[0]["date"] == AS_OF - dt.timedelta(days=1)
    nulls = spark.createDataFrame([("NL", "1", None, "A1")],
                                  "environment string, accountcode string, accountantorlinked boolean, accountantcode string")
    assert links.link_changes(nulls, new.withColumn("accountantcode", F.lit("A1"))).count() == 0
    assert links.link_changes(nulls, new.withColumn("accountantcode", F.lit("A1")), null_safe=True).count() == 1


def test_lenient_casts(spark):
    df = spark.createDataFrame([("5.0",), ("x",), ("-3",), (None,)], "v string")
    assert [r[0] for r in df.select(lenient_integer("v")).collect()] == [5, None, -3, None]
    typed = normalize.cast_columns(spark.createDataFrame([("2024-02-29", "true", "9999-12-31")],
                                                         "d string, b string, c string"),
                                   dates=["d", "c"], booleans=["b"])
    row = normalize.null_sentinel_date(typed, "c").first()
    assert row["d"] == D(2024, 2, 29) and row["b"] is True and row["c"] is None


def test_account_hash_matches_hashlib(spark):
    ids = ["ABC-123", "Customer#000000001", "x"]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "id string").select(account_hash("id")).collect()]
    want = [base64.b64encode(hashlib.sha1(("{" + i.lower() + "}").encode()).digest()).decode().lower()[:28]
            for i in ids]
    assert got == want


def test_month_arithmetic(spark):
    df = spark.createDataFrame([(D(2024, 2, 29), D(2024, 3, 31))], "a date, b date")
    r = df.select(F.months_between("b", "a").alias("m"), month_end(F.col("a"), 1).alias("e")).first()
    assert r["m"] == 1.0 and r["e"] == D(2024, 3, 31)


def test_month_explode_equals_grid_join(spark):
    """The exploded month ordinals equal the literal window predicates on a grid."""
    c = Fixtures(spark, SF_SMALL).contracts
    got = monthly.month_assignments(c, AS_OF).select("contractnumber", "itemcode", "startdate", "finaldate",
                                                     "eventdate", "yearmonth", "active")
    grid = monthly.month_windows(spark, AS_OF)
    want = (c.join(F.broadcast(grid), (F.col("startdate") <= F.col("monthend"))
                   & (F.col("finaldate") >= F.col("prevmonthend")))
            .select("contractnumber", "itemcode", "startdate", "finaldate", "eventdate", "yearmonth",
                    F.coalesce(F.col("eventdate") <= F.col("monthend"), F.lit(False)).alias("active")))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_backfill_equals_range_join(spark):
    """Running max over earlier days equals the literal range join + largest pick."""
    fx = Fixtures(spark, SF_SMALL)
    c = fx.contracts
    events = (c.select("environment", "accountcode", "eventdate")
              .withColumn("packagecode", F.lit(None).cast("string")).distinct())
    got = timeline.backfill_package(events, c)
    cand = (c.where((F.col("inflowoutflow") == "Inflow") & (F.col("linepackage") == 1))
            .groupBy("environment", "accountcode", F.col("eventdate").alias("jd"))
            .agg(F.max(F.lower("itemcode")).alias("item")))
    want = (events.alias("e").join(cand.alias("k"), (F.col("e.environment") == F.col("k.environment"))
                                   & (F.col("e.accountcode") == F.col("k.accountcode"))
                                   & (F.col("k.jd") < F.col("e.eventdate")), "left")
            .groupBy("e.environment", "e.accountcode", "e.eventdate").agg(F.max("item").alias("packagecode")))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_running_mrr_last_value_is_total(spark):
    """The running commercial MRR on an account's last day equals its total."""
    fx = Fixtures(spark, SF_SMALL)
    s = summary.contract_summary(fx.contracts, fx.accounts, fx.log, AS_OF, LINK_CUTOFF)
    lines = history.history_groups(fx.contracts, s, fx["contracteventtypes"], fx["itemclassifications"])
    base = history.history_base(fx.contracts, s, fx["contracteventtypes"], fx["itemclassifications"])
    last = base.groupBy("environment", "accountcode").agg(F.max_by("summrr", "eventdate").alias("last"))
    total = lines.groupBy("environment", "accountcode").agg(F.sum("_m").alias("total"))
    diff = last.join(total, ["environment", "accountcode"]).where(F.abs(F.col("last") - F.col("total")) > 1e-6)
    assert last.count() > 0 and diff.count() == 0


def test_union_row_counts_add_up(spark):
    fx = Fixtures(spark, SF_SMALL)
    s = summary.contract_summary(fx.contracts, fx.accounts, fx.log, AS_OF, LINK_CUTOFF)
    base = history.history_base(fx.contracts, s, fx["contracteventtypes"], fx["itemclassifications"])
    parts = [history.history_points(base), history.step_points(base), history.current_points(base, AS_OF)]
    full = history.contract_history(fx.contracts, s, fx["contracteventtypes"], fx["itemclassifications"], AS_OF)
    assert full.count() == sum(p.count() for p in parts)
