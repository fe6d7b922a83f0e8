"""Daily contract activity timeline with accountant-link events (ADC-1 ... ADC-15).

Shape of the computation:

* link base per account: summary x accounts + first 'Accountant Linked' date,
  with the link date ``z`` used to flag each change line (ADC-1..3);
* change events (Inflow, or Outflow price changes) with package-consistent
  event types (ADC-4/5), decorated with the account's running users / admins /
  MRR per day (ADC-6/7) and the link flag of the line (ADC-8/9);
* one synthetic LINK row per linked commercial account (ADC-10/11);
* union, NULL packages back-filled from the latest earlier package day, one
  row per (account, day, event type) (ADC-12..15).

Every "first/last row per account" of the original is an aggregate here
(``max`` over a struct whose fields spell the sort order, numeric keys negated
for ascending parts), and every running value is a scan over *daily* rows in two
levels (``functions.prefix``).  No window ever holds all lines or all days of one account and
the quadratic range join of the package back-fill is replaced by a running max over earlier days.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import KEYS, as_date
from ledgerlens.functions.prefix import prefix_scan
from ledgerlens.session import JobStore, checkpoint_shared

__all__ = ["first_link", "link_base", "change_events", "timeline_events", "running_features", "timeline_with_features",
           "linked_as_of_event", "link_events", "overwrite_on_link_date", "timeline_union", "backfill_package",
           "contract_activity", "ACTIVITY_COLUMNS", "DEFAULT_LINK_CUTOFF"]

# Fixed values.
LINKED = "Accountant Linked"
WITH_ACCOUNTANT = "EntrepreneurWithAccountant"
WITHOUT_ACCOUNTANT = "EntrepreneurWithoutAccountant"
PACKAGE_EVENTS = ("TN", "CN", "CT", "CDN", "CUP")
PRICE_CHANGE = "PRC"
NEW_TRIAL = "TN"
LINK_EVENT = "LINK"
DEFAULT_LINK_CUTOFF = _dt.date(2016, 2, 9)

ACTIVITY_COLUMNS = ["date", "environment", "accountcode", "packagecode", "eventtype", "accountantorlinked",
                    "numberofusers", "numberofadministrations", "mrr", "accountid"]
_FEATURES = ["numberofusers", "numberofadministrations", "valuepermonth"]


def _c(n: str) -> Column:
    return F.col(n)


def first_link(log: DataFrame) -> DataFrame:
    """ADC-1: first 'Accountant Linked' date per account (environment trimmed); an
    entry without a date is the first."""
    return (log.where(_c("linkstatus") == LINKED)
            .groupBy(F.trim(_c("environment")).alias("environment"), "accountcode")
            .agg(F.min(F.struct("date"))["date"].alias("date"))
            .withColumn("linkstatus", F.lit(LINKED)))


def link_base(summary: DataFrame, accounts: DataFrame, log: DataFrame, cutoff=DEFAULT_LINK_CUTOFF) -> DataFrame:
    """ADC-2/3: per account its commercial start, link dates and flag.

    ``accountantlinked`` = 1 for entrepreneurs with an accountant.
    ``datefirstlinkedtoaccountantz`` (z): the first link date for linked
    accounts starting on/after ``cutoff``, the commercial start for accountant
    accounts without a link, and the first link date for starts on/before ``cutoff``.
    """
    cutoff = as_date(cutoff)
    s = summary.select(*KEYS, "firstcommstartdate", "hadcommcontract", "datefirstlinkedtoaccountant")
    a = accounts.select(*KEYS, "entrepreneuraccountantlinked", "accountid")
    status = _c("entrepreneuraccountantlinked")
    fcs = _c("firstcommstartdate")
    linked = _c("linkstatus") == LINKED
    z = (F.when((status == WITH_ACCOUNTANT) & (fcs >= cutoff) & linked, _c("date"))
         .when((status == WITH_ACCOUNTANT) & (fcs >= cutoff) & _c("linkstatus").isNull(), fcs)
         .when((status == WITHOUT_ACCOUNTANT) & (fcs >= cutoff) & linked, _c("date"))
         .when((fcs <= cutoff) & linked, _c("date")))
    return (s.join(a, KEYS, "inner").join(first_link(log), KEYS, "left")
            .withColumns({"accountantlinked": F.when(status == WITH_ACCOUNTANT, 1).otherwise(0),
                          "datefirstlinkedtoaccountantz": z}))


def _is_change() -> Column:
    io = _c("inflowoutflow")
    return (io == "Inflow") | ((io == "Outflow") & (_c("eventtype") == PRICE_CHANGE))


def _is_timeline_event() -> Column:
    fits = _c("linepackage") == F.when(_c("eventtype").isin(*PACKAGE_EVENTS), 1).otherwise(0)
    return _is_change() & fits


def change_events(contracts: DataFrame) -> DataFrame:
    """ADC-4: Inflow lines and Outflow price changes."""
    return contracts.where(_is_change())


def timeline_events(contracts: DataFrame) -> DataFrame:
    """ADC-5: change events whose package flag fits the event type (1 for package
    events TN/CN/CT/CDN/CUP, else 0)."""
    return contracts.where(_is_timeline_event()).select(*KEYS, "eventdate", "eventtype", "packagecode", "linepackage")


def _daily_features() -> list[Column]:
    """Sums over lines; each value is truncated to whole units first."""
    return [F.sum(_c(f).cast("bigint")).alias(f) for f in _FEATURES]


def _running(daily: DataFrame) -> DataFrame:
    return prefix_scan(daily.select(*KEYS, "eventdate", *_FEATURES), KEYS, "eventdate", sums={f: f for f in _FEATURES})


def running_features(contracts: DataFrame) -> DataFrame:
    """ADC-6: per account and event day the running totals of users, admins and MRR
    over all contract lines; each line is cast to whole units first (cents truncated)."""
    return _running(contracts.groupBy(*KEYS, "eventdate").agg(*_daily_features()))


def timeline_with_features(events: DataFrame, features: DataFrame, dedupe: bool = True) -> DataFrame:
    """ADC-7: attach the running features of the event's day; optionally distinct."""
    out = events.join(features, KEYS + ["eventdate"], "left")
    return out.distinct() if dedupe else out


def linked_as_of_event(timeline: DataFrame, base: DataFrame) -> DataFrame:
    """ADC-8/9: attach the account's link data and flag each line: with no link date
    the account flag; linked on or before the event day -> 1; after -> 0."""
    b = base.select(*KEYS, "datefirstlinkedtoaccountant", "datefirstlinkedtoaccountantz",
                    _c("accountantlinked").alias("_account_flag"), "accountid", "hadcommcontract")
    z, ed, af = _c("datefirstlinkedtoaccountantz"), _c("eventdate"), _c("_account_flag")
    flag = (F.when(af.isNull(), F.lit(None).cast("int")).when(z.isNull(), af)
            .when(z <= ed, 1).when(z > ed, 0))
    return timeline.join(b, KEYS, "left").withColumn("accountantlinked", flag).drop("_account_flag")


def link_events(flagged: DataFrame, base: DataFrame) -> DataFrame:
    """ADC-10: one LINK candidate per linked commercial account.

    Among the account's lines on or before its link date (metrics filled with 0,
    the date kept only for a line without metrics) the first by date (NULL
    first), MRR, admins, users and the largest package is taken; an account
    without such lines gets the link date and zero metrics.
    """
    dfla = _c("datefirstlinkedtoaccountant")
    eligible = dfla.isNotNull() & (_c("hadcommcontract") == 1)
    lines = flagged.where(eligible & (_c("eventdate") <= dfla))
    no_metrics = (_c("numberofadministrations").isNull() & _c("numberofusers").isNull()
                  & _c("valuepermonth").isNull())
    cand_date = F.when(no_metrics, dfla)
    filled = {f: F.coalesce(_c(f), F.lit(0).cast("bigint")) for f in _FEATURES}
    best = lines.groupBy(*KEYS).agg(F.max(F.struct(
        cand_date.isNull().alias("k0"), (-F.unix_date(cand_date)).alias("k1"),
        (-filled["valuepermonth"]).alias("k2"), (-filled["numberofadministrations"]).alias("k3"),
        (-filled["numberofusers"]).alias("k4"), _c("packagecode").alias("packagecode"),
        cand_date.alias("eventdate"), filled["valuepermonth"].alias("valuepermonth"),
        filled["numberofadministrations"].alias("numberofadministrations"),
        filled["numberofusers"].alias("numberofusers"))).alias("_b"))
    # accounts may be published twice: one row each, the latest link date, then the largest id
    z = "datefirstlinkedtoaccountantz"
    one = base.where(eligible).groupBy(*KEYS).agg(F.max(F.struct(z, "accountid", "datefirstlinkedtoaccountant")).alias("_one"))
    b = one.select(*KEYS, "_one.*")
    out = b.join(best, KEYS, "left")
    has = _c("_b").isNotNull()
    zero = F.lit(0).cast("bigint")
    return out.select(
        *KEYS, "accountid", "datefirstlinkedtoaccountant", "datefirstlinkedtoaccountantz",
        F.when(has, _c("_b.eventdate")).otherwise(dfla).alias("eventdate"),
        F.when(has, _c("_b.packagecode")).alias("packagecode"),
        F.lit(LINK_EVENT).alias("eventtype"),
        *[F.when(has, _c(f"_b.{f}")).otherwise(zero).alias(f) for f in _FEATURES])


def overwrite_on_link_date(links: DataFrame, flagged: DataFrame) -> DataFrame:
    """ADC-11: when the timeline has changes on the link date z, the LINK row takes
    that day's largest package / users / admins / MRR (admins whenever known, the
    others when a package is known)."""
    day = flagged.groupBy(_c("environment").alias("_e"), _c("accountcode").alias("_a"),
                          _c("eventdate").alias("_z")).agg(
        F.max("numberofusers").alias("_users"), F.max("packagecode").alias("_pkg"),
        F.max("numberofadministrations").alias("_admins"), F.max("valuepermonth").alias("_mrr"))
    j = links.join(day, (_c("environment") == _c("_e")) & (_c("accountcode") == _c("_a"))
                   & (_c("datefirstlinkedtoaccountantz") == _c("_z")), "left")
    pkg_known = _c("_pkg").isNotNull()
    return j.select(
        _c("datefirstlinkedtoaccountantz").alias("eventdate"), *KEYS,
        F.when(pkg_known, _c("_pkg")).otherwise(_c("packagecode")).alias("packagecode"),
        F.lit(LINK_EVENT).alias("eventtype"), F.lit(1).alias("accountantlinked"),
        F.when(pkg_known, _c("_users")).otherwise(_c("numberofusers")).alias("numberofusers"),
        F.when(_c("_admins").isNotNull(), _c("_admins")).otherwise(_c("numberofadministrations"))
        .alias("numberofadministrations"),
        F.when(pkg_known, _c("_mrr")).otherwise(_c("valuepermonth")).alias("valuepermonth"),
        "accountid")


_UNION_COLS = ["eventdate", "environment", "accountcode", "packagecode", "eventtype", "accountantlinked",
               "numberofusers", "numberofadministrations", "valuepermonth", "accountid"]


def timeline_union(flagged: DataFrame, link_rows: DataFrame, tn_override: bool = True, more: list[str] | None = None) -> DataFrame:
    """ADC-12/13: changes plus LINK rows (dated at z); new trials are never linked."""
    cols = _UNION_COLS + (more or [])
    u = flagged.select(*cols).unionByName(link_rows.select(*cols))
    if not tn_override:
        return u
    return u.withColumn("accountantlinked",
                        F.when(_c("eventtype") == NEW_TRIAL, F.lit(0)).otherwise(_c("accountantlinked")))


def _item_candidates() -> Column:
    """The largest lower-cased Inflow package item of some lines."""
    return F.max(F.when((_c("inflowoutflow") == "Inflow") & (_c("linepackage") == 1), F.lower(_c("itemcode")))).alias("_item")


def _fill_before(days: DataFrame) -> DataFrame:
    """(account, day, _fill): the largest item of strictly earlier days; one row per account-day in and out."""
    days = days.where(_c("eventdate").isNotNull()).select(*KEYS, "eventdate", "_item")
    return prefix_scan(days, KEYS, "eventdate", before={"_fill": _c("_item")}).drop("_item")


def backfill_package(timeline: DataFrame, contracts: DataFrame) -> DataFrame:
    """ADC-14: a NULL package takes the largest (lower-cased) Inflow package item of
    the account's strictly earlier package days, i.e. the running max of the per-day
    item over earlier days; every package is lower-cased.

    The running max runs over one row per (account, day): candidate days and the
    days needing a back-fill.
    """
    candidates = contracts.groupBy(*KEYS, "eventdate").agg(_item_candidates())
    need = timeline.where(_c("packagecode").isNull()).select(*KEYS, "eventdate", F.lit(None).cast("string").alias("_item"))
    days = candidates.unionByName(need).groupBy(*KEYS, "eventdate").agg(F.max("_item").alias("_item"))
    out = timeline.join(_fill_before(days), KEYS + ["eventdate"], "left")
    return out.withColumn("packagecode", F.lower(F.coalesce(_c("packagecode"), _c("_fill")))).drop("_fill")


def _final_rows(timeline: DataFrame) -> DataFrame:
    """ADC-15: one row per (account, date, event type): lowest MRR, admins, users
    (NULL first), then the largest package; typed output columns."""
    key = KEYS + ["eventdate", "eventtype"]
    m, a, u = _c("valuepermonth"), _c("numberofadministrations"), _c("numberofusers")
    best = timeline.groupBy(*key).agg(F.max(F.struct(
        m.isNull().alias("k0"), (-m).alias("k1"), a.isNull().alias("k2"), (-a).alias("k3"),
        u.isNull().alias("k4"), (-u).alias("k5"), _c("packagecode").alias("packagecode"),
        _c("accountantlinked").alias("accountantlinked"), _c("accountid").alias("accountid"),
        m.alias("mrr"), a.alias("admins"), u.alias("users"))).alias("_b"))
    return best.select(
        _c("eventdate").cast("date").alias("date"), *KEYS, _c("_b.packagecode").alias("packagecode"), "eventtype",
        _c("_b.accountantlinked").cast("boolean").alias("accountantorlinked"),
        _c("_b.users").cast("bigint").alias("numberofusers"),
        _c("_b.admins").cast("bigint").alias("numberofadministrations"),
        _c("_b.mrr").cast("float").alias("mrr"), _c("_b.accountid").alias("accountid"))


def contract_activity(contracts: DataFrame, log: DataFrame, summary: DataFrame, accounts: DataFrame,
                      cutoff=DEFAULT_LINK_CUTOFF, checkpoint: bool = True, store: JobStore | None = None) -> DataFrame:
    """ADC-ALL (ADC-15): the daily contract activity timeline.

    The output has one row per (account, day, event type), and within such a
    group the running features and the link flag are fixed (they depend on the
    account and day only).  So the contracts are read once and aggregated to that
    grain, combined map-side: feature sums and back-fill candidates over all lines,
    the largest package, the largest lower-cased package and whether a package is
    missing over the change events.  Everything downstream runs on those groups:
    rolled up to days, they give the running features and the back-fill.

    The groups and the link base feed several consumers; with ``checkpoint=True``
    (default) each is written once to the job's ``store`` or the session's shared checkpoint folder.
    """
    keep = (lambda df, name: checkpoint_shared(df, name, store)) if checkpoint else (lambda df, name: df)
    base = keep(link_base(summary, accounts, log, cutoff), "activity-base")
    event, pkg = _is_timeline_event(), _c("packagecode")
    groups = keep(contracts.groupBy(*KEYS, "eventdate", "eventtype").agg(
        *_daily_features(), _item_candidates(), F.max(F.when(event, F.lit(True))).alias("_event"),
        F.max(F.when(event, pkg)).alias("packagecode"), F.max(F.when(event, F.lower(pkg))).alias("_lpkg"),
        F.max(F.when(event & pkg.isNull(), F.lit(True))).alias("_missing")), "activity-groups")
    daily = groups.groupBy(*KEYS, "eventdate").agg(*[F.sum(f).alias(f) for f in _FEATURES], F.max("_item").alias("_item"))
    changes = groups.where("_event").select(*KEYS, "eventdate", "eventtype", "packagecode", "_lpkg", "_missing")
    flagged = keep(linked_as_of_event(timeline_with_features(changes, _running(daily), dedupe=False), base), "activity-flagged")
    links = overwrite_on_link_date(link_events(flagged, base), flagged)
    more = ["_lpkg", "_missing"]
    union = timeline_union(flagged, links.withColumns({
        "_lpkg": F.lower(pkg), "_missing": F.when(pkg.isNull(), F.lit(True))}), more=more)
    link_days = base.select(*KEYS, _c("datefirstlinkedtoaccountantz").alias("eventdate"), F.lit(None).cast("string").alias("_item"))
    days = (daily.select(*KEYS, "eventdate", "_item").unionByName(link_days)
            .groupBy(*KEYS, "eventdate").agg(F.max("_item").alias("_item")))
    filled = union.join(_fill_before(days), KEYS + ["eventdate"], "left").withColumn(
        "packagecode", F.greatest(_c("_lpkg"), F.when(_c("_missing"), _c("_fill"))))
    return _final_rows(filled)
