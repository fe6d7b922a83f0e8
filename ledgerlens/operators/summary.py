"""Account contract summary: one row per account (ACS-1 ... ACS-14, ACS-ALL).

Every step is a per-account aggregate left-joined onto the running result, so
each can be used on its own (``add_*``).  ``contract_summary`` computes the
whole row in a fused plan instead of fourteen aggregate+join rounds:

* one ``groupBy(environment, accountcode)`` over all contract lines with
  filtered aggregates for steps 2, 3, 10, 11, 12 and 13;
* a short chain of coarsening aggregations for the "latest package" steps
  5-8 (line groups -> item -> account);
* one small aggregate each over the link log and the accounts (step 14).

"Top-1 per account" is expressed as ``min``/``max`` over a struct whose field
order is the sort order.  Those are ordinary aggregates with map-side partial
aggregation, so an account holding a third of all lines is combined on every
executor before the shuffle instead of being sorted in a single task.  Ties
the original ordering leaves open are broken on the selected value itself so
that results are deterministic.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import KEYS, as_date

__all__ = [
    "TRIAL", "COMMERCIAL", "NEW_TRIAL", "PRICE_INCREASE", "INFLOW", "ARCHIVED_ITEM",
    "LINKED", "WITH_ACCOUNTANT", "WITHOUT_ACCOUNTANT", "DEFAULT_LINK_CUTOFF",
    "prepare_summary_inputs", "account_spine", "add_first_trial", "add_first_commercial",
    "add_had_indicators", "add_latest_commercial", "add_latest_commercial_dates", "add_latest_trial",
    "add_latest_trial_dates", "add_commercial_lifetime", "add_latest_mrr", "add_entitlements",
    "add_full_cancellation", "add_churned", "add_linked_accountant", "latest_packages",
    "contract_summary", "contract_summary_stepwise", "SUMMARY_COLUMNS",
]

# Fixed values of the contract vocabulary.
TRIAL, COMMERCIAL = "T", "C"
NEW_TRIAL, PRICE_INCREASE = "TN", "PI"
INFLOW = "Inflow"
ARCHIVED_ITEM = "EOL9950"
LINKED = "Accountant Linked"
WITH_ACCOUNTANT = "EntrepreneurWithAccountant"
WITHOUT_ACCOUNTANT = "EntrepreneurWithoutAccountant"
DEFAULT_LINK_CUTOFF = _dt.date(2016, 2, 9)

SUMMARY_COLUMNS = [
    "environment", "accountcode", "accountid",
    "firsttrialstartdate", "firsttrialfinaldate", "firsttrialpackage",
    "firstcommstartdate", "firstcommfinaldate", "firstcommpackage",
    "hadtrial", "hadcommcontract",
    "latestcommpackage", "latestcommstartdate", "latestcommfinaldate",
    "latesttrialpackage", "latesttrialstartdate", "latesttrialfinaldate",
    "commlifetimemonths", "latestmrr",
    "latestnumberofavailableadmins", "latestnumberofarchivedadmins", "latestnumberofusers",
    "latestnumberpayingusers", "latestnumberfreeusers",
    "fullcancellationrequestdate", "requestedfullcancellation",
    "maxfinaldate", "churned",
    "accountantlinked", "datefirstlinkedtoaccountant",
]


# --------------------------------------------------------------------------
# predicates
# --------------------------------------------------------------------------
def _c(name: str) -> Column:
    return F.col(name)


def _pkg() -> Column:
    return _c("linepackage") == 1


def _past(as_of) -> Column:
    return _c("eventdate") <= as_date(as_of)


def _inflow() -> Column:
    return _c("inflowoutflow") == INFLOW


def _trial_start() -> Column:
    return (_c("contracttype") == TRIAL) & _pkg() & _c("eventtype").isin(NEW_TRIAL, PRICE_INCREASE)


def _comm_pkg() -> Column:
    return (_c("contracttype") == COMMERCIAL) & _pkg()


# --------------------------------------------------------------------------
# NRM-8
# --------------------------------------------------------------------------
def prepare_summary_inputs(contracts: DataFrame, accounts: DataFrame, log: DataFrame,
                           persist: bool = False):
    """Trim / upper-case the join keys of the three summary inputs.

    ``inflowoutflow`` is trimmed but keeps its case; the log's accountcode is
    left as is.  ``persist`` only pays off when several actions reuse them.
    """
    up = lambda n: F.upper(F.trim(_c(n)))
    contracts = contracts.withColumns({
        "itemcode": up("itemcode"), "environment": up("environment"),
        "accountcode": F.trim(_c("accountcode")), "contracttype": up("contracttype"),
        "eventtype": up("eventtype"), "inflowoutflow": F.trim(_c("inflowoutflow")),
    })
    accounts = accounts.withColumns({"accountcode": F.trim(_c("accountcode")),
                                     "environment": up("environment")})
    log = log.withColumn("environment", up("environment"))
    if persist:
        contracts, accounts, log = contracts.persist(), accounts.persist(), log.persist()
    return contracts, accounts, log


# --------------------------------------------------------------------------
# aggregate building blocks shared by the step functions and the fused plan
# --------------------------------------------------------------------------
def _first_aggs(prefix: str, base: Column, pick: Column) -> list[Column]:
    """min start/final over ``base``; package = item of the earliest ``pick`` line
    (ties: smallest item code)."""
    return [
        F.min(F.when(base, _c("startdate"))).alias(f"{prefix}startdate"),
        F.min(F.when(base, _c("finaldate"))).alias(f"{prefix}finaldate"),
        F.min(F.when(pick, F.struct(_c("eventdate").alias("d"), _c("itemcode").alias("item"))))
        .alias(f"_{prefix}pick"),
    ]


def _first_trial_aggs(as_of) -> list[Column]:
    return _first_aggs("firsttrial", _trial_start(), _trial_start() & _inflow() & _past(as_of))


def _first_comm_aggs(as_of) -> list[Column]:
    return _first_aggs("firstcomm", _comm_pkg(), _comm_pkg() & _inflow() & _past(as_of))


def _first_finish(prefix: str, package: str) -> dict[str, Column]:
    return {package: _c(f"_{prefix}pick.item")}


def _mrr_aggs(as_of) -> list[Column]:
    return [F.sum(F.when((_c("contracttype") == COMMERCIAL) & _past(as_of), _c("valuepermonth")))
            .alias("_mrr")]


def _mrr_finish() -> dict[str, Column]:
    # round to cents, then the integer cast truncates toward zero
    return {"latestmrr": F.round(_c("_mrr"), 2).cast("bigint")}


def _entitlement_aggs(as_of) -> list[Column]:
    d = as_date(as_of)
    active = (_c("finaldate") >= d) & (_c("eventdate") <= d)
    item, admins, users, vpm = _c("itemcode"), _c("numberofadministrations"), _c("numberofusers"), _c("valuepermonth")

    def s(value: Column, name: str) -> Column:
        return F.sum(F.when(active, value)).cast("bigint").alias(name)

    return [
        s(F.when(item != ARCHIVED_ITEM, admins).otherwise(0), "latestnumberofavailableadmins"),
        s(F.when(item == ARCHIVED_ITEM, admins).otherwise(0), "latestnumberofarchivedadmins"),
        s(users, "latestnumberofusers"),
        s(F.when(vpm != 0, users).otherwise(0), "latestnumberpayingusers"),
        s(F.when(vpm == 0, users).otherwise(0), "latestnumberfreeusers"),
    ]


def _cancellation_aggs() -> list[Column]:
    # latest Inflow package line by (eventdate, contractnumber) desc; ties on the
    # later cancellation date.  NULLs rank last, as in a DESC sort.
    cand = _inflow() & _pkg()
    return [F.max(F.when(cand, F.struct(_c("eventdate").alias("d"), _c("contractnumber").alias("n"),
                                        _c("cancellationdate").alias("cd"))))
            .alias("_cancel")]


def _cancellation_finish() -> dict[str, Column]:
    return {
        "fullcancellationrequestdate": _c("_cancel.cd"),
        "requestedfullcancellation": F.when(_c("_cancel").isNull(), F.lit(None).cast("int"))
        .when(_c("_cancel.cd").isNull(), F.lit(0)).otherwise(F.lit(1)),
    }


def _churn_aggs() -> list[Column]:
    return [F.max("finaldate").alias("maxfinaldate")]


def _churn_finish(as_of) -> dict[str, Column]:
    return {"churned": F.when(_c("maxfinaldate") > as_date(as_of), F.lit(0)).otherwise(F.lit(1))}


def _per_account(contracts: DataFrame, aggs: list[Column], finish: dict[str, Column],
                 keep: list[str]) -> DataFrame:
    out = contracts.groupBy(*KEYS).agg(*aggs)
    if finish:
        out = out.withColumns(finish)
    return out.select(*KEYS, *keep)


# --------------------------------------------------------------------------
# ACS-1 ... ACS-14 as separate steps
# --------------------------------------------------------------------------
def account_spine(contracts: DataFrame, accounts: DataFrame) -> DataFrame:
    """ACS-1: every (environment, accountcode, accountid) with contracts and an account."""
    keys = contracts.select(*KEYS).distinct()
    return keys.join(accounts.select(*KEYS, "accountid"), KEYS, "inner").distinct()


def add_first_trial(contracts: DataFrame, result: DataFrame, as_of) -> DataFrame:
    """ACS-2: first trial start/final date (any TN/PI package line) and the package of
    the earliest Inflow one on or before ``as_of``."""
    agg = _per_account(contracts, _first_trial_aggs(as_of), _first_finish("firsttrial", "firsttrialpackage"),
                       ["firsttrialstartdate", "firsttrialfinaldate", "firsttrialpackage"])
    return result.join(agg, KEYS, "left")


def add_first_commercial(contracts: DataFrame, result: DataFrame, as_of) -> DataFrame:
    """ACS-3: as ACS-2 for commercial package lines (no event type test)."""
    agg = _per_account(contracts, _first_comm_aggs(as_of), _first_finish("firstcomm", "firstcommpackage"),
                       ["firstcommstartdate", "firstcommfinaldate", "firstcommpackage"])
    return result.join(agg, KEYS, "left")


def add_had_indicators(result: DataFrame) -> DataFrame:
    """ACS-4."""
    return result.withColumns({
        "hadtrial": F.when(_c("firsttrialpackage").isNotNull(), F.lit(1)).otherwise(F.lit(0)),
        "hadcommcontract": F.when(_c("firstcommpackage").isNotNull(), F.lit(1)).otherwise(F.lit(0)),
    })


def _latest_package_candidates(contracts: DataFrame, as_of, contract_type: str, grouping: str) -> DataFrame:
    """Per-account best (finaldate, summed quantity, item) among package lines."""
    if contract_type == COMMERCIAL:
        lines = contracts.where(_comm_pkg() & _past(as_of))
        group = ["itemcode", "finaldate"] + (["eventdate"] if grouping == "code" else [])
    else:
        lines = contracts.where(_trial_start() & _past(as_of))
        group = ["itemcode", "finaldate"]
    g = lines.groupBy(*KEYS, *group).agg(F.sum("quantity").alias("q"))
    best = g.groupBy(*KEYS).agg(F.max(F.struct(_c("finaldate").alias("f"), _c("q").alias("q"),
                                                _c("itemcode").alias("item"))).alias("best"))
    return best.select(*KEYS, _c("best.item").alias("item"))


def add_latest_commercial(contracts: DataFrame, result: DataFrame, as_of, grouping: str = "code") -> DataFrame:
    """ACS-5: commercial package with the latest final date, then the largest summed
    quantity.  ``grouping="code"`` sums per event date (the PySpark job);
    ``"sql"`` sums across event dates (the stored procedure)."""
    best = _latest_package_candidates(contracts, as_of, COMMERCIAL, grouping)
    return result.join(best.withColumnRenamed("item", "latestcommpackage"), KEYS, "left")


def _item_dates(contracts: DataFrame, as_of, contract_type: str, prefix: str) -> DataFrame:
    lines = contracts.where((_c("contracttype") == contract_type) & _pkg() & _inflow() & _past(as_of))
    return (lines.groupBy(*KEYS, "itemcode")
            .agg(F.max("startdate").alias(f"{prefix}startdate"), F.max("finaldate").alias(f"{prefix}finaldate"))
            .withColumnRenamed("itemcode", f"{prefix}package"))


def add_latest_commercial_dates(contracts: DataFrame, result: DataFrame, as_of) -> DataFrame:
    """ACS-6: latest start/final date of Inflow lines of the latest commercial package."""
    dates = _item_dates(contracts, as_of, COMMERCIAL, "latestcomm")
    return result.join(dates, KEYS + ["latestcommpackage"], "left")


def add_latest_trial(contracts: DataFrame, result: DataFrame, as_of) -> DataFrame:
    """ACS-7: as ACS-5 for trial TN/PI package lines, summed per (item, final date)."""
    best = _latest_package_candidates(contracts, as_of, TRIAL, "sql")
    return result.join(best.withColumnRenamed("item", "latesttrialpackage"), KEYS, "left")


def add_latest_trial_dates(contracts: DataFrame, result: DataFrame, as_of) -> DataFrame:
    """ACS-8."""
    dates = _item_dates(contracts, as_of, TRIAL, "latesttrial")
    return result.join(dates, KEYS + ["latesttrialpackage"], "left")


def _lifetime(as_of, method: str) -> Column:
    d = as_date(as_of)
    end = F.when(_c("latestcommfinaldate") > d, d).otherwise(_c("latestcommfinaldate"))
    start = _c("firstcommstartdate")
    if method == "between":
        months = F.months_between(end, start).cast("int")
        return F.coalesce(F.when(_c("hadcommcontract") == 1, months).otherwise(F.lit(0)), F.lit(0))
    if method == "boundaries":
        months = ((F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)).cast("int")
        return F.when(_c("hadcommcontract") == 1, months).otherwise(F.lit(0))
    raise ValueError(f"unknown lifetime method {method!r}")


def add_commercial_lifetime(result: DataFrame, as_of, method: str = "between") -> DataFrame:
    """ACS-9: commercial lifetime in months up to ``as_of`` or the latest final date.

    ``"between"``: fractional months truncated, unknown -> 0 (the PySpark job);
    ``"boundaries"``: month boundaries crossed, unknown stays NULL (the stored procedure).
    """
    return result.withColumn("commlifetimemonths", _lifetime(as_of, method))


def add_latest_mrr(contracts: DataFrame, result: DataFrame, as_of) -> DataFrame:
    """ACS-10: MRR of all commercial lines on or before ``as_of``."""
    agg = _per_account(contracts, _mrr_aggs(as_of), _mrr_finish(), ["latestmrr"])
    return result.join(agg, KEYS, "left")


def add_entitlements(contracts: DataFrame, result: DataFrame, as_of) -> DataFrame:
    """ACS-11: admins (available / archived), users (all / paying / free) on active lines."""
    aggs = _entitlement_aggs(as_of)
    d = as_date(as_of)
    # accounts without an active line get NULLs, not zeros
    active = contracts.where((_c("finaldate") >= d) & (_c("eventdate") <= d))
    agg = active.groupBy(*KEYS).agg(*aggs)
    return result.join(agg, KEYS, "left")


def add_full_cancellation(contracts: DataFrame, result: DataFrame) -> DataFrame:
    """ACS-12: cancellation request of the latest Inflow package line (no date filter)."""
    agg = _per_account(contracts.where(_inflow() & _pkg()), _cancellation_aggs(), _cancellation_finish(),
                       ["fullcancellationrequestdate", "requestedfullcancellation"])
    return result.join(agg, KEYS, "left")


def add_churned(contracts: DataFrame, result: DataFrame, as_of) -> DataFrame:
    """ACS-13: churned = no line ends after ``as_of``; keeps ``maxfinaldate``."""
    agg = _per_account(contracts, _churn_aggs(), _churn_finish(as_of), ["maxfinaldate", "churned"])
    return result.join(agg, KEYS, "left")


def _link_dates(log: DataFrame, pick: str) -> DataFrame:
    # a NULL date ranks first: it is the first link, and the latest only when it is the only one
    agg = F.max(F.struct("date"))["date"] if pick == "latest" else F.min(F.struct("date"))["date"]
    if pick not in ("latest", "first"):
        raise ValueError(f"unknown pick {pick!r}")
    return log.where(_c("linkstatus") == LINKED).groupBy(*KEYS).agg(agg.alias("linkdate"), F.lit(True).alias("_linked"))


def _account_link_flags(accounts: DataFrame) -> DataFrame:
    status = F.trim(_c("entrepreneuraccountantlinked"))
    return accounts.groupBy(*KEYS).agg(
        F.max(F.when(status == WITH_ACCOUNTANT, 1).otherwise(0)).alias("_with"),
        F.max(F.when(status == WITHOUT_ACCOUNTANT, 1).otherwise(0)).alias("_without"),
    )


def _linked_columns(cutoff) -> dict[str, Column]:
    cutoff = as_date(cutoff)
    started = _c("firstcommstartdate") >= cutoff
    linked = F.coalesce(_c("_linked"), F.lit(False))  # also by an entry without a date
    return {
        "accountantlinked": _c("_with"),
        "datefirstlinkedtoaccountant":
            F.when(((_c("_with") == 1) | (_c("_without") == 1)) & started & linked, _c("linkdate"))
            .when((_c("_with") == 1) & started & ~linked, _c("firstcommstartdate")),
    }


def add_linked_accountant(accounts: DataFrame, log: DataFrame, result: DataFrame,
                          cutoff=DEFAULT_LINK_CUTOFF, pick: str = "latest") -> DataFrame:
    """ACS-14: accountant-linked flag and the date the account linked.

    Link date = latest (``pick="latest"``, the PySpark job) or first
    (``"first"``, the stored procedure) 'Accountant Linked' entry.  The date is
    reported for commercial starts on/after ``cutoff``: the link date when the
    account has one, else the commercial start for accounts with an accountant.
    """
    links = _link_dates(log, pick)
    flags = _account_link_flags(accounts)
    base = result.select(*KEYS, "firstcommstartdate").distinct()
    la = (base.join(flags, KEYS, "inner").join(links, KEYS, "left")
          .withColumns(_linked_columns(cutoff))
          .groupBy(*KEYS).agg(F.max("accountantlinked").alias("accountantlinked"),
                              F.max("datefirstlinkedtoaccountant").alias("datefirstlinkedtoaccountant")))
    return result.join(la, KEYS, "left")


def contract_summary_stepwise(contracts: DataFrame, accounts: DataFrame, log: DataFrame, as_of,
                              cutoff=DEFAULT_LINK_CUTOFF, grouping: str = "code", method: str = "between",
                              pick: str = "latest") -> DataFrame:
    """ACS-ALL as the literal chain of steps (kept for equivalence tests)."""
    contracts, accounts, log = prepare_summary_inputs(contracts, accounts, log)
    r = account_spine(contracts, accounts)
    r = add_first_trial(contracts, r, as_of)
    r = add_first_commercial(contracts, r, as_of)
    r = add_had_indicators(r)
    r = add_latest_commercial(contracts, r, as_of, grouping)
    r = add_latest_commercial_dates(contracts, r, as_of)
    r = add_latest_trial(contracts, r, as_of)
    r = add_latest_trial_dates(contracts, r, as_of)
    r = add_commercial_lifetime(r, as_of, method)
    r = add_latest_mrr(contracts, r, as_of)
    r = add_entitlements(contracts, r, as_of)
    r = add_full_cancellation(contracts, r)
    r = add_churned(contracts, r, as_of)
    r = add_linked_accountant(accounts, log, r, cutoff, pick)
    return r.select(*SUMMARY_COLUMNS)


# --------------------------------------------------------------------------
# fused plan
# --------------------------------------------------------------------------
def latest_packages(contracts: DataFrame, as_of, grouping: str = "code") -> DataFrame:
    """ACS-5..8 in one chain of coarsening aggregations over package lines on or
    before ``as_of``:

    1. line groups (account, type, item, finaldate, event day): summed
       quantities and the latest Inflow start/final dates.  Commercial lines are
       grouped per event day (the "code" ranking sums per day), trial lines
       without it (their ranking sums across days); a hash aggregate over the
       raw lines with map-side combine;
    2. (account, type, item): the item's best (finaldate, quantity) candidate and
       the item's latest Inflow dates;
    3. (account): best item per contract type, carrying that item's dates.
    """
    ct = _c("contracttype")
    lines = contracts.where(_pkg() & _past(as_of) & ct.isin(COMMERCIAL, TRIAL))
    tn = _c("eventtype").isin(NEW_TRIAL, PRICE_INCREASE)
    inflow = _inflow()
    if grouping == "code":
        day = F.when(ct == COMMERCIAL, _c("eventdate")).alias("_day")
    elif grouping == "sql":
        day = F.lit(None).cast("date").alias("_day")
    else:
        raise ValueError(f"unknown grouping {grouping!r}")
    l1 = lines.groupBy(*KEYS, "contracttype", "itemcode", "finaldate", day).agg(
        F.sum("quantity").alias("q"),
        F.sum(F.when(tn, _c("quantity"))).alias("tq"),
        F.count(F.when(tn, F.lit(1))).alias("tn"),
        F.max(F.when(inflow, _c("startdate"))).alias("ms"),
        F.max(F.when(inflow, _c("finaldate"))).alias("mf"),
    )
    f, item = _c("finaldate"), _c("itemcode")
    l2 = l1.groupBy(*KEYS, "contracttype", "itemcode").agg(
        F.max(F.struct(f.alias("f"), _c("q").alias("q"), item.alias("item"))).alias("cbest"),
        F.max(F.when(_c("tn") > 0, F.struct(f.alias("f"), _c("tq").alias("q"), item.alias("item")))).alias("tbest"),
        F.max("ms").alias("ms"), F.max("mf").alias("mf"))

    def pick(best: str, type_: str) -> Column:
        return F.max(F.when(ct == type_, F.struct(
            _c(f"{best}.f").alias("f"), _c(f"{best}.q").alias("q"), _c(f"{best}.item").alias("item"),
            _c("ms").alias("ms"), _c("mf").alias("mf"))))

    l3 = l2.groupBy(*KEYS).agg(pick("cbest", COMMERCIAL).alias("c"), pick("tbest", TRIAL).alias("t"))

    def dates(side: str, col: str) -> Column:
        # a NULL item never matches on the item join of the step-wise form
        return F.when(_c(f"{side}.item").isNotNull(), _c(f"{side}.{col}"))

    return l3.select(
        *KEYS,
        _c("c.item").alias("latestcommpackage"),
        dates("c", "ms").alias("latestcommstartdate"), dates("c", "mf").alias("latestcommfinaldate"),
        _c("t.item").alias("latesttrialpackage"),
        dates("t", "ms").alias("latesttrialstartdate"), dates("t", "mf").alias("latesttrialfinaldate"),
    )


def contract_summary(contracts: DataFrame, accounts: DataFrame, log: DataFrame, as_of,
                     cutoff=DEFAULT_LINK_CUTOFF, grouping: str = "code", method: str = "between",
                     pick: str = "latest", prepare: bool = True) -> DataFrame:
    """ACS-ALL: the account contract summary as one fused plan.

    Same columns and values as :func:`contract_summary_stepwise`.
    """
    if prepare:
        contracts, accounts, log = prepare_summary_inputs(contracts, accounts, log)
    aggs = (_first_trial_aggs(as_of) + _first_comm_aggs(as_of) + _mrr_aggs(as_of)
            + _entitlement_aggs(as_of) + _cancellation_aggs() + _churn_aggs())
    finish = {**_first_finish("firsttrial", "firsttrialpackage"), **_first_finish("firstcomm", "firstcommpackage"),
              **_mrr_finish(), **_cancellation_finish(), **_churn_finish(as_of)}
    per_account = contracts.groupBy(*KEYS).agg(*aggs).withColumns(finish)

    packages = latest_packages(contracts, as_of, grouping)
    # de-duplicate the (narrow) account keys, not the wide joined rows
    spine = accounts.select(*KEYS, "accountid").distinct()
    r = per_account.join(spine, KEYS, "inner").join(packages, KEYS, "left")
    r = add_had_indicators(r)
    r = add_commercial_lifetime(r, as_of, method)

    links = _link_dates(log, pick)
    flags = _account_link_flags(accounts)
    r = (r.join(flags, KEYS, "left").join(links, KEYS, "left").withColumns(_linked_columns(cutoff)))
    return r.select(*SUMMARY_COLUMNS)
