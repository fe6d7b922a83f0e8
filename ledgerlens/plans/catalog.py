"""Registry of runnable queries (one per operator ID) and their DuckDB oracles.

Each query takes ``(spark, sf_dir)``, builds the domain views from the driver
tables of that directory and runs one operator (or a cumulative chain of
steps, the way the original jobs were tested) over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.plans.fixtures import AS_OF, LINK_CUTOFF, STORED, Fixtures
from ledgerlens.session import JobStore, checkpoint_shared

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------
# ACS: account contract summary
# ---------------------------------------------------------------------------
from ledgerlens.operators import summary as acs  # noqa: E402
from ledgerlens.plans import oracle_summary as acs_sql  # noqa: E402


def summary_inputs(spark: SparkSession, sf_dir: str):
    fx = Fixtures(spark, sf_dir)
    return fx.contracts, fx.accounts, fx.log


def summary_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, a, l = summary_inputs(spark, sf_dir)
    return acs.contract_summary(c, a, l, AS_OF, LINK_CUTOFF)


def summary_input(spark: SparkSession, sf_dir: str, views: Fixtures | None = None) -> DataFrame:
    """The summary as read by the downstream jobs: stored with the stored views, else
    computed from the tables (through ``views`` if given)."""
    if sf_dir.startswith(STORED):
        return Fixtures(spark, sf_dir)["summary"]
    if views is not None:
        return acs.contract_summary(views.contracts, views.accounts, views.log, AS_OF, LINK_CUTOFF)
    return summary_df(spark, sf_dir)


#: Contract columns that a step of the chain is the first to read.
_STEP_READS = {
    1: ["environment", "accountcode"],
    2: ["contracttype", "linepackage", "eventtype", "inflowoutflow", "itemcode", "startdate", "finaldate", "eventdate"],
    5: ["quantity"], 10: ["valuepermonth"], 11: ["numberofadministrations", "numberofusers"],
    12: ["contractnumber", "cancellationdate"],
}


def _stored_lines(contracts: DataFrame, k: int) -> DataFrame:
    """The lines that the first ``k`` steps each scan, stored once: steps then read them instead of joining the
    tables again, and find an account's lines together (the rebalance splits a large account)."""
    columns = [c for step, names in _STEP_READS.items() if step <= k for c in names]
    return checkpoint_shared(contracts.select(*columns).hint("rebalance", *_STEP_READS[1]), "contract-lines")


def _acs_chain(k: int, grouping="code", method="between", pick="latest"):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        c, a, l = acs.prepare_summary_inputs(*summary_inputs(spark, sf_dir))
        if k > 1:
            c = _stored_lines(c, k)
        steps = {
            2: lambda r: acs.add_first_trial(c, r, AS_OF),
            3: lambda r: acs.add_first_commercial(c, r, AS_OF),
            4: acs.add_had_indicators,
            5: lambda r: acs.add_latest_commercial(c, r, AS_OF, grouping),
            6: lambda r: acs.add_latest_commercial_dates(c, r, AS_OF),
            7: lambda r: acs.add_latest_trial(c, r, AS_OF),
            8: lambda r: acs.add_latest_trial_dates(c, r, AS_OF),
            9: lambda r: acs.add_commercial_lifetime(r, AS_OF, method),
            10: lambda r: acs.add_latest_mrr(c, r, AS_OF),
            11: lambda r: acs.add_entitlements(c, r, AS_OF),
            12: lambda r: acs.add_full_cancellation(c, r),
            13: lambda r: acs.add_churned(c, r, AS_OF),
            14: lambda r: acs.add_linked_accountant(a, l, r, LINK_CUTOFF, pick),
        }
        r = acs.account_spine(c, a)
        for i in range(2, k + 1):
            r = steps[i](r)
        cols = [col for s in range(1, k + 1) for col in acs_sql.STEP_COLUMNS[s]]
        return r.select(*cols)
    return run


for _k in range(1, 15):
    register(f"ACS-{_k}", acs_sql.summary_sql(_k))(_acs_chain(_k))
register("ACS-5-sql", acs_sql.summary_sql(5, grouping="sql"))(_acs_chain(5, grouping="sql"))
register("ACS-9-boundaries", acs_sql.summary_sql(9, method="boundaries"))(_acs_chain(9, method="boundaries"))
register("ACS-14-first", acs_sql.summary_sql(14, pick="first"))(_acs_chain(14, pick="first"))
register("ACS-ALL", acs_sql.summary_sql(14))(summary_df)


@register("ACS-ALL-sql-variants", acs_sql.summary_sql(14, grouping="sql", method="boundaries", pick="first"))
def _acs_all_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, a, l = summary_inputs(spark, sf_dir)
    return acs.contract_summary(c, a, l, AS_OF, LINK_CUTOFF, grouping="sql", method="boundaries", pick="first")


# ---------------------------------------------------------------------------
# LAL: linked-accountant change log
# ---------------------------------------------------------------------------
from pyspark.sql import functions as F  # noqa: E402

from ledgerlens.operators import links as lal  # noqa: E402
from ledgerlens.operators import monthly as asm  # noqa: E402
from ledgerlens.plans.fixtures import INGESTION_DAY  # noqa: E402
from ledgerlens.plans.oracle_links_monthly import asm_sql, lal_sql  # noqa: E402


def _lal_inputs(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return lal.prepare_link_inputs(fx["snapshot"], fx["previous_accounts"])


@register("LAL-1", lal_sql("1"))
def _lal1(spark, sf_dir):
    snap, _ = _lal_inputs(spark, sf_dir)
    return lal.entrepreneur_links(snap)


@register("LAL-2", lal_sql("2"))
def _lal2(spark, sf_dir):
    snap, prev = _lal_inputs(spark, sf_dir)
    return lal.link_changes(lal.entrepreneur_links(snap), prev)


@register("LAL-3", lal_sql("3"))
def _lal3(spark, sf_dir):
    snap, prev = _lal_inputs(spark, sf_dir)
    return lal.link_log(lal.link_changes(lal.entrepreneur_links(snap), prev), AS_OF)


@register("LAL-ALL", lal_sql("ALL"))
def _lal_all(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return lal.linked_accountant_log(fx["snapshot"], fx["previous_accounts"], AS_OF, day=INGESTION_DAY)


# ---------------------------------------------------------------------------
# ASM: monthly account summary (6 months back from AS_OF)
# ---------------------------------------------------------------------------
def _ym(m):
    return (F.floor(m / 12).cast("int") * 100 + (m % 12 + 1).cast("int")).alias("yearmonth")


def _asm_inputs(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return fx.contracts, fx.accounts


@register("ASM-1", asm_sql("1"))
def _asm1(spark, sf_dir):
    c, _ = _asm_inputs(spark, sf_dir)
    return asm.month_assignments(c, AS_OF).select(
        "environment", "accountcode", "contractnumber", "itemcode", "eventtype", "yearmonth", "monthend",
        "prevmonthend", "active")


_PK_COLS = ["environment", "accountcode", "itemcode", "contracttype", "contractnumber", "quantity", "accountid",
            "yearmonth"]


@register("ASM-2", asm_sql("2"))
def _asm2(spark, sf_dir):
    c, a = _asm_inputs(spark, sf_dir)
    return asm.monthly_package(c, a, AS_OF).select(*_PK_COLS)


@register("ASM-3", asm_sql("3"))
def _asm3(spark, sf_dir):
    c, a = _asm_inputs(spark, sf_dir)
    return asm.stamp_month(asm.monthly_package(c, a, AS_OF)).select(*_PK_COLS, "year", "month")


_TOT_COLS = ["numberofarchivedadmins", "numberofavailableadmins", "numberofpayingusers", "numberoffreeusers",
             "mrr", "numberofusers"]


@register("ASM-4", asm_sql("4"))
def _asm4(spark, sf_dir):
    c, _ = _asm_inputs(spark, sf_dir)
    return asm.monthly_totals(c, AS_OF).select("environment", "accountcode", "contractnumber", _ym(F.col("m")),
                                               *_TOT_COLS)


@register("ASM-5", asm_sql("5"))
def _asm5(spark, sf_dir):
    c, a = _asm_inputs(spark, sf_dir)
    return asm.attach_totals(asm.monthly_package(c, a, AS_OF), asm.monthly_totals(c, AS_OF)).select(
        *_PK_COLS, *_TOT_COLS)


@register("ASM-6", asm_sql("6"))
def _asm6(spark, sf_dir):
    c, _ = _asm_inputs(spark, sf_dir)
    return asm.monthly_lifetime(c, AS_OF).select("environment", "accountcode", _ym(F.col("m")),
                                                 "commerciallifetimemonths")


@register("ASM-7", asm_sql("7"))
def _asm7(spark, sf_dir):
    c, _ = _asm_inputs(spark, sf_dir)
    return asm.monthly_churn(c, AS_OF).select("environment", "accountcode", "contracttype", "contractnumber",
                                              _ym(F.col("m")), "churned")


def monthly_df(spark, sf_dir):
    c, a = _asm_inputs(spark, sf_dir)
    return asm.monthly_summary(c, a, AS_OF)


register("ASM-ALL", asm_sql("ALL"))(monthly_df)


# ---------------------------------------------------------------------------
# NAD: activity dashboard (reads the contract summary computed from the tables)
# ---------------------------------------------------------------------------
from ledgerlens.operators import dashboard as nad  # noqa: E402
from ledgerlens.operators import history as cph  # noqa: E402
from ledgerlens.plans.oracle_dash_history import cph_sql, nad_sql  # noqa: E402


def _nad_inputs(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return summary_input(spark, sf_dir), fx.accounts, fx["users"], fx["activitydaily"], fx["calendar"]


@register("NAD-1", nad_sql("1"))
def _nad1(spark, sf_dir):
    return nad._window_start_df(Fixtures(spark, sf_dir)["calendar"], AS_OF)


@register("NAD-2", nad_sql("2"))
def _nad2(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return nad.daily_activity(fx["activitydaily"], nad.window_start(fx["calendar"], AS_OF))


@register("NAD-3", nad_sql("3"))
def _nad3(spark, sf_dir):
    s, a, _, _, cal = _nad_inputs(spark, sf_dir)
    return nad.account_days(s, a, cal, AS_OF, nad.window_start(cal, AS_OF))


@register("NAD-4", nad_sql("4"))
def _nad4(spark, sf_dir):
    s, a, _, _, cal = _nad_inputs(spark, sf_dir)
    return nad.account_days(s, nad.classified_accounts(a), cal, AS_OF, nad.window_start(cal, AS_OF))


def _nad5(on_date):
    def run(spark, sf_dir):
        s, a, u, act, cal = _nad_inputs(spark, sf_dir)
        since = nad.window_start(cal, AS_OF)
        days = nad.account_days(s, nad.classified_accounts(a), cal, AS_OF, since)
        return nad.join_activity(days, u, nad.daily_activity(act, since), on_date)
    return run


register("NAD-5", nad_sql("5"))(_nad5(False))
register("NAD-5-ondate", nad_sql("5", on_date=True))(_nad5(True))


def dashboard_df(spark, sf_dir, on_date=False):
    s, a, u, act, cal = _nad_inputs(spark, sf_dir)
    return nad.no_activity(s, a, u, act, cal, AS_OF, on_date=on_date)


register("NAD-ALL", nad_sql("ALL"))(dashboard_df)
register("NAD-ALL-ondate", nad_sql("ALL", on_date=True))(lambda spark, sf: dashboard_df(spark, sf, True))


# ---------------------------------------------------------------------------
# CPH: contract history chart feed
# ---------------------------------------------------------------------------
#: Columns of the contract lines that the history reads, through the contracts, the summary's accounts, the event types and
#: the item classifications.
_HISTORY_LINES = ["environment", "accountcode", "contracttype", "eventdate", "eventtype", "itemcode", "itemdescription", "linepackage",
                  "quantity", "valuepermonth", "rownumber"]


def _cph_base(spark, sf_dir):
    fx = Fixtures(spark, sf_dir, _HISTORY_LINES)
    return cph.history_base(fx.contracts, summary_input(spark, sf_dir, fx), fx["contracteventtypes"],
                            fx["itemclassifications"])


register("CPH-1", cph_sql("1"))(lambda spark, sf: _cph_base(spark, sf).select(
    "accountid", "environment", "accountcode", "eventdate", "contracteventdescription", "itemdescription",
    "linepackage", "quantity", "summrr"))
register("CPH-2", cph_sql("2"))(lambda spark, sf: cph.history_points(_cph_base(spark, sf)))
register("CPH-3", cph_sql("3"))(lambda spark, sf: cph.step_points(_cph_base(spark, sf)))
register("CPH-4", cph_sql("4"))(lambda spark, sf: cph.current_points(_cph_base(spark, sf), AS_OF))


def history_df(spark, sf_dir):
    fx = Fixtures(spark, sf_dir, _HISTORY_LINES)
    return cph.contract_history(fx.contracts, summary_input(spark, sf_dir, fx), fx["contracteventtypes"],
                                fx["itemclassifications"], AS_OF)


register("CPH-ALL", cph_sql("ALL"))(history_df)


# ---------------------------------------------------------------------------
# ADC: daily contract activity timeline (reads the summary computed from the tables)
# ---------------------------------------------------------------------------
from ledgerlens.operators import timeline as adc  # noqa: E402
from ledgerlens.plans.oracle_timeline import adc_sql  # noqa: E402


class _Adc:
    """Shared intermediate plans of one (spark, sf_dir) run of the timeline.

    ``keep``: the contracts, the link base and the flagged lines, which the later steps read several times,
    are each stored once."""

    READS = ["environment", "accountcode", "eventdate", "eventtype", "inflowoutflow", "linepackage", "packagecode", "itemcode",
             "numberofusers", "numberofadministrations", "valuepermonth"]
    #: What the accounts' commercial starts and the views' own rules read besides.
    SUMMARY_READS = ["contracttype", "startdate", "rownumber"]

    def __init__(self, spark, sf_dir, keep=False):
        fx = Fixtures(spark, sf_dir)
        stored = checkpoint_shared if keep else lambda df, name: df
        self.contracts = stored(fx.contracts.select(*self.READS).hint("rebalance", "environment", "accountcode"),
                                "contract-lines") if keep else fx.contracts
        self.base = stored(adc.link_base(summary_input(spark, sf_dir), fx.accounts, fx.log, LINK_CUTOFF), "activity-base")
        # the step queries show the de-duplicated intermediate of the original
        self.timeline = adc.timeline_with_features(adc.timeline_events(self.contracts),
                                                   adc.running_features(self.contracts), dedupe=True)
        self.flagged = stored(adc.linked_as_of_event(self.timeline, self.base), "activity-flagged")

    def links(self):
        return adc.link_events(self.flagged, self.base)

    def union(self, tn_override=True):
        return adc.timeline_union(self.flagged, adc.overwrite_on_link_date(self.links(), self.flagged),
                                  tn_override)


_BASE_COLS = ["environment", "accountcode", "firstcommstartdate", "hadcommcontract", "datefirstlinkedtoaccountant",
              "entrepreneuraccountantlinked", "accountid", "linkstatus", "date"]
_TL_COLS = ["environment", "accountcode", "eventdate", "eventtype", "packagecode", "linepackage",
            "numberofusers", "valuepermonth", "numberofadministrations"]
_FLAG_COLS = _TL_COLS + ["datefirstlinkedtoaccountant", "datefirstlinkedtoaccountantz", "accountid",
                         "hadcommcontract"]

register("ADC-1", adc_sql("1"))(lambda spark, sf: adc.first_link(Fixtures(spark, sf).log))
register("ADC-2", adc_sql("2"))(lambda spark, sf: _Adc(spark, sf).base.select(*_BASE_COLS))
register("ADC-3", adc_sql("3"))(lambda spark, sf: _Adc(spark, sf).base.select(
    *_BASE_COLS, "accountantlinked", "datefirstlinkedtoaccountantz"))
register("ADC-4", adc_sql("4"))(lambda spark, sf: adc.change_events(Fixtures(spark, sf).contracts).select(
    "environment", "accountcode", "eventdate", "eventtype", "packagecode", "linepackage"))
register("ADC-5", adc_sql("5"))(lambda spark, sf: adc.timeline_events(Fixtures(spark, sf).contracts))
register("ADC-6", adc_sql("6"))(lambda spark, sf: adc.running_features(Fixtures(spark, sf).contracts))
register("ADC-7", adc_sql("7"))(lambda spark, sf: adc.timeline_with_features(
    adc.timeline_events(Fixtures(spark, sf).contracts), adc.running_features(Fixtures(spark, sf).contracts))
    .select(*_TL_COLS))
register("ADC-8", adc_sql("8"))(lambda spark, sf: _Adc(spark, sf).flagged.select(*_FLAG_COLS))
register("ADC-9", adc_sql("9"))(lambda spark, sf: _Adc(spark, sf).flagged.select(*_FLAG_COLS, "accountantlinked"))
register("ADC-10", adc_sql("10"))(lambda spark, sf: _Adc(spark, sf).links())
register("ADC-11", adc_sql("11"))(lambda spark, sf: (lambda r: adc.overwrite_on_link_date(r.links(), r.flagged))(
    _Adc(spark, sf)))
register("ADC-12", adc_sql("12"))(lambda spark, sf: _Adc(spark, sf).union(tn_override=False))
register("ADC-13", adc_sql("13"))(lambda spark, sf: _Adc(spark, sf).union())
register("ADC-14", adc_sql("14"))(lambda spark, sf: (lambda r: adc.backfill_package(
    checkpoint_shared(r.union(), "activity-union"), r.contracts))(_Adc(spark, sf, keep=True)))


def activity_df(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return adc.contract_activity(fx.contracts, fx.log, summary_input(spark, sf_dir), fx.accounts, LINK_CUTOFF)


register("ADC-15", adc_sql("15"))(activity_df)


# ---------------------------------------------------------------------------
# LOAD: snapshot loads; ACC: accounts load; NRM: normalisation operators
# ---------------------------------------------------------------------------
from ledgerlens.functions.columns import month_end  # noqa: E402
from ledgerlens.operators import accounts as accm  # noqa: E402
from ledgerlens.operators import loads  # noqa: E402
from ledgerlens.operators import normalize as nrm  # noqa: E402
from ledgerlens.plans.oracle_loads import CARD_TEMPLATES, PROFILE_PREFIX, acc_sql, load_sql, nrm_sql  # noqa: E402


def _snap(spark, sf_dir):
    return loads.load_snapshot(Fixtures(spark, sf_dir)["snapshot"], INGESTION_DAY)


register("LOAD-0", load_sql("0"))(_snap)
register("LOAD-1", load_sql("1"))(lambda spark, sf: loads.load_contracts(_snap(spark, sf)))
register("LOAD-2", load_sql("2"))(lambda spark, sf: loads.load_subsectors(_snap(spark, sf)))
register("LOAD-3", load_sql("3"))(lambda spark, sf: loads.load_sectors(_snap(spark, sf)))
register("LOAD-4", load_sql("4"))(lambda spark, sf: loads.load_resellers(_snap(spark, sf)))
register("LOAD-5", load_sql("5"))(lambda spark, sf: loads.load_accountants(_snap(spark, sf)))
register("LOAD-6", load_sql("6"))(lambda spark, sf: loads.load_event_types(_snap(spark, sf)))
register("LOAD-7", load_sql("7"))(lambda spark, sf: loads.load_item_classifications(_snap(spark, sf)))
register("LOAD-8", load_sql("8"))(lambda spark, sf: loads.load_account_managers(
    _snap(spark, sf), Fixtures(spark, sf)["users"]))
register("LOAD-9", load_sql("9"))(lambda spark, sf: loads.load_app_billing(
    Fixtures(spark, sf)["appbillingproposal"], INGESTION_DAY))
register("LOAD-10", load_sql("10"))(lambda spark, sf: loads.load_opportunities(
    Fixtures(spark, sf)["opportunities"], INGESTION_DAY))
register("LOAD-11", load_sql("11"))(lambda spark, sf: loads.load_app_usage(
    Fixtures(spark, sf)["monthlyappusage"], INGESTION_DAY))


def _acc_current(spark, sf_dir):
    s = Fixtures(spark, sf_dir)["snapshot"]
    from ledgerlens.sources.tables import read_ingestion_day
    s = nrm.clean_strings(read_ingestion_day(s, INGESTION_DAY), upper=["environment"], all_columns=True)
    s = nrm.cast_columns(s, timestamps=["lastmodified"], booleans=["meta_isdeleted"])
    return accm.exclude_codes(nrm.current_records(s))


def _acc_latest(spark, sf_dir):
    return accm.latest_per_key(_acc_current(spark, sf_dir), ["environment", "code"], "lastmodified",
                               accm.SNAPSHOT_ACCOUNT_COLUMNS)


def accounts_df(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return accm.load_accounts(fx["snapshot"], fx["crm_accounts"], PROFILE_PREFIX, CARD_TEMPLATES, INGESTION_DAY)


register("ACC-1", acc_sql("1"))(lambda spark, sf: _acc_current(spark, sf).select(
    "environment", "code", "account", "lastmodified"))
register("ACC-2", acc_sql("2"))(_acc_latest)
register("ACC-3", acc_sql("3"))(lambda spark, sf: accm.enrich_accounts(
    _acc_latest(spark, sf), Fixtures(spark, sf)["crm_accounts"]))
register("ACC-4", acc_sql("4"))(lambda spark, sf: _acc_latest(spark, sf).select(
    "environment", "code", accm.blank_key_fields(*accm.KEY_FIELDS).alias("numberofblankkeyfields")))
register("ACC-5", acc_sql("5"))(lambda spark, sf: _acc_latest(spark, sf).select(
    "account", accm.account_hash("account").alias("accountidhash")))
register("ACC-6", acc_sql("6"))(lambda spark, sf: _acc_latest(spark, sf).select(
    "account", accm.profile_url("account", PROFILE_PREFIX).alias("customerprofileurl")))
register("ACC-7", acc_sql("7"))(lambda spark, sf: accounts_df(spark, sf).select("environment", "accountid", "eolcardurl"))
register("ACC-8", acc_sql("8"))(accounts_df)


@register("NRM-1", nrm_sql("1"))
def _nrm1(spark, sf_dir):
    s = Fixtures(spark, sf_dir)["snapshot"].select(
        "contractnumber", "quantity", "linepackage", "accountmanagercode", "valuepermonth", "lastmodified", "blocked",
        "eventdate", "exchangerate", F.col("quantity").alias("quantitylong"))
    return nrm.cast_columns(s, integers=["quantity", "linepackage", "accountmanagercode"], doubles=["valuepermonth"],
                            timestamps=["lastmodified"], booleans=["blocked"], dates=["eventdate"],
                            floats=["exchangerate"], longs=["quantitylong"])


register("NRM-2", nrm_sql("2"))(lambda spark, sf: nrm.rename_columns(
    Fixtures(spark, sf)["previous_accounts"], {"accountcode": "code", "not_there": "ignored"}))
register("NRM-3", nrm_sql("3"))(lambda spark, sf: nrm.clean_strings(
    Fixtures(spark, sf)["appbillingproposal"], upper=["item", "environment"]))
register("NRM-4", nrm_sql("4"))(lambda spark, sf: nrm.normalize_environment(Fixtures(spark, sf).accounts))
register("NRM-5", nrm_sql("5"))(lambda spark, sf: nrm.current_records(nrm.cast_columns(
    Fixtures(spark, sf)["appbillingproposal"], booleans=["meta_isdeleted"])))
register("NRM-6", nrm_sql("6"))(lambda spark, sf: nrm.null_sentinel_date(nrm.cast_columns(
    Fixtures(spark, sf)["snapshot"].select("contractnumber", "cancellationdate"), dates=["cancellationdate"])))
register("NRM-7", nrm_sql("7"))(lambda spark, sf: nrm.drop_metadata(Fixtures(spark, sf)["monthlyappusage"]))
register("NRM-8", nrm_sql("8"))(lambda spark, sf: acs.prepare_summary_inputs(*summary_inputs(spark, sf))[0].select(
    "environment", "accountcode", "itemcode", "contracttype", "eventtype", "inflowoutflow"))
register("NRM-9", nrm_sql("9"))(lambda spark, sf: lal.prepare_link_inputs(
    Fixtures(spark, sf)["snapshot"], Fixtures(spark, sf)["previous_accounts"])[0].select(
    "environment", "code", "accountantcode", "accountantorlinked", "meta_isdeleted"))
register("NRM-10", nrm_sql("10"))(lambda spark, sf: Fixtures(spark, sf).contracts.select(
    "contractnumber", "eventdate", month_end(F.col("eventdate"), -1).alias("prevmonthend"),
    month_end(F.col("eventdate"), 0).alias("monthend")))


# ---------------------------------------------------------------------------
# SRC / SNK: sources and sinks.  Sinks write under the session's checkpoint
# directory (the cluster's shared folder) and read the result back.
# ---------------------------------------------------------------------------
import uuid  # noqa: E402

from ledgerlens.plans.oracle_loads import day_filter  # noqa: E402
from ledgerlens.session import ensure_checkpoint_dir  # noqa: E402
from ledgerlens.sources import tables as io  # noqa: E402
from ledgerlens.plans.fixtures import with_views  # noqa: E402


def scratch_path(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/ledgerlens-sinks/{uuid.uuid4().hex}/{name}"


def _read_and_drop(spark, entry: str) -> DataFrame:
    """A catalogued table over files of its own; the entry goes once the plan knows the files."""
    df = io.read_table(spark, entry, database="default")
    df._jdf.queryExecution().executedPlan()
    spark.sql(f"DROP TABLE default.{entry}")
    return df


def _catalogued(spark, sf_dir: str, name: str) -> DataFrame:
    """The table of that name, declared in the session's catalogue over the given files."""
    entry = f"ledgerlens_{name}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE default.{entry} USING parquet LOCATION '{sf_dir}/{name}.parquet'")
    return _read_and_drop(spark, entry)


def bucketed_contracts(spark, contracts: DataFrame, buckets: int | None = None) -> DataFrame:
    """Contracts stored in buckets of accounts (as many as suit their rows) and read back through the catalogue."""
    buckets = buckets or io.bucket_count(contracts)
    entry = f"ledgerlens_contracts_{uuid.uuid4().hex}"
    io.write_bucketed(contracts, entry, ["environment", "accountcode"], buckets, path=scratch_path(spark, "contracts"))
    return _read_and_drop(spark, entry)


@register("ACS-ALL-bucketed", acs_sql.summary_sql(14))
def _acs_bucketed(spark, sf_dir):
    """The summary over a bucketed table of prepared contracts: no exchange below its aggregates."""
    c, a, l = acs.prepare_summary_inputs(*summary_inputs(spark, sf_dir))
    return acs.contract_summary(bucketed_contracts(spark, c), a, l, AS_OF, LINK_CUTOFF, prepare=False)


@register("ADC-15-bucketed", adc_sql("15"))
def _adc_bucketed(spark, sf_dir):
    """The timeline over a bucketed table of the contract columns that it reads.  The lines are stored once for that table and the
    summary, until both have been read: all that the returned frame reads is stored by then."""
    with JobStore(spark, "inputs") as store:
        fx = Fixtures(spark, sf_dir, _Adc.READS + _Adc.SUMMARY_READS, store)
        bucketed = bucketed_contracts(spark, fx.contracts.select(*_Adc.READS))
        return adc.contract_activity(bucketed, fx.log, summary_input(spark, sf_dir, fx), fx.accounts, LINK_CUTOFF)


register("SRC-1", "SELECT * FROM customer")(lambda spark, sf: _catalogued(spark, sf, "customer"))
register("SRC-3", "SELECT * FROM orders")(lambda spark, sf: io.read_table(spark, path=f"{sf}/orde*.parquet"))


@register("SRC-2", with_views(["appbillingproposal"], [], (
    "SELECT * EXCLUDE (ingestionyear, ingestionmonth, ingestionday), CAST(ingestionyear AS INTEGER) AS ingestionyear, "
    "CAST(ingestionmonth AS INTEGER) AS ingestionmonth, CAST(ingestionday AS INTEGER) AS ingestionday "
    f"FROM appbillingproposal {day_filter(INGESTION_DAY)}")))
def _src2(spark, sf_dir):
    path = scratch_path(spark, "appbillingproposal")
    io.write_table(Fixtures(spark, sf_dir)["appbillingproposal"], path,
                   partition_by=["ingestionyear", "ingestionmonth", "ingestionday"])
    return io.read_ingestion_day(io.read_table(spark, path=path), INGESTION_DAY)


@register("SNK-1", with_views(["accounts"], [], "SELECT * FROM accounts"))
def _snk1(spark, sf_dir):
    path = scratch_path(spark, "accounts")
    io.write_table(Fixtures(spark, sf_dir).accounts, path)
    return io.read_table(spark, path=path)


@register("SNK-2", lal_sql("ALL"))
def _snk2(spark, sf_dir):
    path = scratch_path(spark, "linkedaccountantlog")
    log = _lal_all(spark, sf_dir)
    io.append_log(log, path)
    io.append_log(log, path)          # a re-run of the same day replaces, never duplicates
    return io.read_table(spark, path=path)


@register("SNK-3", asm_sql("ALL").replace(
    "CAST(t.yearmonth // 100 AS VARCHAR) AS year, CAST(t.yearmonth % 100 AS VARCHAR) AS month",
    "CAST(t.yearmonth // 100 AS INTEGER) AS year, CAST(t.yearmonth % 100 AS INTEGER) AS month"))
def _snk3(spark, sf_dir):
    path = scratch_path(spark, "accountsummary_monthly")
    io.write_month(monthly_df(spark, sf_dir), path)
    return io.read_table(spark, path=path)


@register("SNK-4", load_sql("9"))
def _snk4(spark, sf_dir):
    path = scratch_path(spark, "appbillingproposal")
    df = loads.load_app_billing(Fixtures(spark, sf_dir)["appbillingproposal"], INGESTION_DAY)
    io.write_if_nonempty(df.where(F.lit(False)), io.write_table, path + "-empty")   # skipped: nothing to write
    io.write_if_nonempty(df, io.write_table, path)
    return io.read_table(spark, path=path)


@register("LAL-ALL-dest", lal_sql("ALL"))
def _lal_dest(spark, sf_dir):
    """The job with its sink: read, transform, append the day's log."""
    fx = Fixtures(spark, sf_dir)
    path = scratch_path(spark, "linkedaccountantlog")
    lal.linked_accountant_log(fx["snapshot"], fx["previous_accounts"], AS_OF, day=INGESTION_DAY, dest=path)
    return io.read_table(spark, path=path)


# The load job: one stored snapshot, eight tables.
def _load_all(table: str):
    return lambda spark, sf: loads.load_all(Fixtures(spark, sf)["snapshot"], Fixtures(spark, sf)["users"], INGESTION_DAY)[table]


for _step, _table in enumerate(["contracts", "subsectors", "sectors", "resellers", "accountants", "contracteventtypes",
                                "itemclassifications", "accountmanager"], start=1):
    register(f"LOAD-ALL-{_table}", load_sql(str(_step)))(_load_all(_table))

# The other outputs of the cleaning steps.
register("NRM-8-accounts", with_views(["accounts"], [], "SELECT * REPLACE (upper(trim(environment)) AS environment, "
                                      "trim(accountcode) AS accountcode) FROM accounts"))(
    lambda spark, sf: acs.prepare_summary_inputs(*summary_inputs(spark, sf))[1])
register("NRM-8-log", with_views(["linkedaccountantlog"], [], "SELECT * REPLACE (upper(trim(environment)) AS environment) "
                                 "FROM linkedaccountantlog"))(
    lambda spark, sf: acs.prepare_summary_inputs(*summary_inputs(spark, sf))[2])
register("NRM-9-previous", with_views(["previous_accounts"], [], (
    "SELECT upper(trim(environment)) AS environment, upper(trim(accountcode)) AS accountcode, "
    "TRY_CAST(trim(accountantorlinked) AS BOOLEAN) AS accountantorlinked, upper(trim(accountantcode)) AS accountantcode "
    "FROM previous_accounts")))(lambda spark, sf: _lal_inputs(spark, sf)[1])


# ---------------------------------------------------------------------------
# The whole jobs: read by name, transform, write; the written table is read back.
# ---------------------------------------------------------------------------
from ledgerlens import jobs  # noqa: E402


class _Tables:
    """A job's inputs by the names it reads them by, each a view over the driver tables."""

    NAMES = {"contractstatistics": "snapshot", "config_calendar": "calendar"}

    def __init__(self, spark, sf_dir: str, lines: list[str] | None = None, store: JobStore | None = None):
        self.spark, self.sf_dir, self.views = spark, sf_dir, Fixtures(spark, sf_dir, lines, store)

    def __call__(self, name: str) -> DataFrame:
        if name == "accountscontract_summary":
            return summary_input(self.spark, self.sf_dir, self.views)
        return self.views[self.NAMES.get(name, name)]


def _job(job, table: str, *args, lines: list[str] | None = None, **options):
    """``lines``: columns of the contract lines that are stored once for the job's inputs, until its output is written."""
    def run(spark, sf_dir):
        dest = scratch_path(spark, "domain")
        with JobStore(spark, "inputs") as store:
            job(_Tables(spark, sf_dir, lines, store), dest, *args, **options)
        return io.read_table(spark, path=f"{dest}/{table}")
    return run


register("NAD-6", nad_sql("ALL"))(_job(jobs.activity_dashboard, "noactivity_dashboard", AS_OF))
register("ADC-ALL", adc_sql("15"))(_job(jobs.contract_activity, "activitydaily_contracts", cutoff=LINK_CUTOFF))
register("JOB-summary", acs_sql.summary_sql(14))(_job(jobs.contract_summary, "accountscontract_summary", AS_OF, cutoff=LINK_CUTOFF))
register("JOB-history", cph_sql("ALL"))(_job(jobs.contract_history, "customerprofile_contracthistory", AS_OF, lines=_HISTORY_LINES))
register("JOB-accounts", acc_sql("8"))(_job(jobs.load_accounts, "accounts", INGESTION_DAY, PROFILE_PREFIX, CARD_TEMPLATES))
register("JOB-appbilling", load_sql("9"))(_job(jobs.load_raw_tables, "appbillingproposal", INGESTION_DAY))
register("JOB-opportunities", load_sql("10"))(_job(jobs.load_raw_tables, "opportunities", INGESTION_DAY))
register("JOB-appusage", load_sql("11"))(_job(jobs.load_raw_tables, "monthlyappusage", INGESTION_DAY))
register("JOB-contracts", load_sql("1"))(_job(jobs.load_snapshot_tables, "contracts", INGESTION_DAY))
register("JOB-accountmanager", load_sql("8"))(_job(jobs.load_snapshot_tables, "accountmanager", INGESTION_DAY))
