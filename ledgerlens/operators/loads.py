"""Dimension / fact loads from the raw daily snapshot (LOAD-0 ... LOAD-11).

``load_snapshot`` cleans and types the day's snapshot once and fans it out to
the loaders; each loader is a plain select / distinct / aggregate that
Catalyst prunes to the columns it needs.  Persisting the shared snapshot only
pays off when several outputs are written from one session (``persist=True``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import lenient_integer
from ledgerlens.operators.normalize import (cast_columns, clean_strings, current_records, drop_metadata,
                                            normalize_environment, null_sentinel_date, rename_columns)
from ledgerlens.session import JobStore, checkpoint_shared, small_tasks
from ledgerlens.sources.tables import read_ingestion_day

__all__ = ["load_snapshot", "load_contracts", "load_dimension", "load_subsectors", "load_sectors",
           "load_resellers", "load_accountants", "load_event_types", "load_item_classifications",
           "load_account_managers", "load_app_billing", "load_opportunities", "load_app_usage",
           "CONTRACT_COLUMNS", "OPPORTUNITY_COLUMNS"]

# Fixed column lists of the published tables.
CONTRACT_COLUMNS = [
    "environment", "code", "contractnumber", "contracttype", "startdate", "enddate", "finaldate", "eventdate",
    "inflowoutflow", "itemcode", "packagecode", "linepackage", "quantity", "numberofadministrations",
    "numberofusers", "contractlinevalue", "valuepermonth", "valueperyear", "contractlinevaluedc", "valuepermonthdc",
    "valueperyeardc", "exchangerate", "cancellationdate", "itembasepricepermonth", "itembasepriceperyear", "name",
    "eventyearmonth", "eventyear", "eventmonth", "eventtype", "eventdescription", "item", "itemdescription",
    "itemtype",
]
CONTRACT_DATES = ["startdate", "enddate", "finaldate", "eventdate", "cancellationdate"]
CONTRACT_DOUBLES = ["contractlinevalue", "valuepermonth", "valueperyear", "contractlinevaluedc", "valuepermonthdc",
                    "valueperyeardc", "exchangerate", "itembasepricepermonth", "itembasepriceperyear"]
CONTRACT_INTS = ["quantity", "numberofadministrations", "numberofusers", "eventyearmonth", "eventyear",
                 "eventmonth", "linepackage"]
OPPORTUNITY_COLUMNS = [
    "id", "environment", "accountname", "accountcode", "actiondate", "amountfc", "amountdc", "closedate", "created",
    "creator", "modified", "currency", "name", "opportunitystage", "opportunitystagedescription",
    "opportunitystatus", "probability", "owner", "ratefc", "ownerfullname", "leadsource", "leadsourcedescription",
    "salestypedescription", "reasoncode", "reasoncodedescription", "notes", "project", "projectcode", "salestype",
    "projectdescription", "campaign", "opportunitytype", "opportunitytypedescription", "channel",
    "campaigndescription", "channeldescription",
]
SENTINEL_DATE = _dt.date(9999, 12, 31)


def load_snapshot(snapshot: DataFrame, day: _dt.date | None = None) -> DataFrame:
    """LOAD-0: the day's snapshot trimmed (all columns), ``account``/``environment``
    upper-cased, ``meta_isdeleted`` typed, site GB published as UK."""
    small_tasks(snapshot.sparkSession)
    if day is not None:
        snapshot = read_ingestion_day(snapshot, day)
    df = clean_strings(snapshot, upper=["account", "environment"], all_columns=True)
    return normalize_environment(cast_columns(df, booleans=["meta_isdeleted"]))


# The dimensions that distinct rows of the snapshot give: key, further columns, and whether the key is required.
DIMENSIONS = {
    "subsectors": ("subsectorcode", ["subsectordescription"], True),
    "sectors": ("sectorcode", ["sectordescription"], True),
    "resellers": ("resellercode", ["resellername"], True),
    "accountants": ("accountantcode", ["accountantname"], True),
    "contracteventtypes": ("eventtype", ["eventdescription"], False),
}
_ITEMS, _TYPES = ["environment", "itemcode", "itemdescription"], ["itemcode", "itemtype"]
_MANAGERS = ["accountmanagercode", "eventdate", "accountmanagername", "businesslinecode", "businesslinedescription", "environment",
             "meta_load_enddts", "meta_isdeleted"]


def grouped_snapshot(snap: DataFrame) -> DataFrame:
    """Distinct rows of every dimension from one pass over the cleaned snapshot: grouping sets, each with
    the flag of current rows, ``_set`` (its ``grouping_id``) and ``_rows``, combined map-side."""
    rows = snap.withColumn("_current", F.coalesce(F.col("meta_load_enddts").isNull() & ~F.col("meta_isdeleted"), F.lit(False)))
    sets = _grouping_sets()
    columns = sorted({c for s in sets.values() for c in s})
    # codes that grouping empties are told from NULL codes by the set
    rows = rows.select(*columns)
    return rows.groupingSets([[F.col(c) for c in s] for s in sets.values()], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_rows"))


def _grouping_sets() -> dict[str, list[str]]:
    sets = {name: ["_current", "environment", key, *attrs] for name, (key, attrs, _) in DIMENSIONS.items()}
    return sets | {"items": ["_current", *_ITEMS], "types": ["_current", *_TYPES], "managers": ["_current", *_MANAGERS]}


def _of_set(grouped: DataFrame, name: str) -> DataFrame:
    """The rows of one grouping set."""
    sets = _grouping_sets()
    columns = sorted({c for s in sets.values() for c in s})
    number = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in sets[name])
    return grouped.where(F.col("_set") == number).select(*sets[name], "_rows")


def load_all(snapshot: DataFrame, users: DataFrame, day: _dt.date | None = None, checkpoint: bool = True,
             store: JobStore | None = None) -> dict[str, DataFrame]:
    """LOAD-0 fan-out: every snapshot-derived table from one cleaned snapshot, which is
    written once to the job's ``store`` or the shared checkpoint folder (``checkpoint=False``: cleaned for each).

    The stored snapshot is scanned twice: for the contract lines, and for the grouping sets that
    all seven dimensions are read from (stored as well, a few rows for each code)."""
    snap = load_snapshot(snapshot, day)
    if checkpoint:
        snap = checkpoint_shared(snap, "snapshot", store)
    grouped = grouped_snapshot(snap)
    if checkpoint:
        grouped = checkpoint_shared(grouped, "dimensions", store)
    current = {n: _of_set(grouped, n).where("_current") for n in [*DIMENSIONS, "items", "types"]}
    out = {"contracts": load_contracts(snap)}
    for name, (key, attrs, required) in DIMENSIONS.items():
        df = current[name].select("environment", key, *attrs)
        out[name] = df.where(F.col(key).isNotNull()) if required else df
    out["contracteventtypes"] = out["contracteventtypes"].withColumnsRenamed(_EVENT_TYPE_NAMES)
    out["itemclassifications"] = _classified(current["items"].select(*_ITEMS), current["types"].where(
        F.col("itemtype").isNotNull()).select(*_TYPES, F.when(F.col("itemcode").isNull(), 0).otherwise(F.col("_rows")).alias("cn")), "least")
    out["accountmanager"] = load_account_managers(_of_set(grouped, "managers").select(*_MANAGERS), users)
    return out


def load_contracts(snap: DataFrame) -> DataFrame:
    """LOAD-1: current contract lines, typed, ``code`` -> ``accountcode``, event type
    duplicated as ``contracteventtypecode``, sentinel cancellation date -> NULL."""
    df = current_records(snap).select(*CONTRACT_COLUMNS)
    df = cast_columns(df, dates=CONTRACT_DATES, doubles=CONTRACT_DOUBLES, integers=CONTRACT_INTS)
    df = df.withColumnRenamed("code", "accountcode").withColumn("contracteventtypecode", F.col("eventtype"))
    return null_sentinel_date(df, "cancellationdate", SENTINEL_DATE)


def load_dimension(snap: DataFrame, key: str, attrs: list[str], require_key: bool = True) -> DataFrame:
    """LOAD-2..5: distinct (environment, key, attrs) of current rows with a key."""
    df = current_records(snap)
    if require_key:
        df = df.where(F.col(key).isNotNull())
    return df.select("environment", key, *attrs).distinct()


def load_subsectors(snap: DataFrame) -> DataFrame:
    return load_dimension(snap, "subsectorcode", ["subsectordescription"])


def load_sectors(snap: DataFrame) -> DataFrame:
    return load_dimension(snap, "sectorcode", ["sectordescription"])


def load_resellers(snap: DataFrame) -> DataFrame:
    return load_dimension(snap, "resellercode", ["resellername"])


def load_accountants(snap: DataFrame) -> DataFrame:
    return load_dimension(snap, "accountantcode", ["accountantname"])


_EVENT_TYPE_NAMES = {"eventtype": "contracteventtypecode", "eventdescription": "contracteventdescription"}


def load_event_types(snap: DataFrame) -> DataFrame:
    """LOAD-6: distinct event types (no key test), renamed to the dimension names."""
    return load_dimension(snap, "eventtype", ["eventdescription"], require_key=False).withColumnsRenamed(_EVENT_TYPE_NAMES)


def load_item_classifications(snap: DataFrame, pick: str = "least") -> DataFrame:
    """LOAD-7: distinct (environment, item, description) with one item type per item
    code, counted across environments.

    ``pick="least"`` (the original) takes the least frequent type, ties on the
    smallest type; ``"most"`` the most frequent, ties on the largest.
    """
    cur = current_records(snap)
    items = cur.select(*_ITEMS).distinct()
    counts = (cur.where(F.col("itemtype").isNotNull()).groupBy(*_TYPES)
              .agg(F.count("itemcode").alias("cn")))
    return _classified(items, counts, pick)


def _classified(items: DataFrame, counts: DataFrame, pick: str) -> DataFrame:
    """Items with the type that ``counts`` (itemcode, itemtype, cn) picks for their code."""
    order = F.struct(F.col("cn"), F.col("itemtype"))
    agg = F.min(order) if pick == "least" else F.max(order)
    if pick not in ("least", "most"):
        raise ValueError(f"unknown pick {pick!r}")
    types = counts.groupBy(F.col("itemcode").alias("_code")).agg(agg.alias("_t")).select(
        "_code", F.col("_t.itemtype").alias("itemtype"))
    return items.join(types, items["itemcode"] == types["_code"], "left").drop("_code")


def load_account_managers(snap: DataFrame, users: DataFrame) -> DataFrame:
    """LOAD-8: latest row per manager code over ALL rows, kept only when that row is
    current and has a code (a deleted latest row drops the manager; among rows of one
    time an open, live one comes first); joined to the users on environment, name and numeric hid.

    The latest row is an aggregate (``max`` of a struct led by the event time),
    not a window, so a manager with many rows is combined map-side.
    """
    df = cast_columns(snap, timestamps=["eventdate"], integers=["accountmanagercode"], booleans=["meta_isdeleted"])
    latest = df.groupBy("accountmanagercode").agg(F.max(F.struct(
        F.col("eventdate").alias("t"), F.col("meta_load_enddts").isNull().alias("open"), (~F.col("meta_isdeleted")).alias("live"),
        "accountmanagername", "businesslinecode", "businesslinedescription",
        "environment", "meta_load_enddts", "meta_isdeleted")).alias("_r"))
    latest = latest.where(F.col("_r.meta_load_enddts").isNull() & ~F.col("_r.meta_isdeleted")
                          & F.col("accountmanagercode").isNotNull()).select(
        "accountmanagercode", "_r.accountmanagername", "_r.businesslinecode", "_r.businesslinedescription",
        "_r.environment")
    u = clean_strings(users, upper=["environment"], all_columns=True).select(
        F.col("environment").alias("_env"), F.col("fullname").alias("_name"),
        lenient_integer("hid").alias("_hid"), F.col("userid").alias("accountmanagerid"))
    j = latest.join(u, (latest["environment"] == u["_env"]) & (latest["accountmanagername"] == u["_name"])
                    & (latest["accountmanagercode"] == u["_hid"]), "left")
    return j.select("accountmanagerid", "accountmanagercode", "accountmanagername", "businesslinecode",
                    "businesslinedescription", "environment")


def _raw_load(raw: DataFrame, day, upper: list[str], timestamps=(), booleans=(), dates=(),
              rename: dict | None = None) -> DataFrame:
    if day is not None:
        raw = read_ingestion_day(raw, day)
    df = clean_strings(raw, upper=upper, all_columns=True)
    if rename:
        df = rename_columns(df, rename)
    df = cast_columns(df, timestamps=timestamps, booleans=booleans, dates=dates)
    return current_records(normalize_environment(df))


def load_app_billing(raw: DataFrame, day: _dt.date | None = None) -> DataFrame:
    """LOAD-9: app billing proposals: cleaned, typed, current, without ingestion columns."""
    df = _raw_load(raw, day, ["item", "environment"], timestamps=["meta_load_enddts"], booleans=["meta_isdeleted"])
    return df.drop("ingestionyear", "ingestionmonth", "ingestionday")


def load_opportunities(raw: DataFrame, day: _dt.date | None = None) -> DataFrame:
    """LOAD-10: CRM opportunities: country -> environment, renamed descriptions, 36 columns."""
    df = _raw_load(raw, day, ["country"], timestamps=["meta_load_enddts"], booleans=["meta_isdeleted"],
                   rename={"country": "environment", "salesdescription": "salestypedescription",
                           "reasondescription": "reasoncodedescription"})
    return df.select(*OPPORTUNITY_COLUMNS)


def load_app_usage(raw: DataFrame, day: _dt.date | None = None) -> DataFrame:
    """LOAD-11: monthly app usage: six upper-cased keys, typed, current, no metadata columns."""
    df = _raw_load(raw, day, ["app", "partner", "usedbycustomer", "id", "entryid", "environment"],
                   timestamps=["meta_load_enddts"], dates=["firstappusagedate"],
                   booleans=["isfreeconnection", "meta_isdeleted"])
    return drop_metadata(df)
