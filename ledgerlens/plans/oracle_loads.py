"""DuckDB oracle SQL for the snapshot loads (LOAD), the accounts load (ACC) and the
normalisation operators (NRM).  Written in plain SQL: TRY_CAST for lenient
casts (integers by their digits), window ``row_number`` picks."""

from __future__ import annotations

import datetime as _dt

from ledgerlens.plans.fixtures import AS_OF, INGESTION_DAY, SNAPSHOT_COLUMNS, with_views
from ledgerlens.plans.oracle_summary import PREPARED, d

# Column lists of the tables.
CONTRACT_COLUMNS = [
    "environment", "code", "contractnumber", "contracttype", "startdate", "enddate", "finaldate", "eventdate",
    "inflowoutflow", "itemcode", "packagecode", "linepackage", "quantity", "numberofadministrations",
    "numberofusers", "contractlinevalue", "valuepermonth", "valueperyear", "contractlinevaluedc", "valuepermonthdc",
    "valueperyeardc", "exchangerate", "cancellationdate", "itembasepricepermonth", "itembasepriceperyear", "name",
    "eventyearmonth", "eventyear", "eventmonth", "eventtype", "eventdescription", "item", "itemdescription",
    "itemtype",
]
DATES = {"startdate", "enddate", "finaldate", "eventdate", "cancellationdate"}
DOUBLES = {"contractlinevalue", "valuepermonth", "valueperyear", "contractlinevaluedc", "valuepermonthdc",
           "valueperyeardc", "exchangerate", "itembasepricepermonth", "itembasepriceperyear"}
INTS = {"quantity", "numberofadministrations", "numberofusers", "eventyearmonth", "eventyear", "eventmonth",
        "linepackage"}
ACCOUNT_COLUMNS = [
    "environment", "code", "account", "name", "isaccountant", "accountantorlinked", "entrepreneuraccountantlinked",
    "accountantcode", "chamberofcommerce", "vatnumber", "postcode", "city", "state", "country", "sectorcode",
    "subsectorcode", "compsizecode", "bustypecode", "accountclassificationcode", "accountmanagercode",
    "accountmanageraccountantcode", "resellercode", "leadsourcecode", "blocked",
]
OPPORTUNITY_COLUMNS = [
    "id", "environment", "accountname", "accountcode", "actiondate", "amountfc", "amountdc", "closedate", "created",
    "creator", "modified", "currency", "name", "opportunitystage", "opportunitystagedescription",
    "opportunitystatus", "probability", "owner", "ratefc", "ownerfullname", "leadsource", "leadsourcedescription",
    "salestypedescription", "reasoncode", "reasoncodedescription", "notes", "project", "projectcode", "salestype",
    "projectdescription", "campaign", "opportunitytype", "opportunitytypedescription", "channel",
    "campaigndescription", "channeldescription",
]
METADATA = {"meta_hash", "meta_isdeleted", "meta_lastupdateprocessid", "meta_load_enddts", "meta_load_startdts",
            "meta_processid", "meta_source", "ingestionyear", "ingestionmonth", "ingestionday"}

# Example URL templates used by the account queries (real ones are job arguments).
PROFILE_PREFIX = "https://reports.example.invalid/accounts?filter=AccountID%20eq%20%27"
CARD_TEMPLATES = {
    "NL": ("https://cards.example.invalid/nl?AccountID=%7b", "%7d&_Division_=1"),
    "BE": ("https://cards.example.invalid/be?AccountID=%7b", "%7d&_Division_=1"),
    "FR": ("https://cards.example.invalid/fr?AccountID=%7b", "%7d&_Division_=1"),
    "UK": ("https://cards.example.invalid/uk?AccountID=%7b", "%7d&_Division_=1"),
    "US": ("https://cards.example.invalid/us?Action=0&AccountID=%7b", "%7d&_Division_=1"),
    "ES": ("https://cards.example.invalid/es?AccountID=%7b", "%7d"),
    "DE": ("https://cards.example.invalid/de?AccountID=%7b", "%7d&_Division_=1"),
}


def lint(x: str, kind: str = "INTEGER") -> str:
    """The digits before the point of a plain decimal number, else NULL."""
    digits = f"coalesce(nullif(regexp_extract(trim({x}), '^[+-]?[0-9]*'), ''), '0')"
    return (f"CASE WHEN regexp_full_match(trim({x}), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)') "
            f"THEN TRY_CAST(CASE WHEN {digits} IN ('+', '-') THEN '0' ELSE {digits} END AS {kind}) END")


def day_filter(day: _dt.date | None) -> str:
    if day is None:
        return ""
    return (f"WHERE TRY_CAST(ingestionyear AS INTEGER) = {day.year} AND TRY_CAST(ingestionmonth AS INTEGER) = "
            f"{day.month} AND TRY_CAST(ingestionday AS INTEGER) = {day.day}")


def _clean_all(columns: list[str], upper: set[str], source: str, day: _dt.date | None,
               typed: dict[str, str] | None = None) -> str:
    typed = typed or {}
    exprs = []
    for c in columns:
        e = f"upper(trim({c}))" if c in upper else f"trim({c})"
        if c in typed:
            e = typed[c].format(e)
        exprs.append(f"{e} AS {c}")
    return f"SELECT {', '.join(exprs)} FROM {source} {day_filter(day)}"


def _snap_ctes(day: _dt.date | None = INGESTION_DAY) -> list[tuple[str, str]]:
    return [
        ("snap0", _clean_all(SNAPSHOT_COLUMNS, {"account", "environment"}, "snapshot", day,
                             {"meta_isdeleted": "TRY_CAST({} AS BOOLEAN)"})),
        ("snap", "SELECT * REPLACE (CASE WHEN environment = 'GB' THEN 'UK' ELSE environment END AS environment) "
                 "FROM snap0"),
        ("cur", "SELECT * FROM snap WHERE meta_load_enddts IS NULL AND NOT meta_isdeleted"),
    ]


def _contract_select() -> str:
    out = []
    for c in CONTRACT_COLUMNS:
        if c == "cancellationdate":
            out.append("CASE WHEN TRY_CAST(cancellationdate AS DATE) <> DATE '9999-12-31' "
                       "THEN TRY_CAST(cancellationdate AS DATE) END AS cancellationdate")
        elif c in DATES:
            out.append(f"TRY_CAST({c} AS DATE) AS {c}")
        elif c in DOUBLES:
            out.append(f"TRY_CAST({c} AS DOUBLE) AS {c}")
        elif c in INTS:
            out.append(f"{lint(c)} AS {c}")
        elif c == "code":
            out.append("code AS accountcode")
        else:
            out.append(c)
    return f"SELECT {', '.join(out)}, eventtype AS contracteventtypecode FROM cur"


def _load_ctes() -> list[tuple[str, str]]:
    return _snap_ctes() + [
        ("l1", _contract_select()),
        ("l2", "SELECT DISTINCT environment, subsectorcode, subsectordescription FROM cur WHERE subsectorcode IS NOT NULL"),
        ("l3", "SELECT DISTINCT environment, sectorcode, sectordescription FROM cur WHERE sectorcode IS NOT NULL"),
        ("l4", "SELECT DISTINCT environment, resellercode, resellername FROM cur WHERE resellercode IS NOT NULL"),
        ("l5", "SELECT DISTINCT environment, accountantcode, accountantname FROM cur WHERE accountantcode IS NOT NULL"),
        ("l6", "SELECT DISTINCT environment, eventtype AS contracteventtypecode, "
               "eventdescription AS contracteventdescription FROM cur"),
        ("ic1", "SELECT DISTINCT environment, itemcode, itemdescription FROM cur"),
        ("ic2", "SELECT itemcode AS code, itemtype, count(itemcode) AS cn FROM cur WHERE itemtype IS NOT NULL "
                "GROUP BY itemcode, itemtype"),
        ("ic3", """SELECT code, itemtype FROM (SELECT *, row_number() OVER (PARTITION BY code
                ORDER BY cn ASC, itemtype ASC) AS rn FROM ic2) t WHERE rn = 1"""),
        ("l7", "SELECT ic1.environment, ic1.itemcode, ic1.itemdescription, ic3.itemtype FROM ic1 "
               "LEFT JOIN ic3 ON ic1.itemcode = ic3.code"),
        ("am", f"""SELECT {lint('accountmanagercode')} AS accountmanagercode, accountmanagername, businesslinecode,
              businesslinedescription, environment, TRY_CAST(eventdate AS TIMESTAMP) AS eventdate, meta_load_enddts,
              meta_isdeleted FROM snap"""),
        ("am1", """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY accountmanagercode ORDER BY
                eventdate DESC NULLS LAST, meta_load_enddts IS NULL DESC, NOT meta_isdeleted DESC NULLS LAST,
                accountmanagername DESC NULLS LAST, businesslinecode DESC NULLS LAST,
                businesslinedescription DESC NULLS LAST, environment DESC NULLS LAST, meta_load_enddts DESC NULLS LAST,
                meta_isdeleted DESC NULLS LAST) AS rn FROM am) t
              WHERE rn = 1 AND meta_load_enddts IS NULL AND NOT meta_isdeleted AND accountmanagercode IS NOT NULL"""),
        ("uc", f"""SELECT trim(userid) AS userid, upper(trim(environment)) AS environment, trim(fullname) AS fullname,
              {lint('hid')} AS hid FROM users"""),
        ("l8", """SELECT uc.userid AS accountmanagerid, am1.accountmanagercode, am1.accountmanagername,
              am1.businesslinecode, am1.businesslinedescription, am1.environment
            FROM am1 LEFT JOIN uc ON am1.environment = uc.environment AND am1.accountmanagername = uc.fullname
              AND am1.accountmanagercode = uc.hid"""),
    ]


APP_BILLING_COLUMNS = ["id", "item", "environment", "accountcode", "amount", "meta_load_enddts", "meta_isdeleted",
                       "ingestionyear", "ingestionmonth", "ingestionday"]
OPPORTUNITY_RAW = [
    "id", "country", "accountname", "accountcode", "actiondate", "amountfc", "amountdc", "closedate", "created",
    "creator", "modified", "currency", "name", "opportunitystage", "opportunitystagedescription",
    "opportunitystatus", "probability", "owner", "ratefc", "ownerfullname", "leadsource", "leadsourcedescription",
    "salesdescription", "reasoncode", "reasondescription", "notes", "project", "projectcode", "salestype",
    "projectdescription", "campaign", "opportunitytype", "opportunitytypedescription", "channel",
    "campaigndescription", "channeldescription", "internalnote", "meta_load_enddts", "meta_isdeleted",
    "ingestionyear", "ingestionmonth", "ingestionday",
]
APP_USAGE_COLUMNS = [
    "app", "partner", "usedbycustomer", "id", "entryid", "environment", "firstappusagedate", "isfreeconnection",
    "usagevalue", "meta_hash", "meta_isdeleted", "meta_lastupdateprocessid", "meta_load_enddts",
    "meta_load_startdts", "meta_processid", "meta_source", "ingestionyear", "ingestionmonth", "ingestionday",
]
_TYPED = {"meta_load_enddts": "TRY_CAST({} AS TIMESTAMP)", "meta_isdeleted": "TRY_CAST({} AS BOOLEAN)"}


def _raw_ctes() -> list[tuple[str, str]]:
    env = "CASE WHEN environment = 'GB' THEN 'UK' ELSE environment END AS environment"
    opp_typed = dict(_TYPED)
    usage_typed = dict(_TYPED, firstappusagedate="TRY_CAST({} AS DATE)", isfreeconnection="TRY_CAST({} AS BOOLEAN)")
    keep_usage = [c for c in APP_USAGE_COLUMNS if c not in METADATA]
    return [
        ("ab0", _clean_all(APP_BILLING_COLUMNS, {"item", "environment"}, "appbillingproposal", INGESTION_DAY, _TYPED)),
        ("l9", f"SELECT * EXCLUDE (ingestionyear, ingestionmonth, ingestionday) REPLACE ({env}) FROM ab0 "
               "WHERE meta_load_enddts IS NULL AND NOT meta_isdeleted"),
        ("op0", _clean_all(OPPORTUNITY_RAW, {"country"}, "opportunities", INGESTION_DAY, opp_typed)),
        ("l10", "SELECT " + ", ".join(
            "CASE WHEN country = 'GB' THEN 'UK' ELSE country END AS environment" if c == "environment"
            else "salesdescription AS salestypedescription" if c == "salestypedescription"
            else "reasondescription AS reasoncodedescription" if c == "reasoncodedescription" else c
            for c in OPPORTUNITY_COLUMNS) + " FROM op0 WHERE meta_load_enddts IS NULL AND NOT meta_isdeleted"),
        ("au0", _clean_all(APP_USAGE_COLUMNS, {"app", "partner", "usedbycustomer", "id", "entryid", "environment"},
                           "monthlyappusage", INGESTION_DAY, usage_typed)),
        ("l11", "SELECT " + ", ".join(env if c == "environment" else c for c in keep_usage)
                + " FROM au0 WHERE meta_load_enddts IS NULL AND NOT meta_isdeleted"),
    ]


LOAD_FINAL = {"0": "SELECT * FROM snap", "1": "SELECT * FROM l1", "2": "SELECT * FROM l2", "3": "SELECT * FROM l3",
              "4": "SELECT * FROM l4", "5": "SELECT * FROM l5", "6": "SELECT * FROM l6", "7": "SELECT * FROM l7",
              "8": "SELECT * FROM l8", "9": "SELECT * FROM l9", "10": "SELECT * FROM l10", "11": "SELECT * FROM l11"}


def load_sql(step: str) -> str:
    if step in ("9", "10", "11"):
        return with_views(["appbillingproposal", "opportunities", "monthlyappusage"], _raw_ctes(), LOAD_FINAL[step])
    return with_views(["snapshot", "users"], _load_ctes(), LOAD_FINAL[step])


# ---------------------------------------------------------------------------
# ACC
# ---------------------------------------------------------------------------
def _acc_ctes() -> list[tuple[str, str]]:
    others = [c for c in ACCOUNT_COLUMNS if c not in ("environment", "code")]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in others)
    blanks = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in
                        ["chamberofcommerce", "vatnumber", "postcode", "sectorcode", "compsizecode", "bustypecode"])
    card = "CASE " + " ".join(f"WHEN environment = '{k}' THEN '{p}' || lower(account) || '{s}'"
                              for k, (p, s) in CARD_TEMPLATES.items()) + " ELSE '%7d' END"
    final_cols = []
    for c in ["environment", "code", "account"] + [c for c in ACCOUNT_COLUMNS if c not in ("environment", "code", "account")]:
        if c == "code":
            final_cols.append("code AS accountcode")
        elif c == "account":
            final_cols.append("account AS accountid")
        elif c in ("accountantorlinked", "blocked"):
            final_cols.append(f"TRY_CAST({c} AS BOOLEAN) AS {c}")
        elif c in ("accountmanagercode", "accountmanageraccountantcode"):
            final_cols.append(f"{lint(c)} AS {c}")
        else:
            final_cols.append(c)
    crm_cols = ["dunsnumber", "TRY_CAST(syscreated AS TIMESTAMP) AS syscreated",
                "TRY_CAST(sysmodified AS TIMESTAMP) AS sysmodified", "sbicode", "databaseid", "maincontact",
                f"{lint('maindivision')} AS maindivision", f"{lint('isanonymized')} AS isanonymized", "leadpurpose",
                f"{lint('anonymisationsource')} AS anonymisationsource", "invoicedebtor"]
    return [
        ("acs", _clean_all(SNAPSHOT_COLUMNS, {"environment"}, "snapshot", INGESTION_DAY,
                           {"lastmodified": "TRY_CAST({} AS TIMESTAMP)", "meta_isdeleted": "TRY_CAST({} AS BOOLEAN)"})),
        ("acur", "SELECT * FROM acs WHERE meta_load_enddts IS NULL AND NOT meta_isdeleted "
                 "AND code NOT IN ('162697700000000000')"),
        ("alat", f"""SELECT environment, code, lastmodified, {', '.join(others)} FROM (
              SELECT *, row_number() OVER (PARTITION BY environment, code ORDER BY lastmodified DESC NULLS LAST, {order})
                AS rn FROM acur) t WHERE rn = 1"""),
        ("aj", """SELECT a.*, c.dunsnumber, c.syscreated, c.sysmodified, c.sbicode, c.databaseid, c.maincontact,
              c.maindivision, c.isanonymized, c.leadpurpose, c.anonymisationsource, c.invoiceaccount AS invoicedebtor
            FROM alat a LEFT JOIN crm_accounts c ON a.account = c.id"""),
        ("aj2", f"""SELECT aj.* REPLACE (CASE WHEN environment = 'GB' THEN 'UK' ELSE environment END AS environment),
              {blanks} AS numberofblankkeyfields,
              substr(lower(to_base64(unhex(sha1('{{' || lower(account) || '}}')))), 1, 28) AS accountidhash
            FROM aj"""),
        ("afin", f"""SELECT {', '.join(final_cols)}, {', '.join(crm_cols)}, numberofblankkeyfields, accountidhash,
              '{PROFILE_PREFIX}' || account || '%27' AS customerprofileurl, {card} AS eolcardurl
            FROM aj2"""),
    ]


ACC_FINAL = {
    "1": "SELECT environment, code, account, lastmodified FROM acur",
    "2": "SELECT * FROM alat",
    "3": "SELECT * EXCLUDE (lastmodified) FROM aj",
    "4": "SELECT environment, code, " + " + ".join(
        f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in
        ["chamberofcommerce", "vatnumber", "postcode", "sectorcode", "compsizecode", "bustypecode"])
         + " AS numberofblankkeyfields FROM alat",
    "5": "SELECT account, substr(lower(to_base64(unhex(sha1('{' || lower(account) || '}')))), 1, 28) AS accountidhash "
         "FROM alat",
    "6": f"SELECT account, '{PROFILE_PREFIX}' || account || '%27' AS customerprofileurl FROM alat",
    "7": "SELECT environment, accountid, eolcardurl FROM afin",
    "8": "SELECT * FROM afin",
}


def acc_sql(step: str) -> str:
    return with_views(["snapshot", "crm_accounts"], _acc_ctes(), ACC_FINAL[step])


# ---------------------------------------------------------------------------
# NRM
# ---------------------------------------------------------------------------
def nrm_sql(step: str, as_of: _dt.date = AS_OF) -> str:
    if step == "1":
        body = f"""SELECT contractnumber, {lint('quantity')} AS quantity, {lint('linepackage')} AS linepackage,
            {lint('accountmanagercode')} AS accountmanagercode, TRY_CAST(valuepermonth AS DOUBLE) AS valuepermonth,
            TRY_CAST(lastmodified AS TIMESTAMP) AS lastmodified, TRY_CAST(blocked AS BOOLEAN) AS blocked,
            TRY_CAST(eventdate AS DATE) AS eventdate, TRY_CAST(exchangerate AS FLOAT) AS exchangerate,
            {lint('quantity', 'BIGINT')} AS quantitylong FROM snapshot"""
        return with_views(["snapshot"], [], body)
    if step == "2":
        return with_views(["previous_accounts"], [], "SELECT environment, accountcode AS code, accountantorlinked, "
                          "accountantcode FROM previous_accounts")
    if step == "3":
        return with_views(["appbillingproposal"], [], "SELECT " + ", ".join(
            f"upper(trim({c})) AS {c}" if c in ("item", "environment") else f"trim({c}) AS {c}"
            for c in APP_BILLING_COLUMNS) + " FROM appbillingproposal")
    if step == "4":
        return with_views(["accounts"], [], "SELECT * REPLACE (CASE WHEN environment = 'GB' THEN 'UK' "
                          "ELSE environment END AS environment) FROM accounts")
    if step == "5":
        return with_views(["appbillingproposal"], [], "SELECT * REPLACE (TRY_CAST(meta_isdeleted AS BOOLEAN) AS "
                          "meta_isdeleted) FROM appbillingproposal WHERE meta_load_enddts IS NULL "
                          "AND NOT TRY_CAST(meta_isdeleted AS BOOLEAN)")
    if step == "6":
        return with_views(["snapshot"], [], "SELECT contractnumber, CASE WHEN TRY_CAST(cancellationdate AS DATE) <> "
                          "DATE '9999-12-31' THEN TRY_CAST(cancellationdate AS DATE) END AS cancellationdate "
                          "FROM snapshot")
    if step == "7":
        keep = [c for c in APP_USAGE_COLUMNS if c not in METADATA]
        return with_views(["monthlyappusage"], [], f"SELECT {', '.join(keep)} FROM monthlyappusage")
    if step == "8":
        return with_views(["contracts", "accounts", "linkedaccountantlog"], PREPARED,
                          "SELECT environment, accountcode, itemcode, contracttype, eventtype, inflowoutflow FROM c")
    if step == "9":
        return with_views(["snapshot"], [], "SELECT upper(trim(environment)) AS environment, upper(trim(code)) AS code, "
                          "upper(trim(accountantcode)) AS accountantcode, TRY_CAST(trim(accountantorlinked) AS BOOLEAN) "
                          "AS accountantorlinked, TRY_CAST(trim(meta_isdeleted) AS BOOLEAN) AS meta_isdeleted "
                          "FROM snapshot")
    if step == "10":
        return with_views(["contracts"], [], "SELECT contractnumber, eventdate, last_day(eventdate - INTERVAL 1 MONTH) "
                          "AS prevmonthend, last_day(eventdate) AS monthend FROM contracts")
    raise KeyError(step)
