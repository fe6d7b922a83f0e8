"""DuckDB oracle SQL for the link log (LAL) and the monthly summary (ASM).

The monthly oracle joins the contracts to the month grid with the literal
window predicates (the way the original loop filtered each month), which is
independent of the operators' exploded month-ordinal formulation.
"""

from __future__ import annotations

import datetime as _dt

from ledgerlens.plans.fixtures import AS_OF, INGESTION_DAY, with_views
from ledgerlens.plans.oracle_summary import d, months_between_sql

# ---------------------------------------------------------------------------
# LAL
# ---------------------------------------------------------------------------


def _lal_ctes(as_of: _dt.date, day: _dt.date | None) -> list[tuple[str, str]]:
    where_day = (f"WHERE ingestionyear = {day.year} AND ingestionmonth = {day.month} AND ingestionday = {day.day}"
                 if day else "")
    return [
        ("cs", f"""SELECT upper(trim(environment)) AS environment, upper(trim(code)) AS code,
              trim(isaccountant) AS isaccountant, TRY_CAST(trim(accountantorlinked) AS BOOLEAN) AS accountantorlinked,
              upper(trim(accountantcode)) AS accountantcode, trim(meta_load_enddts) AS meta_load_enddts,
              TRY_CAST(trim(meta_isdeleted) AS BOOLEAN) AS meta_isdeleted
            FROM snapshot {where_day}"""),
        ("pa", """SELECT upper(trim(environment)) AS environment, upper(trim(accountcode)) AS accountcode,
              TRY_CAST(trim(accountantorlinked) AS BOOLEAN) AS accountantorlinked,
              upper(trim(accountantcode)) AS accountantcode
            FROM previous_accounts"""),
        ("l1", """SELECT DISTINCT CASE WHEN environment = 'GB' THEN 'UK' ELSE environment END AS environment,
              code AS accountcode, accountantorlinked, accountantcode
            FROM cs WHERE meta_load_enddts IS NULL AND meta_isdeleted = false AND isaccountant = 'Entrepreneur'"""),
        ("l2", """SELECT n.environment, n.accountcode, n.accountantorlinked AS newaccountantorlinked,
              p.accountantorlinked AS previousaccountantorlinked, n.accountantcode AS newaccountantcode,
              p.accountantcode AS previousaccountantcode
            FROM l1 n JOIN pa p ON n.environment = p.environment AND n.accountcode = p.accountcode
            WHERE p.accountantorlinked <> n.accountantorlinked OR p.accountantcode <> n.accountantcode"""),
        ("l3", f"""SELECT environment, accountcode,
              CASE WHEN newaccountantorlinked AND NOT previousaccountantorlinked THEN 'Accountant Linked'
                   WHEN NOT newaccountantorlinked AND previousaccountantorlinked THEN 'Accountant Link Removed'
                   WHEN newaccountantorlinked AND previousaccountantorlinked
                        AND newaccountantcode <> previousaccountantcode THEN 'Accountant Change' END AS linkstatus,
              {d(as_of - _dt.timedelta(days=1))} AS date, newaccountantcode, previousaccountantcode
            FROM l2"""),
    ]


def lal_sql(step: str, as_of: _dt.date = AS_OF) -> str:
    day = INGESTION_DAY if step == "ALL" else None
    final = {"1": "SELECT * FROM l1", "2": "SELECT * FROM l2", "3": "SELECT * FROM l3", "ALL": "SELECT * FROM l3"}
    return with_views(["snapshot", "previous_accounts"], _lal_ctes(as_of, day), final[step])


# ---------------------------------------------------------------------------
# ASM
# ---------------------------------------------------------------------------


def _asm_ctes(as_of: _dt.date, start: int, end: int) -> list[tuple[str, str]]:
    first = d(as_of.replace(day=1))
    return [
        ("g", f"""SELECT CAST(year(e) * 100 + month(e) AS INTEGER) AS yearmonth, e AS monthend, p AS prevmonthend FROM (
              SELECT last_day({first} + to_months(CAST(i - 1 AS INTEGER))) AS e,
                     last_day({first} + to_months(CAST(i - 2 AS INTEGER))) AS p
              FROM range({end + 1}, {start + 1}) t(i)) x"""),
        ("ovl", """SELECT c.*, g.yearmonth, g.monthend, g.prevmonthend FROM contracts c
            JOIN g ON c.startdate <= g.monthend AND c.finaldate >= g.prevmonthend"""),
        ("act", "SELECT * FROM ovl WHERE eventdate <= monthend"),
        ("pk", """SELECT environment, accountcode, itemcode, contracttype, contractnumber, yearmonth,
              CAST(sum(quantity) AS BIGINT) AS quantity
            FROM act WHERE linepackage = 1
            GROUP BY environment, accountcode, itemcode, contracttype, contractnumber, yearmonth"""),
        ("pk1", """SELECT environment, accountcode, itemcode, contracttype, contractnumber, quantity, accountid, yearmonth
            FROM (SELECT pk.*, a.accountid, row_number() OVER (
                    PARTITION BY pk.environment, pk.accountcode, pk.yearmonth
                    ORDER BY pk.quantity DESC NULLS LAST, pk.contracttype ASC NULLS FIRST, pk.itemcode ASC NULLS FIRST,
                             pk.contractnumber ASC NULLS FIRST, a.accountid ASC NULLS FIRST) AS rn
                  FROM pk JOIN accounts a ON pk.environment = a.environment AND pk.accountcode = a.accountcode) t
            WHERE rn = 1"""),
        ("tot", """SELECT environment, accountcode, contractnumber, yearmonth,
              CAST(sum(CASE WHEN itemcode = 'EOL9950' AND eventtype <> 'CFC' THEN numberofadministrations ELSE 0 END) AS BIGINT)
                AS numberofarchivedadmins,
              CAST(sum(CASE WHEN itemcode <> 'EOL9950' AND eventtype <> 'CFC' THEN numberofadministrations ELSE 0 END) AS BIGINT)
                AS numberofavailableadmins,
              CAST(sum(CASE WHEN valuepermonth <> 0 THEN (CASE WHEN eventtype <> 'CFC' THEN numberofusers ELSE 0 END)
                       ELSE 0 END) AS BIGINT) AS numberofpayingusers,
              CAST(sum(CASE WHEN valuepermonth = 0 THEN (CASE WHEN eventtype <> 'CFC' THEN numberofusers ELSE 0 END)
                       ELSE 0 END) AS BIGINT) AS numberoffreeusers,
              sum(CASE WHEN eventtype <> 'CFC' THEN valuepermonth ELSE 0 END) AS mrr,
              CAST(sum(CASE WHEN eventtype <> 'CFC' THEN numberofusers ELSE 0 END) AS BIGINT) AS numberofusers
            FROM act GROUP BY environment, accountcode, contractnumber, yearmonth"""),
        ("pkt", """SELECT pk1.*, tot.numberofarchivedadmins, tot.numberofavailableadmins, tot.numberofpayingusers,
              tot.numberoffreeusers, tot.mrr, tot.numberofusers
            FROM pk1 LEFT JOIN tot ON pk1.environment = tot.environment AND pk1.accountcode = tot.accountcode
              AND pk1.contractnumber = tot.contractnumber AND pk1.yearmonth = tot.yearmonth"""),
        ("life", f"""SELECT c.environment, c.accountcode, g.yearmonth,
              CAST(floor({months_between_sql('g.monthend', 'min(c.startdate)')}) AS BIGINT) AS commerciallifetimemonths
            FROM contracts c JOIN g ON c.startdate <= g.monthend
            WHERE c.linepackage = 1 AND trim(c.contracttype) = 'C' AND c.inflowoutflow = 'Inflow'
            GROUP BY c.environment, c.accountcode, g.yearmonth, g.monthend"""),
        ("churn", """SELECT environment, accountcode, contracttype, contractnumber, yearmonth,
              max(CASE WHEN finaldate <= monthend AND eventtype IN ('CFC', 'TFC') THEN 1 ELSE 0 END) AS churned
            FROM ovl WHERE linepackage = 1
            GROUP BY environment, accountcode, contracttype, contractnumber, yearmonth"""),
        ("monthly", """SELECT t.environment, t.accountcode, t.itemcode AS packagecode, t.contracttype, t.contractnumber,
              t.quantity, t.accountid, t.yearmonth, t.numberofarchivedadmins, t.numberofavailableadmins,
              t.numberofpayingusers, t.numberoffreeusers, t.mrr, t.numberofusers, life.commerciallifetimemonths,
              churn.churned, CAST(t.yearmonth // 100 AS VARCHAR) AS year, CAST(t.yearmonth % 100 AS VARCHAR) AS month
            FROM pkt t
            LEFT JOIN life ON t.environment = life.environment AND t.accountcode = life.accountcode
              AND t.yearmonth = life.yearmonth
            LEFT JOIN churn ON t.environment = churn.environment AND t.accountcode = churn.accountcode
              AND t.contracttype = churn.contracttype AND t.contractnumber = churn.contractnumber
              AND t.yearmonth = churn.yearmonth"""),
    ]


ASM_FINAL = {
    "1": """SELECT environment, accountcode, contractnumber, itemcode, eventtype, yearmonth, monthend, prevmonthend,
              COALESCE(eventdate <= monthend, false) AS active FROM ovl""",
    "2": "SELECT * FROM pk1",
    "3": """SELECT *, CAST(yearmonth // 100 AS VARCHAR) AS year, CAST(yearmonth % 100 AS VARCHAR) AS month FROM pk1""",
    "4": "SELECT * FROM tot",
    "5": "SELECT * FROM pkt",
    "6": "SELECT * FROM life",
    "7": "SELECT * FROM churn",
    "ALL": "SELECT * FROM monthly",
}


def asm_sql(step: str, as_of: _dt.date = AS_OF, start: int = 0, end: int = -6) -> str:
    return with_views(["contracts", "accounts"], _asm_ctes(as_of, start, end), ASM_FINAL[step])
