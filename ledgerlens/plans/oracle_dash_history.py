"""DuckDB oracle SQL for the dashboard (NAD) and the contract history (CPH).

Both are written in the literal shape of the original jobs: a theta join of
accounts with the calendar and a userid-only join of activity (NAD), and
window sums / lag / row_number over the joined lines (CPH).
"""

from __future__ import annotations

import datetime as _dt

from ledgerlens.plans.fixtures import AS_OF, LINK_CUTOFF, with_views
from ledgerlens.plans.oracle_summary import SUMMARY_VIEWS, d, months_between_sql, summary_ctes

# The classifications shown on the dashboard.
CLASSES = "('EOL', 'ACC', 'AC7', 'JB0', 'AC1', 'EO1', 'AC8')"


def _nad_ctes(as_of: _dt.date, classified: bool, on_date: bool) -> list[tuple[str, str]]:
    A = d(as_of)
    Y = d(as_of - _dt.timedelta(days=1))
    cls = f"AND a.accountclassificationcode IN {CLASSES}" if classified else ""
    act_on = "ad.userid = u.userid" + (" AND ad.date = sp.calendardate" if on_date else "")
    return [
        ("ds", f"""SELECT min(m) AS date_since FROM (
              SELECT CAST(date_trunc('month', calendardate) AS DATE) AS m FROM calendar) x
            WHERE {months_between_sql(A, 'm')} <= 3"""),
        ("ad", """SELECT environment, userid, date, CAST(sum(quantity) AS BIGINT) AS sumquantity FROM activitydaily
            WHERE activityid = 1 AND date >= (SELECT date_since FROM ds) GROUP BY environment, userid, date"""),
        ("sp", f"""SELECT s.accountid, s.accountcode, s.environment, cc.calendardate, a.accountclassificationcode
            FROM summary s
            JOIN accounts a ON s.accountid = a.accountid
            JOIN calendar cc ON cc.calendardate BETWEEN (SELECT date_since FROM ds) AND {Y}
              AND cc.calendardate BETWEEN s.firstcommstartdate
                  AND (CASE WHEN s.churned = 1 THEN s.latestcommfinaldate ELSE {A} END)
            WHERE true {cls}"""),
        ("pv", f"""SELECT sp.accountid, sp.accountcode, sp.environment, sp.calendardate,
              CAST(sum(ad.sumquantity) AS BIGINT) AS pageviews
            FROM sp JOIN users u ON sp.accountid = u.accountid
            LEFT JOIN ad ON {act_on}
            GROUP BY sp.accountid, sp.accountcode, sp.environment, sp.calendardate"""),
        ("nad", """SELECT accountid, accountcode, environment, calendardate,
              CAST(pageviews AS BIGINT) AS pageviewquantity,
              CASE WHEN pageviews IS NULL THEN 0 ELSE 1 END AS activeornot,
              environment || accountcode AS enviroaccount FROM pv"""),
    ]


NAD_FINAL = {"1": "SELECT * FROM ds", "2": "SELECT * FROM ad", "3": "SELECT * FROM sp", "4": "SELECT * FROM sp",
             "5": "SELECT * FROM pv", "ALL": "SELECT * FROM nad"}


def nad_sql(step: str, as_of: _dt.date = AS_OF, on_date: bool = False) -> str:
    views = SUMMARY_VIEWS + ["calendar", "activitydaily", "users"]
    ctes = summary_ctes(as_of, LINK_CUTOFF) + _nad_ctes(as_of, classified=(step != "3"), on_date=on_date)
    return with_views(views, ctes, NAD_FINAL[step])


def _cph_ctes(as_of: _dt.date) -> list[tuple[str, str]]:
    A = d(as_of)
    return [
        # every column of the four inputs is trimmed
        ("hc", """SELECT * REPLACE (upper(trim(environment)) AS environment, trim(accountcode) AS accountcode,
              trim(eventtype) AS eventtype, trim(itemcode) AS itemcode, trim(contracttype) AS contracttype) FROM contracts"""),
        ("het", """SELECT upper(trim(environment)) AS environment, trim(contracteventtypecode) AS code,
              trim(contracteventdescription) AS contracteventdescription FROM contracteventtypes"""),
        ("hic", """SELECT upper(trim(environment)) AS environment, trim(itemcode) AS code,
              trim(itemdescription) AS itemdescription FROM itemclassifications"""),
        ("hs", """SELECT upper(trim(environment)) AS environment, trim(accountcode) AS accountcode,
              trim(accountid) AS accountid FROM summary"""),
        ("base", """SELECT hs.accountid, hc.environment, hc.accountcode, hc.eventdate, het.contracteventdescription,
              hic.itemdescription, CAST(CASE WHEN hc.eventtype = 'PI' THEN 0 ELSE hc.linepackage END AS INTEGER) AS linepackage,
              hc.contracttype, hc.quantity, hc.valuepermonth
            FROM hc
            JOIN hs ON hc.environment = hs.environment AND hc.accountcode = hs.accountcode
            JOIN het ON hc.environment = het.environment AND hc.eventtype = het.code
            JOIN hic ON hc.environment = hic.environment AND hc.itemcode = hic.code
            WHERE hs.accountid IS NOT NULL"""),
        ("h", """SELECT accountid, environment, accountcode, eventdate, contracteventdescription, itemdescription, linepackage,
              CAST(sum(quantity) OVER (PARTITION BY environment, accountcode, eventdate, contracteventdescription,
                                                   itemdescription) AS DOUBLE) AS quantity,
              CAST(sum(CASE WHEN contracttype = 'C' THEN valuepermonth ELSE 0 END) OVER (
                PARTITION BY environment, accountcode ORDER BY eventdate NULLS FIRST
                RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS summrr
            FROM base"""),
        ("p2", """SELECT accountid, eventdate, linepackage, summrr,
              contracteventdescription || ' | ' || itemdescription || ' | Quantity ' || CAST(quantity AS VARCHAR)
                AS description FROM h"""),
        ("p3", """SELECT DISTINCT accountid, CAST(eventdate - INTERVAL 1 DAY AS DATE) AS eventdate,
              CAST(NULL AS INTEGER) AS linepackage,
              lag(summrr, 1, 0) OVER (PARTITION BY accountid ORDER BY eventdate NULLS FIRST) AS summrr,
              CAST(NULL AS VARCHAR) AS description FROM h"""),
        ("p4", f"""SELECT accountid, CASE WHEN eventdate >= {A} THEN eventdate ELSE {A} END AS eventdate,
              CAST(NULL AS INTEGER) AS linepackage, summrr, CAST(NULL AS VARCHAR) AS description
            FROM (SELECT accountid, eventdate, summrr,
                    row_number() OVER (PARTITION BY accountid ORDER BY eventdate DESC NULLS LAST) AS rn FROM h) t
            WHERE rn = 1"""),
    ]


CPH_FINAL = {
    "1": "SELECT * FROM h",
    "2": "SELECT * FROM p2",
    "3": "SELECT * FROM p3",
    "4": "SELECT * FROM p4",
    "ALL": "SELECT * FROM p2 UNION ALL SELECT * FROM p3 UNION ALL SELECT * FROM p4",
}


def cph_sql(step: str, as_of: _dt.date = AS_OF) -> str:
    views = SUMMARY_VIEWS + ["contracteventtypes", "itemclassifications"]
    return with_views(views, summary_ctes(as_of, LINK_CUTOFF) + _cph_ctes(as_of), CPH_FINAL[step])
