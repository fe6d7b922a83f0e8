"""DuckDB oracle SQL for the account contract summary (ACS-1 ... ACS-14).

Written independently of the Spark operators, in the step-wise shape of the
original jobs: window ``row_number() = 1`` picks and left joins.  The
deterministic tie-breaks match the operators' documented ones.
"""

from __future__ import annotations

import datetime as _dt

from ledgerlens.plans.fixtures import AS_OF, LINK_CUTOFF, with_views

STEP_COLUMNS = {
    1: ["environment", "accountcode", "accountid"],
    2: ["firsttrialstartdate", "firsttrialfinaldate", "firsttrialpackage"],
    3: ["firstcommstartdate", "firstcommfinaldate", "firstcommpackage"],
    4: ["hadtrial", "hadcommcontract"],
    5: ["latestcommpackage"],
    6: ["latestcommstartdate", "latestcommfinaldate"],
    7: ["latesttrialpackage"],
    8: ["latesttrialstartdate", "latesttrialfinaldate"],
    9: ["commlifetimemonths"],
    10: ["latestmrr"],
    11: ["latestnumberofavailableadmins", "latestnumberofarchivedadmins", "latestnumberofusers",
         "latestnumberpayingusers", "latestnumberfreeusers"],
    12: ["fullcancellationrequestdate", "requestedfullcancellation"],
    13: ["maxfinaldate", "churned"],
    14: ["accountantlinked", "datefirstlinkedtoaccountant"],
}


def d(x: _dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def months_between_sql(b: str, a: str) -> str:
    """Spark's fractional ``months_between(b, a)`` for DATE arguments."""
    return (f"((year({b}) - year({a})) * 12 + month({b}) - month({a}) + "
            f"CASE WHEN day({a}) = day({b}) OR ({a} = last_day({a}) AND {b} = last_day({b})) THEN 0 "
            f"ELSE (day({b}) - day({a})) / 31.0 END)")


PREPARED = [
    ("c", """SELECT * REPLACE (upper(trim(itemcode)) AS itemcode, upper(trim(environment)) AS environment,
        trim(accountcode) AS accountcode, upper(trim(contracttype)) AS contracttype,
        upper(trim(eventtype)) AS eventtype, trim(inflowoutflow) AS inflowoutflow) FROM contracts"""),
    ("a", """SELECT * REPLACE (trim(accountcode) AS accountcode, upper(trim(environment)) AS environment)
        FROM accounts"""),
    ("lg", "SELECT * REPLACE (upper(trim(environment)) AS environment) FROM linkedaccountantlog"),
]


def summary_ctes(as_of: _dt.date = AS_OF, cutoff: _dt.date = LINK_CUTOFF, grouping: str = "code",
                 method: str = "between", pick: str = "latest") -> list[tuple[str, str]]:
    A = d(as_of)
    C = d(cutoff)
    trial_base = "contracttype = 'T' AND linepackage = 1 AND eventtype IN ('TN', 'PI')"
    comm_base = "contracttype = 'C' AND linepackage = 1"
    lc_group = "itemcode, finaldate, eventdate" if grouping == "code" else "itemcode, finaldate"
    end = f"CASE WHEN r.latestcommfinaldate > {A} THEN {A} ELSE r.latestcommfinaldate END"
    if method == "between":
        life = (f"CASE WHEN r.hadcommcontract = 1 THEN COALESCE(CAST(trunc("
                f"{months_between_sql(end, 'r.firstcommstartdate')}) AS INTEGER), 0) ELSE 0 END")
    else:
        life = (f"CASE WHEN r.hadcommcontract = 1 THEN CAST((year({end}) - year(r.firstcommstartdate)) * 12 "
                f"+ month({end}) - month(r.firstcommstartdate) AS INTEGER) ELSE 0 END")
    link_order = "date DESC NULLS LAST" if pick == "latest" else "date ASC NULLS FIRST"
    return PREPARED + [
        ("s1", "SELECT DISTINCT c.environment, c.accountcode, a.accountid FROM c "
               "JOIN a ON c.environment = a.environment AND c.accountcode = a.accountcode"),
        ("ft_pick", f"""SELECT environment, accountcode, itemcode AS firsttrialpackage FROM (
            SELECT environment, accountcode, itemcode, row_number() OVER (PARTITION BY environment, accountcode
              ORDER BY eventdate ASC NULLS FIRST, itemcode ASC NULLS FIRST) AS rn
            FROM c WHERE {trial_base} AND inflowoutflow = 'Inflow' AND eventdate <= {A}) t WHERE rn = 1"""),
        ("ft", f"""SELECT g.environment, g.accountcode, g.firsttrialstartdate, g.firsttrialfinaldate, p.firsttrialpackage
            FROM (SELECT environment, accountcode, min(startdate) AS firsttrialstartdate,
                         min(finaldate) AS firsttrialfinaldate
                  FROM c WHERE {trial_base} GROUP BY environment, accountcode) g
            LEFT JOIN ft_pick p ON g.environment = p.environment AND g.accountcode = p.accountcode"""),
        ("fc_pick", f"""SELECT environment, accountcode, itemcode AS firstcommpackage FROM (
            SELECT environment, accountcode, itemcode, row_number() OVER (PARTITION BY environment, accountcode
              ORDER BY eventdate ASC NULLS FIRST, itemcode ASC NULLS FIRST) AS rn
            FROM c WHERE {comm_base} AND inflowoutflow = 'Inflow' AND eventdate <= {A}) t WHERE rn = 1"""),
        ("fc", f"""SELECT g.environment, g.accountcode, g.firstcommstartdate, g.firstcommfinaldate, p.firstcommpackage
            FROM (SELECT environment, accountcode, min(startdate) AS firstcommstartdate,
                         min(finaldate) AS firstcommfinaldate
                  FROM c WHERE {comm_base} GROUP BY environment, accountcode) g
            LEFT JOIN fc_pick p ON g.environment = p.environment AND g.accountcode = p.accountcode"""),
        ("lc", f"""SELECT environment, accountcode, itemcode AS latestcommpackage FROM (
            SELECT environment, accountcode, itemcode, row_number() OVER (PARTITION BY environment, accountcode
              ORDER BY finaldate DESC NULLS LAST, q DESC NULLS LAST, itemcode DESC NULLS LAST) AS rn
            FROM (SELECT environment, accountcode, {lc_group}, sum(quantity) AS q FROM c
                  WHERE {comm_base} AND eventdate <= {A}
                  GROUP BY environment, accountcode, {lc_group}) g) t WHERE rn = 1"""),
        ("lcd", f"""SELECT environment, accountcode, itemcode AS latestcommpackage,
                max(startdate) AS latestcommstartdate, max(finaldate) AS latestcommfinaldate
            FROM c WHERE {comm_base} AND inflowoutflow = 'Inflow' AND eventdate <= {A}
            GROUP BY environment, accountcode, itemcode"""),
        ("lt", f"""SELECT environment, accountcode, itemcode AS latesttrialpackage FROM (
            SELECT environment, accountcode, itemcode, row_number() OVER (PARTITION BY environment, accountcode
              ORDER BY finaldate DESC NULLS LAST, q DESC NULLS LAST, itemcode DESC NULLS LAST) AS rn
            FROM (SELECT environment, accountcode, itemcode, finaldate, sum(quantity) AS q FROM c
                  WHERE {trial_base} AND eventdate <= {A}
                  GROUP BY environment, accountcode, itemcode, finaldate) g) t WHERE rn = 1"""),
        ("ltd", f"""SELECT environment, accountcode, itemcode AS latesttrialpackage,
                max(startdate) AS latesttrialstartdate, max(finaldate) AS latesttrialfinaldate
            FROM c WHERE contracttype = 'T' AND linepackage = 1 AND inflowoutflow = 'Inflow' AND eventdate <= {A}
            GROUP BY environment, accountcode, itemcode"""),
        ("mrr", f"""SELECT environment, accountcode, CAST(trunc(round(sum(valuepermonth), 2)) AS BIGINT) AS latestmrr
            FROM c WHERE eventdate <= {A} AND contracttype = 'C' GROUP BY environment, accountcode"""),
        ("ent", f"""SELECT environment, accountcode,
              CAST(sum(CASE WHEN itemcode <> 'EOL9950' THEN numberofadministrations ELSE 0 END) AS BIGINT)
                AS latestnumberofavailableadmins,
              CAST(sum(CASE WHEN itemcode = 'EOL9950' THEN numberofadministrations ELSE 0 END) AS BIGINT)
                AS latestnumberofarchivedadmins,
              CAST(sum(numberofusers) AS BIGINT) AS latestnumberofusers,
              CAST(sum(CASE WHEN valuepermonth <> 0 THEN numberofusers ELSE 0 END) AS BIGINT) AS latestnumberpayingusers,
              CAST(sum(CASE WHEN valuepermonth = 0 THEN numberofusers ELSE 0 END) AS BIGINT) AS latestnumberfreeusers
            FROM c WHERE finaldate >= {A} AND eventdate <= {A} GROUP BY environment, accountcode"""),
        ("fcx", """SELECT environment, accountcode, cancellationdate AS fullcancellationrequestdate,
              CASE WHEN cancellationdate IS NULL THEN 0 ELSE 1 END AS requestedfullcancellation FROM (
            SELECT environment, accountcode, cancellationdate, row_number() OVER (PARTITION BY environment, accountcode
              ORDER BY eventdate DESC NULLS LAST, contractnumber DESC NULLS LAST, cancellationdate DESC NULLS LAST) AS rn
            FROM c WHERE inflowoutflow = 'Inflow' AND linepackage = 1) t WHERE rn = 1"""),
        ("ch", f"""SELECT environment, accountcode, max(finaldate) AS maxfinaldate,
              CASE WHEN max(finaldate) > {A} THEN 0 ELSE 1 END AS churned
            FROM c GROUP BY environment, accountcode"""),
        ("lal", f"""SELECT environment, accountcode, linkstatus, date FROM (
            SELECT environment, accountcode, linkstatus, date,
                   row_number() OVER (PARTITION BY environment, accountcode ORDER BY {link_order}) AS rn
            FROM lg WHERE linkstatus = 'Accountant Linked') t WHERE rn = 1"""),
        ("r", f"""SELECT s1.environment, s1.accountcode, s1.accountid,
              ft.firsttrialstartdate, ft.firsttrialfinaldate, ft.firsttrialpackage,
              fc.firstcommstartdate, fc.firstcommfinaldate, fc.firstcommpackage,
              CASE WHEN ft.firsttrialpackage IS NOT NULL THEN 1 ELSE 0 END AS hadtrial,
              CASE WHEN fc.firstcommpackage IS NOT NULL THEN 1 ELSE 0 END AS hadcommcontract,
              lc.latestcommpackage, lcd.latestcommstartdate, lcd.latestcommfinaldate,
              lt.latesttrialpackage, ltd.latesttrialstartdate, ltd.latesttrialfinaldate
            FROM s1
            LEFT JOIN ft ON s1.environment = ft.environment AND s1.accountcode = ft.accountcode
            LEFT JOIN fc ON s1.environment = fc.environment AND s1.accountcode = fc.accountcode
            LEFT JOIN lc ON s1.environment = lc.environment AND s1.accountcode = lc.accountcode
            LEFT JOIN lcd ON s1.environment = lcd.environment AND s1.accountcode = lcd.accountcode
                          AND lc.latestcommpackage = lcd.latestcommpackage
            LEFT JOIN lt ON s1.environment = lt.environment AND s1.accountcode = lt.accountcode
            LEFT JOIN ltd ON s1.environment = ltd.environment AND s1.accountcode = ltd.accountcode
                          AND lt.latesttrialpackage = ltd.latesttrialpackage"""),
        ("r9", f"""SELECT r.*, {life} AS commlifetimemonths FROM r"""),
        ("r13", """SELECT r9.*, mrr.latestmrr,
              ent.latestnumberofavailableadmins, ent.latestnumberofarchivedadmins, ent.latestnumberofusers,
              ent.latestnumberpayingusers, ent.latestnumberfreeusers,
              fcx.fullcancellationrequestdate, fcx.requestedfullcancellation,
              ch.maxfinaldate, ch.churned
            FROM r9
            LEFT JOIN mrr ON r9.environment = mrr.environment AND r9.accountcode = mrr.accountcode
            LEFT JOIN ent ON r9.environment = ent.environment AND r9.accountcode = ent.accountcode
            LEFT JOIN fcx ON r9.environment = fcx.environment AND r9.accountcode = fcx.accountcode
            LEFT JOIN ch ON r9.environment = ch.environment AND r9.accountcode = ch.accountcode"""),
        ("la", f"""SELECT r.environment, r.accountcode,
              max(CASE WHEN trim(a.entrepreneuraccountantlinked) = 'EntrepreneurWithAccountant' THEN 1 ELSE 0 END)
                AS accountantlinked,
              max(CASE
                WHEN trim(a.entrepreneuraccountantlinked) = 'EntrepreneurWithAccountant'
                     AND r.firstcommstartdate >= {C} AND trim(l.linkstatus) = 'Accountant Linked' THEN l.date
                WHEN trim(a.entrepreneuraccountantlinked) = 'EntrepreneurWithAccountant'
                     AND r.firstcommstartdate >= {C} AND l.linkstatus IS NULL THEN r.firstcommstartdate
                WHEN trim(a.entrepreneuraccountantlinked) = 'EntrepreneurWithoutAccountant'
                     AND r.firstcommstartdate >= {C} AND trim(l.linkstatus) = 'Accountant Linked' THEN l.date
                END) AS datefirstlinkedtoaccountant
            FROM r13 r
            JOIN a ON r.environment = a.environment AND r.accountcode = a.accountcode
            LEFT JOIN lal l ON r.environment = l.environment AND r.accountcode = l.accountcode
            GROUP BY r.environment, r.accountcode"""),
        ("summary", """SELECT r13.*, la.accountantlinked, la.datefirstlinkedtoaccountant FROM r13
            LEFT JOIN la ON r13.environment = la.environment AND r13.accountcode = la.accountcode"""),
    ]


SUMMARY_VIEWS = ["contracts", "accounts", "linkedaccountantlog"]


def summary_sql(step: int = 14, **kw) -> str:
    cols = [c for s in range(1, step + 1) for c in STEP_COLUMNS[s]]
    return with_views(SUMMARY_VIEWS, summary_ctes(**kw), f"SELECT {', '.join(cols)} FROM summary")
