"""DuckDB oracle SQL for the contract activity timeline (ADC), in the literal
shape of the original job: row_number picks, a range join for the package
back-fill and a positional union.  The per-day package candidate (arbitrary in
the original) is the largest lower-cased item, as in the operator."""

from __future__ import annotations

import datetime as _dt

from ledgerlens.plans.fixtures import AS_OF, LINK_CUTOFF, with_views
from ledgerlens.plans.oracle_summary import SUMMARY_VIEWS, d, summary_ctes


def _adc_ctes(cutoff: _dt.date) -> list[tuple[str, str]]:
    C = d(cutoff)
    return [
        ("fl", """SELECT environment, accountcode, date, linkstatus FROM (
              SELECT trim(environment) AS environment, accountcode, linkstatus, date,
                     row_number() OVER (PARTITION BY trim(environment), accountcode, linkstatus ORDER BY date NULLS FIRST) AS rn
              FROM linkedaccountantlog WHERE linkstatus = 'Accountant Linked') t WHERE rn = 1"""),
        ("bj", """SELECT s.environment, s.accountcode, s.firstcommstartdate, s.hadcommcontract,
              s.datefirstlinkedtoaccountant, a.entrepreneuraccountantlinked, a.accountid, fl.linkstatus, fl.date
            FROM summary s JOIN accounts a ON s.accountcode = a.accountcode AND s.environment = a.environment
            LEFT JOIN fl ON s.accountcode = fl.accountcode AND s.environment = fl.environment"""),
        ("bfa", f"""SELECT bj.*,
              CASE WHEN entrepreneuraccountantlinked = 'EntrepreneurWithAccountant' THEN 1 ELSE 0 END AS accountantlinked,
              CASE WHEN entrepreneuraccountantlinked = 'EntrepreneurWithAccountant' AND firstcommstartdate >= {C}
                        AND linkstatus = 'Accountant Linked' THEN date
                   WHEN entrepreneuraccountantlinked = 'EntrepreneurWithAccountant' AND firstcommstartdate >= {C}
                        AND linkstatus IS NULL THEN firstcommstartdate
                   WHEN entrepreneuraccountantlinked = 'EntrepreneurWithoutAccountant' AND firstcommstartdate >= {C}
                        AND linkstatus = 'Accountant Linked' THEN date
                   WHEN firstcommstartdate <= {C} AND linkstatus = 'Accountant Linked' THEN date
              END AS datefirstlinkedtoaccountantz
            FROM bj"""),
        ("ev4", """SELECT * FROM contracts
            WHERE inflowoutflow = 'Inflow' OR (inflowoutflow = 'Outflow' AND eventtype = 'PRC')"""),
        ("ev", """SELECT environment, accountcode, eventdate, eventtype, packagecode, linepackage FROM ev4
            WHERE linepackage = CASE WHEN eventtype IN ('TN', 'CN', 'CT', 'CDN', 'CUP') THEN 1 ELSE 0 END"""),
        ("feat", """SELECT environment, accountcode, eventdate,
              CAST(sum(u) OVER w AS BIGINT) AS numberofusers,
              CAST(sum(ad) OVER w AS BIGINT) AS numberofadministrations,
              CAST(sum(v) OVER w AS BIGINT) AS valuepermonth
            FROM (SELECT environment, accountcode, eventdate, sum(CAST(numberofusers AS BIGINT)) AS u,
                         sum(CAST(numberofadministrations AS BIGINT)) AS ad,
                         sum(CAST(trunc(valuepermonth) AS BIGINT)) AS v
                  FROM contracts GROUP BY environment, accountcode, eventdate) x
            WINDOW w AS (PARTITION BY environment, accountcode ORDER BY eventdate NULLS FIRST)"""),
        ("cs", """SELECT DISTINCT ev.*, feat.numberofusers, feat.valuepermonth, feat.numberofadministrations
            FROM ev LEFT JOIN feat ON ev.accountcode = feat.accountcode AND ev.environment = feat.environment
              AND ev.eventdate = feat.eventdate"""),
        ("od", """SELECT cs.*, b.datefirstlinkedtoaccountant, b.datefirstlinkedtoaccountantz, b.accountantlinked AS al,
              b.accountid, b.hadcommcontract
            FROM cs LEFT JOIN bfa b ON cs.accountcode = b.accountcode AND cs.environment = b.environment"""),
        # without a link date the account's flag, else whether the link date has come
        ("od2", """SELECT od.*, CASE WHEN al IS NULL THEN NULL WHEN datefirstlinkedtoaccountantz IS NULL THEN al
              ELSE CAST(datefirstlinkedtoaccountantz <= eventdate AS INTEGER) END AS accountantlinked FROM od"""),
        ("nl0", """SELECT * FROM od2 WHERE eventdate <= datefirstlinkedtoaccountant
              AND datefirstlinkedtoaccountant IS NOT NULL AND hadcommcontract = 1"""),
        ("nl1", """SELECT b.environment, b.accountcode, b.accountid, b.datefirstlinkedtoaccountant,
              b.datefirstlinkedtoaccountantz, n.eventdate AS ed, n.packagecode,
              n.numberofadministrations AS adm, n.numberofusers AS usr, n.valuepermonth AS vpm
            FROM bfa b LEFT JOIN nl0 n ON n.accountcode = b.accountcode AND n.environment = b.environment
            WHERE b.datefirstlinkedtoaccountant IS NOT NULL AND b.hadcommcontract = 1"""),
        ("nl2", """SELECT environment, accountcode, accountid, datefirstlinkedtoaccountant, datefirstlinkedtoaccountantz,
              packagecode,
              CASE WHEN adm IS NULL AND usr IS NULL AND vpm IS NULL THEN datefirstlinkedtoaccountant END AS eventdate,
              CAST(COALESCE(adm, 0) AS BIGINT) AS numberofadministrations,
              CAST(COALESCE(usr, 0) AS BIGINT) AS numberofusers,
              CAST(COALESCE(vpm, 0) AS BIGINT) AS valuepermonth
            FROM nl1"""),
        ("nl3", """SELECT environment, accountcode, accountid, datefirstlinkedtoaccountant, datefirstlinkedtoaccountantz,
              eventdate, packagecode, 'LINK' AS eventtype, numberofusers, numberofadministrations, valuepermonth
            FROM (SELECT nl2.*, row_number() OVER (PARTITION BY environment, accountcode
                    ORDER BY eventdate ASC NULLS FIRST, valuepermonth ASC NULLS FIRST,
                             numberofadministrations ASC NULLS FIRST, numberofusers ASC NULLS FIRST,
                             packagecode DESC NULLS LAST, datefirstlinkedtoaccountantz DESC NULLS LAST,
                             accountid DESC NULLS LAST) AS rn
                  FROM nl2 WHERE valuepermonth IS NOT NULL) t WHERE rn = 1"""),
        ("ow", """SELECT environment, accountcode, eventdate, max(numberofusers) AS usersnew, max(packagecode) AS pcn,
              max(numberofadministrations) AS admnew, max(valuepermonth) AS vpmnew
            FROM od2 GROUP BY environment, accountcode, eventdate"""),
        ("nl4", """SELECT n.datefirstlinkedtoaccountantz AS eventdate, n.environment, n.accountcode,
              CASE WHEN ow.pcn IS NOT NULL THEN ow.pcn ELSE n.packagecode END AS packagecode,
              'LINK' AS eventtype, 1 AS accountantlinked,
              CASE WHEN ow.pcn IS NOT NULL THEN ow.usersnew ELSE n.numberofusers END AS numberofusers,
              CASE WHEN ow.admnew IS NOT NULL THEN ow.admnew ELSE n.numberofadministrations END AS numberofadministrations,
              CASE WHEN ow.pcn IS NOT NULL THEN ow.vpmnew ELSE n.valuepermonth END AS valuepermonth,
              n.accountid
            FROM nl3 n LEFT JOIN ow ON ow.accountcode = n.accountcode AND ow.environment = n.environment
              AND ow.eventdate = n.datefirstlinkedtoaccountantz"""),
        ("un0", """SELECT eventdate, environment, accountcode, packagecode, eventtype, accountantlinked, numberofusers,
              numberofadministrations, valuepermonth, accountid FROM od2
            UNION ALL SELECT * FROM nl4"""),
        ("un", """SELECT eventdate, environment, accountcode, packagecode, eventtype,
              CASE WHEN eventtype = 'TN' THEN 0 ELSE accountantlinked END AS accountantlinked,
              numberofusers, numberofadministrations, valuepermonth, accountid FROM un0"""),
        ("op", """SELECT environment, accountcode, eventdate AS joindate, itemcode FROM (
              SELECT environment, accountcode, eventdate, lower(itemcode) AS itemcode,
                     row_number() OVER (PARTITION BY environment, accountcode, eventdate
                                        ORDER BY lower(itemcode) DESC NULLS LAST) AS rn
              FROM contracts WHERE inflowoutflow = 'Inflow' AND linepackage = 1) t WHERE rn = 1"""),
        ("bf", """SELECT u.eventdate, u.environment, u.accountcode,
              lower(CASE WHEN u.packagecode IS NULL THEN op.itemcode ELSE u.packagecode END) AS packagecode,
              u.eventtype, u.accountantlinked, u.numberofusers, u.numberofadministrations, u.valuepermonth, u.accountid
            FROM un u LEFT JOIN op ON op.accountcode = u.accountcode AND op.environment = u.environment
              AND op.joindate < u.eventdate"""),
        ("bf1", """SELECT u.eventdate, u.environment, u.accountcode,
              lower(COALESCE(u.packagecode, (SELECT max(op.itemcode) FROM op WHERE op.accountcode = u.accountcode
                                               AND op.environment = u.environment AND op.joindate < u.eventdate)))
                AS packagecode,
              u.eventtype, u.accountantlinked, u.numberofusers, u.numberofadministrations, u.valuepermonth, u.accountid
            FROM un u"""),
        ("fin", """SELECT DISTINCT CAST(eventdate AS DATE) AS date, environment, accountcode, packagecode, eventtype,
              CAST(accountantlinked AS BOOLEAN) AS accountantorlinked, CAST(numberofusers AS BIGINT) AS numberofusers,
              CAST(numberofadministrations AS BIGINT) AS numberofadministrations, CAST(valuepermonth AS FLOAT) AS mrr,
              accountid
            FROM (SELECT bf.*, row_number() OVER (PARTITION BY environment, accountcode, eventdate, eventtype
                    ORDER BY valuepermonth ASC NULLS FIRST, numberofadministrations ASC NULLS FIRST,
                             numberofusers ASC NULLS FIRST, packagecode DESC NULLS LAST,
                             accountantlinked DESC NULLS LAST, accountid DESC NULLS LAST) AS rn
                  FROM bf) t WHERE rn = 1"""),
    ]


ADC_FINAL = {
    "1": "SELECT * FROM fl",
    "2": "SELECT * FROM bj",
    "3": "SELECT * FROM bfa",
    "4": "SELECT environment, accountcode, eventdate, eventtype, packagecode, linepackage FROM ev4",
    "5": "SELECT * FROM ev",
    "6": "SELECT * FROM feat",
    "7": "SELECT * FROM cs",
    "8": "SELECT * EXCLUDE (al) FROM od",
    "9": "SELECT * EXCLUDE (al) FROM od2",
    "10": "SELECT * FROM nl3",
    "11": "SELECT * FROM nl4",
    "12": "SELECT * FROM un0",
    "13": "SELECT * FROM un",
    "14": "SELECT * FROM bf1",
    "15": "SELECT * FROM fin",
}


def adc_sql(step: str, as_of: _dt.date = AS_OF, cutoff: _dt.date = LINK_CUTOFF) -> str:
    return with_views(SUMMARY_VIEWS, summary_ctes(as_of, LINK_CUTOFF) + _adc_ctes(cutoff), ADC_FINAL[step])
