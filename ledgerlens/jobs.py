"""The eight daily jobs, each with its reads and its write.

A job reads its tables by name through a reader (a catalogue database or a folder), takes the day or
``as_of`` explicitly, transforms with the operators, and writes Parquet under ``dest``, one folder for each table.
Intermediates live in a store of the job and go when its outputs are written.

An empty day leaves what was published: every job that reads a day's snapshot skips its outputs then.
The rows that decide it are counted by the write (:func:`sources.tables.write_if_nonempty`), so no plan
runs twice.  A job returns the names of the tables it published.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.operators import accounts as acc
from ledgerlens.operators import dashboard, history, links, loads, monthly, summary, timeline
from ledgerlens.session import JobStore
from ledgerlens.sources.tables import counted, read_ingestion_day, read_table, write_if_nonempty, write_month, write_table

__all__ = ["catalogue", "folder", "load_snapshot_tables", "load_raw_tables", "load_accounts", "monthly_summary", "contract_summary",
           "linked_accountant_log", "activity_dashboard", "contract_activity", "contract_history"]

Reader = Callable[[str], DataFrame]


def catalogue(spark: SparkSession, database: str) -> Reader:
    """Tables of a catalogue database."""
    return lambda name: read_table(spark, name, database=database)


def folder(spark: SparkSession, path: str) -> Reader:
    """Tables as Parquet folders or files under a path."""
    return lambda name: read_table(spark, path=f"{path}/{name}")


def load_snapshot_tables(read: Reader, dest: str, day: _dt.date) -> list[str]:
    """The eight tables of the day's snapshot (LOAD-0 to LOAD-8).  Reads ``contractstatistics``, ``users``."""
    snapshot = read("contractstatistics")
    with JobStore(snapshot.sparkSession, "snapshot") as store:
        tables = loads.load_all(snapshot, read("users"), day, store=store)
        if not store.rows["snapshot"]:
            return []
        for name, table in tables.items():
            write_table(table, f"{dest}/{name}")
    return list(tables)


def load_raw_tables(read: Reader, dest: str, day: _dt.date) -> list[str]:
    """App billing proposals, opportunities and app usage of the day (LOAD-9 to LOAD-11); each is
    skipped when its own day is empty.  Reads tables of the same names."""
    done = []
    for name, load in (("appbillingproposal", loads.load_app_billing), ("opportunities", loads.load_opportunities),
                       ("monthlyappusage", loads.load_app_usage)):
        raw, seen = counted(read_ingestion_day(read(name), day))
        if write_if_nonempty(load(raw), write_table, f"{dest}/{name}", seen=seen):
            done.append(name)
    return done


def load_accounts(read: Reader, dest: str, day: _dt.date, prefix: str, templates: dict) -> list[str]:
    """Domain accounts (ACC-8), skipped when there are none.  Reads ``contractstatistics``, ``crm_accounts``."""
    out = acc.load_accounts(read("contractstatistics"), read("crm_accounts"), prefix, templates, day)
    return ["accounts"] if write_if_nonempty(out, write_table, f"{dest}/accounts") else []


def monthly_summary(read: Reader, dest: str, as_of: _dt.date, start: int = 0, end: int = -6) -> list[str]:
    """Month partitions of the account summary (ASM-ALL).  Reads ``contracts``, ``accounts``."""
    write_month(monthly.monthly_summary(read("contracts"), read("accounts"), as_of, start, end), f"{dest}/accountsummary_monthly")
    return ["accountsummary_monthly"]


def contract_summary(read: Reader, dest: str, as_of: _dt.date, **options) -> list[str]:
    """The account contract summary (ACS-ALL).  Reads ``contracts``, ``accounts``, ``linkedaccountantlog``."""
    write_table(summary.contract_summary(read("contracts"), read("accounts"), read("linkedaccountantlog"), as_of, **options),
                f"{dest}/accountscontract_summary")
    return ["accountscontract_summary"]


def linked_accountant_log(read: Reader, dest: str, as_of: _dt.date, day: _dt.date, **options) -> list[str]:
    """The day's partition of the link log (LAL-ALL); a day without changes is written as such.
    Reads ``contractstatistics``, ``previous_accounts``."""
    links.linked_accountant_log(read("contractstatistics"), read("previous_accounts"), as_of, day, dest=f"{dest}/linkedaccountantlog", **options)
    return ["linkedaccountantlog"]


def activity_dashboard(read: Reader, dest: str, as_of: _dt.date, **options) -> list[str]:
    """The dashboard feed (NAD-6).  Reads ``accountscontract_summary``, ``accounts``, ``users``, ``activitydaily``,
    ``config_calendar``."""
    write_table(dashboard.no_activity(read("accountscontract_summary"), read("accounts"), read("users"), read("activitydaily"),
                                      read("config_calendar"), as_of, **options), f"{dest}/noactivity_dashboard")
    return ["noactivity_dashboard"]


def contract_activity(read: Reader, dest: str, **options) -> list[str]:
    """The daily contract timeline (ADC-15).  Reads ``contracts``, ``linkedaccountantlog``,
    ``accountscontract_summary``, ``accounts``."""
    contracts = read("contracts")
    with JobStore(contracts.sparkSession, "activity") as store:
        write_table(timeline.contract_activity(contracts, read("linkedaccountantlog"), read("accountscontract_summary"), read("accounts"),
                                               store=store, **options), f"{dest}/activitydaily_contracts")
    return ["activitydaily_contracts"]


def contract_history(read: Reader, dest: str, as_of: _dt.date) -> list[str]:
    """The contract history feed (CPH-ALL).  Reads ``contracts``, ``accountscontract_summary``, ``contracteventtypes``,
    ``itemclassifications``."""
    contracts = read("contracts")
    with JobStore(contracts.sparkSession, "history") as store:
        write_table(history.contract_history(contracts, read("accountscontract_summary"), read("contracteventtypes"),
                                             read("itemclassifications"), as_of, store=store), f"{dest}/customerprofile_contracthistory")
    return ["customerprofile_contracthistory"]
