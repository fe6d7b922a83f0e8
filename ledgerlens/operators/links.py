"""Linked-accountant change log from two account states (LAL-1 ... LAL-ALL, NRM-9)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import KEYS, as_date, environment_uk
from ledgerlens.operators.normalize import cast_columns, clean_strings, current_records
from ledgerlens.sources.tables import append_log, read_ingestion_day

__all__ = ["prepare_link_inputs", "entrepreneur_links", "link_changes", "link_log", "linked_accountant_log",
           "LINKED", "LINK_REMOVED", "LINK_CHANGED"]

# Fixed status texts.
LINKED = "Accountant Linked"
LINK_REMOVED = "Accountant Link Removed"
LINK_CHANGED = "Accountant Change"


def prepare_link_inputs(snapshot: DataFrame, accounts: DataFrame, persist: bool = False):
    """NRM-9: clean (trim everything, upper the keys and accountant code) and type the flags."""
    snapshot = clean_strings(snapshot, upper=["environment", "code", "accountantcode"], all_columns=True)
    snapshot = cast_columns(snapshot, booleans=["meta_isdeleted", "accountantorlinked"])
    accounts = clean_strings(accounts, upper=["environment", "accountcode", "accountantcode"], all_columns=True)
    accounts = cast_columns(accounts, booleans=["accountantorlinked"])
    if persist:
        snapshot, accounts = snapshot.persist(), accounts.persist()
    return snapshot, accounts


def entrepreneur_links(snapshot: DataFrame) -> DataFrame:
    """LAL-1: current entrepreneur rows, distinct (environment, accountcode, flag, accountant code)."""
    cur = current_records(snapshot.withColumn("environment", environment_uk("environment")))
    return (cur.where(F.col("isaccountant") == "Entrepreneur")
            .select("environment", F.col("code").alias("accountcode"), "accountantorlinked", "accountantcode")
            .distinct())


def link_changes(new: DataFrame, previous: DataFrame, null_safe: bool = False) -> DataFrame:
    """LAL-2: accounts whose accountant flag or code differs from the previous state.

    With ``null_safe=False`` (the original) a NULL on either side never counts
    as a change; ``null_safe=True`` counts NULL <-> value as a change.
    """
    n, p = new.alias("n"), previous.alias("p")
    if null_safe:
        differs = (~F.col("p.accountantorlinked").eqNullSafe(F.col("n.accountantorlinked"))
                   | ~F.col("p.accountantcode").eqNullSafe(F.col("n.accountantcode")))
    else:
        differs = ((F.col("p.accountantorlinked") != F.col("n.accountantorlinked"))
                   | (F.col("p.accountantcode") != F.col("n.accountantcode")))
    return (n.join(p, [F.col(f"n.{k}") == F.col(f"p.{k}") for k in KEYS], "inner")
            .where(differs)
            .select(F.col("n.environment").alias("environment"), F.col("n.accountcode").alias("accountcode"),
                    F.col("n.accountantorlinked").alias("newaccountantorlinked"),
                    F.col("p.accountantorlinked").alias("previousaccountantorlinked"),
                    F.col("n.accountantcode").alias("newaccountantcode"),
                    F.col("p.accountantcode").alias("previousaccountantcode")))


def link_log(changes: DataFrame, as_of) -> DataFrame:
    """LAL-3: status of each change, dated the day before ``as_of``.

    Rows that match none of the three statuses are kept with a NULL status.
    """
    new, prev = F.col("newaccountantorlinked"), F.col("previousaccountantorlinked")
    status = (F.when(new & ~prev, F.lit(LINKED))
              .when(~new & prev, F.lit(LINK_REMOVED))
              .when(new & prev & (F.col("newaccountantcode") != F.col("previousaccountantcode")), F.lit(LINK_CHANGED)))
    return changes.select("environment", "accountcode", status.alias("linkstatus"),
                          F.date_sub(as_date(as_of), 1).alias("date"), "newaccountantcode", "previousaccountantcode")


def linked_accountant_log(snapshot: DataFrame, previous_accounts: DataFrame, as_of,
                          day: _dt.date | None = None, dest: str | None = None,
                          null_safe: bool = False) -> DataFrame:
    """LAL-ALL: read the day's snapshot partition, diff against the previous account
    state and (with ``dest``) write the day's log partition idempotently; the log as
    written is returned.

    Both states are explicit inputs; an empty partition yields an empty log, which replaces the
    day's earlier one.
    """
    if day is not None:
        snapshot = read_ingestion_day(snapshot, day)
    snap, prev = prepare_link_inputs(snapshot, previous_accounts)
    out = link_log(link_changes(entrepreneur_links(snap), prev, null_safe), as_of)
    if dest is None:
        return out
    yesterday = out.sparkSession.range(1).select(F.date_sub(as_date(as_of), 1).alias("d")).first()["d"]
    if not append_log(out, dest, day=yesterday):
        return out.sparkSession.createDataFrame([], out.schema)
    # one run of the plan: what is returned is read back
    return out.sparkSession.read.schema(out.schema).parquet(dest).where(F.col("date") == F.lit(yesterday)).select(*out.columns)
