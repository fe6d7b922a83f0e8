"""Accounts load (ACC-1 ... ACC-8)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import account_hash, blank_key_fields, card_url, environment_uk, profile_url
from ledgerlens.operators.normalize import cast_columns, clean_strings, current_records
from ledgerlens.sources.tables import read_ingestion_day

__all__ = ["exclude_codes", "latest_per_key", "enrich_accounts", "load_accounts", "DUMMY_CODES",
           "SNAPSHOT_ACCOUNT_COLUMNS", "CRM_COLUMNS", "KEY_FIELDS"]

# Fixed values.
DUMMY_CODES = ("162697700000000000",)
SNAPSHOT_ACCOUNT_COLUMNS = [
    "environment", "code", "account", "name", "isaccountant", "accountantorlinked", "entrepreneuraccountantlinked",
    "accountantcode", "chamberofcommerce", "vatnumber", "postcode", "city", "state", "country", "sectorcode",
    "subsectorcode", "compsizecode", "bustypecode", "accountclassificationcode", "accountmanagercode",
    "accountmanageraccountantcode", "resellercode", "leadsourcecode", "blocked",
]
CRM_COLUMNS = ["id", "dunsnumber", "syscreated", "sysmodified", "sbicode", "databaseid", "maincontact",
               "maindivision", "isanonymized", "leadpurpose", "anonymisationsource", "invoiceaccount"]
KEY_FIELDS = ["chamberofcommerce", "vatnumber", "postcode", "sectorcode", "compsizecode", "bustypecode"]


def exclude_codes(df: DataFrame, codes: Iterable[str] = DUMMY_CODES, column: str = "code") -> DataFrame:
    """ACC-1: drop the given account codes (a NULL code is dropped too)."""
    return df.where(~F.col(column).isin(*codes))


def latest_per_key(df: DataFrame, keys: list[str], order: str, columns: list[str] | None = None) -> DataFrame:
    """ACC-2: the row with the greatest ``order`` per key (ties: greatest remaining
    columns), as an aggregate of a struct led by ``order``."""
    columns = [c for c in (columns or df.columns) if c not in keys and c != order]
    best = df.groupBy(*keys).agg(F.max(F.struct(F.col(order).alias("_o"), *[F.col(c) for c in columns])).alias("_r"))
    return best.select(*keys, F.col("_r._o").alias(order), *[F.col(f"_r.{c}") for c in columns])


def enrich_accounts(snapshot: DataFrame, crm: DataFrame) -> DataFrame:
    """ACC-3: snapshot account columns LEFT JOIN the CRM account on ``account = id``
    (``invoiceaccount`` published as ``invoicedebtor``)."""
    c = crm.select(*CRM_COLUMNS).withColumnsRenamed({"id": "account", "invoiceaccount": "invoicedebtor"})
    return snapshot.select(*SNAPSHOT_ACCOUNT_COLUMNS).join(c, "account", "left")


def load_accounts(snapshot: DataFrame, crm: DataFrame, profile_prefix: str,
                  card_templates: Mapping[str, tuple[str, str]], day: _dt.date | None = None,
                  dummy_codes: Iterable[str] = DUMMY_CODES) -> DataFrame:
    """ACC-8: the accounts domain table.

    Current snapshot rows except the dummy code, latest per (environment, code)
    by ``lastmodified`` (before GB -> UK, so GB and UK rows stay apart), CRM
    attributes, blank key-field count, account hash and the two URLs.
    """
    if day is not None:
        snapshot = read_ingestion_day(snapshot, day)
    s = clean_strings(snapshot, upper=["environment"], all_columns=True)
    s = cast_columns(s, timestamps=["lastmodified"], booleans=["meta_isdeleted"])
    s = exclude_codes(current_records(s), dummy_codes)
    s = latest_per_key(s, ["environment", "code"], "lastmodified", SNAPSHOT_ACCOUNT_COLUMNS)
    df = enrich_accounts(s, crm)
    df = df.withColumns({
        "environment": environment_uk("environment"),
        "numberofblankkeyfields": blank_key_fields(*KEY_FIELDS),
        "accountidhash": account_hash("account"),
    }).withColumnsRenamed({"code": "accountcode", "account": "accountid"})
    df = cast_columns(df, timestamps=["syscreated", "sysmodified"], booleans=["blocked", "accountantorlinked"],
                      integers=["maindivision", "isanonymized", "anonymisationsource", "accountmanagercode",
                                "accountmanageraccountantcode"])
    return df.withColumns({
        "customerprofileurl": profile_url("accountid", profile_prefix),
        "eolcardurl": card_url("environment", "accountid", card_templates),
    })
