"""Column-level building blocks (all native Catalyst expressions, no Python UDFs)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "KEYS",
    "as_date",
    "blank_key_fields",
    "account_hash",
    "profile_url",
    "card_url",
    "environment_uk",
    "month_end",
    "lenient_integer",
]

# The natural key of every per-account table.
KEYS = ["environment", "accountcode"]


def as_date(value) -> Column:
    """A DATE literal from a ``datetime.date``, an ISO string or an existing Column."""
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, _dt.date):
        value = value.isoformat()
    return F.to_date(F.lit(value))


def environment_uk(c: Column | str = "environment") -> Column:
    """NRM-4: the site code ``GB`` is published as ``UK``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == "GB", F.lit("UK")).otherwise(c)


# A plain decimal number: sign, digits, at most one point (no exponent, no type suffix).
_DECIMAL = r"\A[\x09-\x0D\x20]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)[\x09-\x0D\x20]*\z"


def lenient_integer(c: Column | str, kind: str = "int") -> Column:
    """Integer cast of text that also accepts ``'5.0'``; other text becomes NULL.

    Under ANSI ``cast('5.0' as int)`` raises and ``try_cast`` gives NULL, while the
    non-ANSI cast the jobs were written against drops the fraction.  The digits before
    the point are cast as they are, so a long keeps all of them; ``'1e3'`` and ``'5d'``
    are no integers; a value beyond the type is NULL.  Plain integers take the short way.
    """
    c = F.col(c) if isinstance(c, str) else c
    whole = F.regexp_extract(F.trim(F.translate(c, "\t\n\x0b\x0c\r", "     ")), r"\A([+-]?[0-9]*)", 1)
    digits = F.when(whole.isin("", "+", "-"), F.lit("0")).otherwise(whole)
    return F.coalesce(c.try_cast(kind), F.when(c.rlike(_DECIMAL), digits.try_cast(kind)))


def blank_key_fields(*cols: str) -> Column:
    """ACC-4: how many of the given key fields are NULL (an empty string is not blank)."""
    total = None
    for name in cols:
        term = F.col(name).isNull().cast("int")
        total = term if total is None else total + term
    return total if total is not None else F.lit(0)


def account_hash(c: Column | str, length: int = 28) -> Column:
    """ACC-5: lower(base64(sha1('{' + lower(id) + '}'))) cut to ``length`` characters.

    NULL id gives NULL.
    """
    c = F.col(c) if isinstance(c, str) else c
    braced = F.concat(F.lit("{"), F.lower(c), F.lit("}"))
    return F.substring(F.lower(F.base64(F.unhex(F.sha1(braced)))), 1, length)


def profile_url(c: Column | str, prefix: str, suffix: str = "%27") -> Column:
    """ACC-6: prefix + id + suffix (NULL id gives NULL)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit(prefix), c, F.lit(suffix))


def card_url(env: Column | str, account_id: Column | str, templates: Mapping[str, tuple[str, str]],
             default: str = "%7d") -> Column:
    """ACC-7: per-environment URL ``prefix + lower(id) + suffix``; other environments get ``default``."""
    env = F.col(env) if isinstance(env, str) else env
    account_id = F.col(account_id) if isinstance(account_id, str) else account_id
    expr = None
    for site, (prefix, suffix) in templates.items():
        value = F.concat(F.lit(prefix), F.lower(account_id), F.lit(suffix))
        expr = F.when(env == site, value) if expr is None else expr.when(env == site, value)
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def month_end(d, n: int | Column = 0) -> Column:
    """NRM-10: last day of the month ``n`` months after ``d``."""
    d = as_date(d) if not isinstance(d, Column) else d
    return F.last_day(F.add_months(d, n))
