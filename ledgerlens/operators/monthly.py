"""Monthly account summary per account and month-end (ASM-1 ... ASM-ALL).

For month index ``i`` in ``range(start, end, -1)`` the reporting window is
END = last day of (the month before ``as_of``) + i months and PREV = the
month-end before END.  A contract line is ACTIVE in a month when
``startdate <= END and finaldate >= PREV and eventdate <= END``.

Instead of one plan per month (a driver loop scanning the contracts six
times) every line is exploded into the months it can touch, computed from
its own dates as a bounded integer ``sequence`` of month ordinals.  That is a
map-side Generate: no join with the month grid, no shuffle, at most
``start - end`` rows per line.  All months are then aggregated together with
the month as an extra grouping key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.columns import KEYS, as_date

__all__ = ["month_windows", "month_assignments", "monthly_package", "stamp_month", "monthly_totals",
           "attach_totals", "monthly_lifetime", "monthly_churn", "monthly_groups", "main_packages", "monthly_summary", "ARCHIVED_ITEM",
           "FULL_CANCELLATIONS", "MONTHLY_COLUMNS"]

ARCHIVED_ITEM = "EOL9950"
CANCELLED = "CFC"
FULL_CANCELLATIONS = ("CFC", "TFC")

MONTHLY_COLUMNS = ["environment", "accountcode", "packagecode", "contracttype", "contractnumber", "quantity",
                   "accountid", "yearmonth", "numberofarchivedadmins", "numberofavailableadmins",
                   "numberofpayingusers", "numberoffreeusers", "mrr", "numberofusers",
                   "commerciallifetimemonths", "churned", "year", "month"]


def _ord(d: Column) -> Column:
    """Month ordinal: year * 12 + month - 1."""
    return F.year(d) * 12 + F.month(d) - 1


def _month_end_of(ordinal: Column) -> Column:
    return F.last_day(F.make_date(F.floor(ordinal / 12).cast("int"), (ordinal % 12 + 1).cast("int"), F.lit(1)))


def _grid_bounds(as_of, start: int, end: int) -> tuple[Column, Column]:
    if start <= end:
        raise ValueError("start must be greater than end (months run backwards)")
    base = _ord(as_date(as_of)) - 1          # the month before as_of is index 0
    return base + (end + 1), base + start


def month_windows(spark: SparkSession, as_of, start: int = 0, end: int = -6) -> DataFrame:
    """ASM-1 grid: (yearmonth, monthend, prevmonthend) for each reporting month."""
    lo, hi = _grid_bounds(as_of, start, end)
    return (spark.range(1).select(F.explode(F.sequence(lo, hi)).alias("m"))
            .select(*_month_columns(F.col("m"))))


def _month_columns(m: Column) -> list[Column]:
    y = F.floor(m / 12).cast("int")
    mo = (m % 12 + 1).cast("int")
    return [(y * 100 + mo).alias("yearmonth"), _month_end_of(m).alias("monthend"),
            _month_end_of(m - 1).alias("prevmonthend")]


def month_assignments(contracts: DataFrame, as_of, start: int = 0, end: int = -6) -> DataFrame:
    """ASM-1 applied: each contract line once per reporting month it overlaps.

    A line overlaps month m when ``startdate <= END_m and finaldate >= PREV_m``;
    ``active`` additionally requires ``eventdate <= END_m``.  Returns the line's
    columns plus ``m`` (ordinal), ``yearmonth``, ``monthend`` (END), ``prevmonthend`` (PREV)
    and ``active``.
    """
    lo_grid, hi_grid = _grid_bounds(as_of, start, end)
    s, f, e = F.col("startdate"), F.col("finaldate"), F.col("eventdate")
    # PREV_m <= finaldate  <=>  m <= ord(finaldate) + (finaldate is a month end)
    hi = _ord(f) + F.when(f == F.last_day(f), 1).otherwise(0)
    lo = F.greatest(_ord(s), lo_grid)
    hi = F.least(hi, hi_grid)
    # least / greatest skip NULLs; a line without start or end overlaps no month
    months = F.when(s.isNotNull() & f.isNotNull() & (lo <= hi), F.sequence(lo, hi))
    first_active = F.when(e.isNotNull() & s.isNotNull(), _ord(F.greatest(s, e)))
    out = contracts.withColumn("m", F.explode(months))
    return out.select("*", *_month_columns(F.col("m")),
                      F.coalesce(F.col("m") >= first_active, F.lit(False)).alias("active"))


def _lines(contracts: DataFrame, as_of, start: int, end: int) -> DataFrame:
    """Assigned lines, unless ``as_of`` is None and they already are."""
    return contracts if as_of is None else month_assignments(contracts, as_of, start, end)


def _top_packages(contracts: DataFrame, as_of, start: int, end: int) -> DataFrame:
    """Per (account, month) the first package group: quantity desc (NULL last), then
    type, item and contract ascending (NULL first), as an aggregate over the summed groups."""
    active = _lines(contracts, as_of, start, end).where(F.col("active") & (F.col("linepackage") == 1))
    groups = active.groupBy(*KEYS, "contracttype", "itemcode", "contractnumber", "m", "yearmonth").agg(
        F.sum("quantity").alias("quantity"))
    q = F.col("quantity")
    first = F.min(F.struct(q.isNull().alias("k0"), (-q).alias("k1"), "contracttype", "itemcode", "contractnumber"))
    return groups.groupBy(*KEYS, "m", "yearmonth").agg(first.alias("_t")).select(
        *KEYS, "m", "yearmonth", "_t.contracttype", "_t.itemcode", "_t.contractnumber", (-F.col("_t.k1")).alias("quantity"))


def _account_ids(accounts: DataFrame) -> DataFrame:
    """The first account id (NULL first) of each account: the last tie-break of the ranking."""
    return accounts.groupBy(*KEYS).agg(F.min(F.struct("accountid"))["accountid"].alias("accountid"))


def monthly_package(contracts: DataFrame, accounts: DataFrame, as_of=None, start: int = 0,
                    end: int = -6) -> DataFrame:
    """ASM-2: per account and month the main package contract: active package lines
    summed per (item, type, contract), joined to the account, top-1 by quantity desc,
    then type asc (ties: item, contract, account id ascending)."""
    return _top_packages(contracts, as_of, start, end).join(_account_ids(accounts), KEYS, "inner").select(
        *KEYS, "itemcode", "contracttype", "contractnumber", "quantity", "m", "yearmonth", "accountid")


def stamp_month(df: DataFrame) -> DataFrame:
    """ASM-3: ``year`` and ``month`` as text (partition values) from ``yearmonth``."""
    return df.withColumns({"year": F.floor(F.col("yearmonth") / 100).cast("int").cast("string"),
                           "month": (F.col("yearmonth") % 100).cast("string")})


TOTALS = ["numberofarchivedadmins", "numberofavailableadmins", "numberofpayingusers", "numberoffreeusers",
          "mrr", "numberofusers"]


def _total_values() -> list[Column]:
    """What ASM-4 sums for each of ``TOTALS``."""
    not_cancelled = F.col("eventtype") != CANCELLED
    users = F.when(not_cancelled, F.col("numberofusers")).otherwise(0)
    admins, vpm, item = F.col("numberofadministrations"), F.col("valuepermonth"), F.col("itemcode")
    return [F.when((item == ARCHIVED_ITEM) & not_cancelled, admins).otherwise(0),
            F.when((item != ARCHIVED_ITEM) & not_cancelled, admins).otherwise(0),
            F.when(vpm != 0, users).otherwise(0), F.when(vpm == 0, users).otherwise(0),
            F.when(not_cancelled, vpm).otherwise(0), users]


def monthly_totals(contracts: DataFrame, as_of=None, start: int = 0, end: int = -6) -> DataFrame:
    """ASM-4: per (account, contract, month) admins, users and MRR of active lines;
    full cancellations (CFC) count zero, users are zeroed before paying/free split."""
    return (_lines(contracts, as_of, start, end).where("active").groupBy(*KEYS, "contractnumber", "m")
            .agg(*[F.sum(v).alias(n) for n, v in zip(TOTALS, _total_values(), strict=True)]))


def attach_totals(packages: DataFrame, totals: DataFrame) -> DataFrame:
    """ASM-5: left join the totals on account, contract and month."""
    return packages.join(totals, KEYS + ["contractnumber", "m"], "left")


def monthly_lifetime(contracts: DataFrame, as_of, start: int = 0, end: int = -6) -> DataFrame:
    """ASM-6: floor(months between END and the first commercial Inflow package start
    on or before END), per account and month.

    The first start on or before END is the overall first start whenever that
    is on or before END, so one per-account ``min`` serves every month.
    """
    lo, hi = _grid_bounds(as_of, start, end)
    first = (contracts.where((F.col("linepackage") == 1) & (F.trim(F.col("contracttype")) == "C")
                             & (F.col("inflowoutflow") == "Inflow"))
             .groupBy(*KEYS).agg(F.min("startdate").alias("first")))
    first_m = F.greatest(_ord(F.col("first")), lo)
    months = F.when(F.col("first").isNotNull() & (first_m <= hi), F.sequence(first_m, hi))
    out = first.withColumn("m", F.explode(months))
    return out.select(*KEYS, "m", F.floor(F.months_between(_month_end_of(F.col("m")), F.col("first")))
                      .alias("commerciallifetimemonths"))


def _ends_in_month() -> Column:
    """ASM-7: 1 for a line that ends by the month's end with a full cancellation."""
    return F.when((F.col("finaldate") <= F.col("monthend")) & F.col("eventtype").isin(*FULL_CANCELLATIONS), 1).otherwise(0)


def monthly_churn(contracts: DataFrame, as_of=None, start: int = 0, end: int = -6) -> DataFrame:
    """ASM-7: per (account, type, contract, month) 1 when a package line overlapping the
    month ends in it with a full cancellation (no event-date test)."""
    return (_lines(contracts, as_of, start, end).where(F.col("linepackage") == 1)
            .groupBy(*KEYS, "contracttype", "contractnumber", "m")
            .agg(F.max(_ends_in_month()).alias("churned")))


def monthly_groups(lines: DataFrame) -> DataFrame:
    """The finest grain of ASM-2, 4 and 7, from one pass over the assigned lines: per
    (account, type, item, contract, month) the package quantity (and how many lines it sums), the
    totals of active lines and the churn flag of package lines."""
    active, package = F.col("active"), F.col("linepackage") == 1
    return lines.groupBy(*KEYS, "contracttype", "itemcode", "contractnumber", "m").agg(
        F.count(F.when(active & package, 1)).alias("_lines"), F.sum(F.when(active & package, F.col("quantity"))).alias("quantity"),
        *[F.sum(F.when(active, v)).alias(n) for n, v in zip(TOTALS, _total_values(), strict=True)],
        F.max(F.when(package, _ends_in_month())).alias("churned"))


def main_packages(groups: DataFrame) -> DataFrame:
    """The main package of each (account, month) with the totals of its contract and the churn
    flag of its (type, contract), rolled up from :func:`monthly_groups`.

    Each level keeps the first package so far (quantity descending, NULL last; then type, item and
    contract ascending) and the values of the level that it belongs to ride along, so
    nothing is joined.  A NULL contract has no totals, a NULL contract or type no churn flag,
    as a join on them would find none.
    """
    q, contract = F.col("quantity"), F.col("contractnumber")
    totals = [F.sum(n).alias(n) for n in TOTALS]
    by_type = groups.groupBy(*KEYS, "contracttype", "contractnumber", "m").agg(
        F.min(F.when(F.col("_lines") > 0, F.struct(q.isNull().alias("k0"), (-q).alias("k1"), "contracttype", "itemcode", "contractnumber"))).alias("_t"),
        F.max("churned").alias("churned"), *totals)
    flag = F.when(contract.isNotNull() & F.col("contracttype").isNotNull(), F.col("churned")).alias("churned")
    by_contract = by_type.groupBy(*KEYS, "contractnumber", "m").agg(
        F.min(F.when(F.col("_t").isNotNull(), F.struct(F.col("_t").alias("t"), flag))).alias("_t"), *totals)
    own = F.struct(F.col("_t.t").alias("t"), F.col("_t.churned").alias("churned"), *[F.when(contract.isNotNull(), F.col(n)).alias(n) for n in TOTALS])
    by_account = by_contract.groupBy(*KEYS, "m").agg(F.min(F.when(F.col("_t").isNotNull(), own)).alias("_t")).where(F.col("_t").isNotNull())
    return by_account.select(*KEYS, "m", "_t.t.contracttype", "_t.t.itemcode", "_t.t.contractnumber", (-F.col("_t.t.k1")).alias("quantity"),
                             "_t.churned", *[f"_t.{n}" for n in TOTALS])


def monthly_summary(contracts: DataFrame, accounts: DataFrame, as_of, start: int = 0, end: int = -6) -> DataFrame:
    """ASM-ALL: all reporting months in one plan, keyed by ``yearmonth``.

    The contracts are scanned and exploded into months once and grouped at the finest
    grain (:func:`monthly_groups`, combined map-side); packages, totals and churn are rolled
    up from those groups.  One more scan gives the first commercial start of each account.
    No window holds the lines of an account.
    ``year``/``month`` are the partition columns for :func:`write_month`.
    """
    packages = main_packages(monthly_groups(month_assignments(contracts, as_of, start, end)))
    r = packages.join(_account_ids(accounts), KEYS, "inner").withColumn("yearmonth", _month_columns(F.col("m"))[0])
    r = r.join(monthly_lifetime(contracts, as_of, start, end), KEYS + ["m"], "left")
    return stamp_month(r.withColumnRenamed("itemcode", "packagecode")).select(*MONTHLY_COLUMNS)
