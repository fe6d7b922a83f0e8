"""Contract history chart feed (CPH-1 ... CPH-ALL).

The contract lines are read twice, and no raw line is joined to accounts or stored:

* once for their days: lines and commercial MRR are counted and summed per (account, day), and a running
  sum goes over the *daily* rows in two levels (``functions.prefix``).  The account's ids join here, to one
  narrow row of each day;
* once for their rows: lines are counted and summed per (account, day, event, item, package flag), dealt by
  account and day, and stay there: the descriptions, the quantities of an (account, day, event, item) and the
  days are joined to them without a further shuffle.

The line rows are expanded from their counts at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import KEYS, as_date
from ledgerlens.functions.prefix import NO_DAY, prefix_scan
from ledgerlens.session import JobStore, checkpoint_shared, small_tasks

__all__ = ["history_days", "history_groups", "history_base", "history_points", "step_points", "current_points", "contract_history",
           "HISTORY_COLUMNS"]

COMMERCIAL = "C"
PRICE_INCREASE = "PI"
HISTORY_COLUMNS = ["accountid", "eventdate", "linepackage", "summrr", "description"]
_DETAIL = KEYS + ["eventdate", "contracteventdescription", "itemdescription"]


#: Copies that one array makes of a counted row.
_COPIES = 4096


def _lines(contracts: DataFrame) -> DataFrame:
    """The lines' trimmed codes, their package flag (0 for price increases) and their commercial MRR.  Lines
    without a key belong to no account."""
    flag = F.when(F.trim("eventtype") == PRICE_INCREASE, F.lit(0)).otherwise(F.col("linepackage")).cast("int").alias("linepackage")
    mrr = F.when(F.trim("contracttype") == COMMERCIAL, F.col("valuepermonth")).otherwise(0).alias("_m")
    lines = contracts.select(_environment(), _trimmed("accountcode"), "eventdate", _trimmed("eventtype"), _trimmed("itemcode"), flag,
                             "quantity", mrr)
    return lines.where(F.col("environment").isNotNull() & F.col("accountcode").isNotNull())


def _environment():
    return F.upper(F.trim(F.col("environment"))).alias("environment")


def _trimmed(name: str, out: str | None = None):
    return F.trim(F.col(name)).alias(out or name)


def _described(rows: DataFrame, event_types: DataFrame, item_classifications: DataFrame) -> DataFrame:
    """Rows with the descriptions of their codes, once for each matching event type and item classification.

    These are lists of codes and are broadcast: a join dealt by a few codes would shuffle and sort all rows in as
    many tasks as there are codes.
    """
    et = event_types.select(_environment(), _trimmed("contracteventtypecode", "eventtype"), _trimmed("contracteventdescription"))
    ic = item_classifications.select(_environment(), _trimmed("itemcode"), _trimmed("itemdescription"))
    return rows.join(F.broadcast(et), ["environment", "eventtype"], "inner").join(F.broadcast(ic), ["environment", "itemcode"], "inner")


def _day():
    """The day as a number that is never NULL, so that rows without a day meet each other in a join."""
    return F.coalesce(F.unix_date("eventdate").cast("long"), F.lit(NO_DAY)).alias("_day")


def history_days(contracts: DataFrame, summary: DataFrame, event_types: DataFrame,
                 item_classifications: DataFrame) -> DataFrame:
    """Per (account, day) the described lines (``_n``), the account's ids (``_ids``) and its running commercial MRR.

    Each of the account's ids has all its lines, so that ``_n`` counts them for one id and the MRR for all of them.
    """
    lines = _described(_lines(contracts), event_types, item_classifications)
    days = lines.groupBy(*KEYS, "eventdate").agg(F.count(F.lit(1)).alias("_n"), F.sum("_m").alias("_m"))
    days = prefix_scan(days, KEYS, "eventdate", sums={"_running": "_m"})
    ids = (summary.where(F.col("accountid").isNotNull()).select(_environment(), _trimmed("accountcode"), _trimmed("accountid"))
           .groupBy(*KEYS).agg(F.collect_list("accountid").alias("_ids")))
    running = F.col("_running").cast("double") * F.size("_ids")
    return days.join(ids, KEYS, "inner").select(*KEYS, "eventdate", "_n", "_ids", running.alias("summrr"))


def history_groups(contracts: DataFrame, summary: DataFrame, event_types: DataFrame,
                   item_classifications: DataFrame, days: DataFrame | None = None, mrr: bool = True) -> DataFrame:
    """CPH-1 with a count (``_n``): the rows of an account, id, day, event, item and package flag, counted.  ``mrr``: with the
    commercial MRR of these lines (``_m``), which the history itself takes from the days.

    Lines are counted by their codes first; every matching summary / event type / classification row then stands for
    as many lines, as in the original inner joins.  The flags that share a quantity are kept beside it (as many as there
    are codes and flags), so it is not joined back.  ``days`` are :func:`history_days` of the same tables.
    """
    small_tasks(contracts.sparkSession)
    if days is None:
        days = history_days(contracts, summary, event_types, item_classifications)
    counts = ["_n", *["_m"] * mrr]
    counted = _lines(contracts).groupBy(*KEYS, "eventdate", "eventtype", "itemcode", "linepackage").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("quantity").alias("_quantity"), *[F.sum("_m").alias("_m")] * mrr)
    # one shuffle by account and day serves the quantities and the join with the days
    counted = counted.withColumn("_day", _day()).repartition(*KEYS, "_day")
    shared = _described(counted, event_types, item_classifications).groupBy("_day", *_DETAIL).agg(
        F.sum("_quantity").alias("_quantity"), F.collect_list(F.struct("linepackage", *counts)).alias("_shared"))
    own = days.select(*KEYS, _day(), "_ids", "summrr")
    rows = shared.join(own, KEYS + ["_day"], "inner").withColumn("_row", F.explode("_shared"))
    rows = rows.withColumn("accountid", F.explode("_ids"))
    return rows.select("accountid", *_DETAIL, "_row.linepackage", (F.col("_quantity") * F.size("_ids")).cast("double").alias("quantity"),
                       "summrr", *[f"_row.{c}" for c in counts])


def _expanded(rows: DataFrame) -> DataFrame:
    """Each row as often as its count says, in arrays of bounded length."""
    n, i = F.col("_n"), F.col("_i")
    parts = rows.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / _COPIES).cast("long"))))
    copies = F.least(F.lit(_COPIES), n - i * _COPIES).cast("int")
    return parts.withColumn("_copy", F.explode(F.array_repeat(F.lit(True), copies))).drop("_n", "_i", "_copy")


def history_base(contracts: DataFrame, summary: DataFrame, event_types: DataFrame,
                 item_classifications: DataFrame) -> DataFrame:
    """CPH-1: contract lines with their account id, event and item descriptions,
    package flag (0 for price increases), summed quantity of the line's
    (account, day, event, item) group and the account's running commercial MRR
    up to and including the line's day.

    Duplicate classification rows multiply lines and sums, as in the original.
    """
    return _expanded(history_groups(contracts, summary, event_types, item_classifications, mrr=False))


def history_points(base: DataFrame, *more: str) -> DataFrame:
    """CPH-2: one point per line with ``event | item | Quantity q`` (and ``more`` columns)."""
    desc = F.concat(F.col("contracteventdescription"), F.lit(" | "), F.col("itemdescription"),
                    F.lit(" | Quantity "), F.col("quantity").cast("string"))
    return base.select("accountid", "eventdate", "linepackage", "summrr", desc.alias("description"), *more)


def _daily_points(base: DataFrame) -> DataFrame:
    return base.groupBy("accountid", "eventdate").agg(F.count(F.lit(1)).alias("_n"), F.max("summrr").alias("_mrr"))


def _step_from_daily(daily: DataFrame) -> DataFrame:
    # the row before is the largest day before, with its MRR
    daily = prefix_scan(daily, ["accountid"], "eventdate", before={"_last": F.struct("eventdate", "_mrr")})
    daily = daily.withColumn("_prev", F.when(F.col("_last").isNull(), F.lit(0.0)).otherwise(F.col("_last._mrr")))
    day_before = F.date_sub(F.col("eventdate"), 1)
    values = F.when(F.col("_n") >= 2, F.array(F.col("_prev"), F.col("_mrr"))).otherwise(F.array(F.col("_prev")))
    return (daily.select("accountid", day_before.alias("eventdate"), F.explode(values).alias("summrr"))
            .distinct()
            .select("accountid", "eventdate", F.lit(None).cast("int").alias("linepackage"), "summrr",
                    F.lit(None).cast("string").alias("description")))


def _current_from_daily(daily: DataFrame, as_of) -> DataFrame:
    d = as_date(as_of)
    last = daily.groupBy("accountid").agg(
        F.max(F.struct(F.col("eventdate").alias("d"), F.col("_mrr").alias("m"))).alias("_last"))
    return last.select("accountid",
                       F.when(F.col("_last.d") >= d, F.col("_last.d")).otherwise(d).alias("eventdate"),
                       F.lit(None).cast("int").alias("linepackage"), F.col("_last.m").alias("summrr"),
                       F.lit(None).cast("string").alias("description"))


def step_points(base: DataFrame) -> DataFrame:
    """CPH-3: the day before each change with the MRR before it (0 for the first
    change); a day with several lines also yields a point with its own MRR.
    Distinct (account, day, mrr).  The lag runs over one row per account day."""
    return _step_from_daily(_daily_points(base))


def current_points(base: DataFrame, as_of) -> DataFrame:
    """CPH-4: the account's latest MRR dated at its last change if that is on or
    after ``as_of``, else at ``as_of``."""
    return _current_from_daily(_daily_points(base), as_of)


def contract_history(contracts: DataFrame, summary: DataFrame, event_types: DataFrame,
                     item_classifications: DataFrame, as_of, checkpoint: bool = True, store: JobStore | None = None) -> DataFrame:
    """CPH-ALL: change points, step points and current points.

    The days feed all three outputs, so they are checkpointed once (in
    the job's ``store`` or the session's shared checkpoint folder); the points are expanded
    from their counts last, and the step and current points come from the days alone.
    """
    tables = contracts, summary, event_types, item_classifications
    small_tasks(contracts.sparkSession)
    days = history_days(*tables)
    if checkpoint:
        days = checkpoint_shared(days, "history-days", store)
    points = _expanded(history_points(history_groups(*tables, days, mrr=False), "_n"))
    per_id = (days.select(F.explode("_ids").alias("accountid"), "eventdate", "_n", "summrr")
              .groupBy("accountid", "eventdate").agg(F.sum("_n").alias("_n"), F.max("summrr").alias("_mrr")))
    return points.unionByName(_step_from_daily(per_id)).unionByName(_current_from_daily(per_id, as_of))
