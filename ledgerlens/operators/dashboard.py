"""Activity / no-activity dashboard per account and calendar day (NAD-1 ... NAD-6).

The reporting window start is a scalar subquery over the calendar (no driver
round trip).  The account x day spine is generated from each account's own
date range with ``explode(sequence(lo, hi))`` and matched to the calendar days
of the window by a broadcast equi-join: the window spans at most
``months_back + 1`` months, so the broadcast side has a proven bound of about
4 x 31 rows whatever the data size.

The original joins daily activity on the user id only, so every day of an
account carries the whole-window total of its users; computed literally that
emits days x activity-days rows per user.  Here the totals are aggregated per
user and per account first and the day rows only pick them up, which yields
the same sums without the fan-out.  ``on_date=True`` joins per day instead
(the evident intent).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import as_date

__all__ = ["window_start", "daily_activity", "account_days", "classified_accounts", "join_activity",
           "no_activity", "CLASSIFICATIONS", "PAGE_VIEW"]

# Account classifications shown on the dashboard, activity id of a page view.
CLASSIFICATIONS = ("EOL", "ACC", "AC7", "JB0", "AC1", "EO1", "AC8")
PAGE_VIEW = 1


def _window_start_df(calendar: DataFrame, as_of, months_back: int = 3) -> DataFrame:
    month = F.trunc(F.col("calendardate"), "month")
    return (calendar.where(F.months_between(as_date(as_of), month) <= months_back)
            .agg(F.min(month).alias("date_since")))


def window_start(calendar: DataFrame, as_of, months_back: int = 3) -> Column:
    """NAD-1: earliest calendar month start at most ``months_back`` months before
    ``as_of``, as a scalar-subquery Column."""
    return _window_start_df(calendar, as_of, months_back).scalar()


def daily_activity(activity: DataFrame, date_since: Column) -> DataFrame:
    """NAD-2: page views per (environment, user, day) since the window start."""
    return (activity.where((F.col("activityid") == PAGE_VIEW) & (F.col("date") >= date_since))
            .groupBy("environment", "userid", "date").agg(F.sum("quantity").alias("sumquantity")))


def classified_accounts(accounts: DataFrame, classifications=CLASSIFICATIONS) -> DataFrame:
    """NAD-4: accounts shown on the dashboard."""
    return accounts.where(F.col("accountclassificationcode").isin(*classifications))


def account_days(summary: DataFrame, accounts: DataFrame, calendar: DataFrame, as_of,
                 date_since: Column) -> DataFrame:
    """NAD-3: (account, calendar day) for the days in [window start, as_of - 1] that
    also fall in [first commercial start, churned ? latest commercial final : as_of].

    One row per summary row, matching account row and calendar row, as the
    original theta join produces.
    """
    d = as_date(as_of)
    end = F.when(F.col("churned") == 1, F.col("latestcommfinaldate")).otherwise(d)
    fcs = F.col("firstcommstartdate")
    lo = F.greatest(date_since, fcs)
    hi = F.least(F.date_sub(d, 1), end)
    days = F.when(fcs.isNotNull() & end.isNotNull() & (lo <= hi), F.sequence(lo, hi))
    spine = (summary.select("accountid", "accountcode", "environment", "firstcommstartdate", "churned",
                            "latestcommfinaldate")
             .join(accounts.select("accountid", "accountclassificationcode"), "accountid", "inner")
             .withColumn("calendardate", F.explode(days)))
    # one row for each day of the window, however often the calendar lists it: no more
    # days than lie between the window start and as_of, so it may be broadcast
    window = (calendar.where((F.col("calendardate") >= date_since) & (F.col("calendardate") <= F.date_sub(d, 1)))
              .groupBy("calendardate").agg(F.count(F.lit(1)).cast("int").alias("_times")))
    joined = spine.join(F.broadcast(window), "calendardate", "inner")
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(
        "accountid", "accountcode", "environment", "calendardate", "accountclassificationcode")


def join_activity(days: DataFrame, users: DataFrame, activity_daily: DataFrame,
                  on_date: bool = False) -> DataFrame:
    """NAD-5: page views of the account's users for each account day.

    ``on_date=False``: each day gets the users' totals over the whole window
    (the original userid-only join); ``on_date=True``: that day's views.
    Days of accounts without users are dropped (inner join on users).
    """
    # how many account rows each (account, day) row stands for
    per_day = days.groupBy("accountid", "accountcode", "environment", "calendardate").agg(
        F.count(F.lit(1)).alias("_n"))
    user_rows = users.groupBy("accountid").agg(F.count(F.lit(1)).alias("_users"))
    if not on_date:
        per_user = activity_daily.groupBy("userid").agg(F.sum("sumquantity").alias("_views"))
        per_account = (users.select("accountid", "userid").join(per_user, "userid", "left")
                       .groupBy("accountid").agg(F.sum("_views").alias("_views")))
        joined = (per_day.join(user_rows, "accountid", "inner").join(per_account, "accountid", "left"))
    else:
        per_user_day = activity_daily.groupBy("userid", F.col("date").alias("calendardate")).agg(
            F.sum("sumquantity").alias("_views"))
        per_account_day = (users.select("accountid", "userid").join(per_user_day, "userid", "inner")
                           .groupBy("accountid", "calendardate").agg(F.sum("_views").alias("_views")))
        joined = (per_day.join(user_rows, "accountid", "inner")
                  .join(per_account_day, ["accountid", "calendardate"], "left"))
    return joined.select("accountid", "accountcode", "environment", "calendardate",
                         (F.col("_views") * F.col("_n")).alias("pageviews"))


def no_activity(summary: DataFrame, accounts: DataFrame, users: DataFrame, activity: DataFrame,
                calendar: DataFrame, as_of, on_date: bool = False, months_back: int = 3,
                classifications=CLASSIFICATIONS) -> DataFrame:
    """NAD-ALL / NAD-6: page views per account and day, active flag and the
    environment+account key."""
    since = window_start(calendar, as_of, months_back)
    days = account_days(summary, classified_accounts(accounts, classifications), calendar, as_of, since)
    views = join_activity(days, users, daily_activity(activity, since), on_date)
    return views.select(
        "accountid", "accountcode", "environment", "calendardate",
        F.col("pageviews").cast("bigint").alias("pageviewquantity"),
        F.when(F.col("pageviews").isNull(), F.lit(0)).otherwise(F.lit(1)).alias("activeornot"),
        F.concat(F.col("environment"), F.col("accountcode")).alias("enviroaccount"))
