"""Running values over the days of a key, in two levels.

A window over all days of a key puts them in one task.  Here the days are cut into blocks
of ``BLOCK_DAYS``: one window runs over the totals of a key's blocks (a day's row is not in it), another
inside each block, and a row's value is the exclusive prefix of its block and the value inside it.
The rows of a key with many days so spread over tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

__all__ = ["prefix_scan", "BLOCK_DAYS", "NO_DAY"]

BLOCK_DAYS = 512
#: Before every block of days: rows without a day come first.
NO_DAY = -(1 << 40)


def prefix_scan(days: DataFrame, keys: list[str], day: str, sums: Mapping[str, str] | None = None,
                before: Mapping[str, Column] | None = None, block_days: int = BLOCK_DAYS) -> DataFrame:
    """``days`` (one row for each of ``keys`` and ``day``) with running values.

    ``sums`` maps new columns to columns that are summed up to and including the row's day;
    ``before`` maps new columns to expressions whose maximum over strictly earlier days is taken.
    A NULL day is before all others, NULL keys are keys like any other, and NULL values are skipped.
    """
    sums, before = dict(sums or {}), dict(before or {})
    block = F.coalesce(F.floor(F.unix_date(day) / F.lit(block_days)), F.lit(NO_DAY)).cast("long")
    rows = days.withColumns({f"_v_{n}": v for n, v in before.items()})
    # structs are equal when their fields are, NULL or not
    rows = rows.withColumn("_key", F.struct(*keys, block.alias("_block")))
    totals = rows.groupBy("_key").agg(*[F.sum(c).alias(f"_s_{n}") for n, c in sums.items()],
                                      *[F.max(f"_v_{n}").alias(f"_m_{n}") for n in before])
    earlier = Window.partitionBy(*[F.col(f"_key.{k}") for k in keys]).orderBy("_key._block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_key", *[F.sum(f"_s_{n}").over(earlier).alias(f"_s_{n}") for n in sums],
                           *[F.max(f"_m_{n}").over(earlier).alias(f"_m_{n}") for n in before])
    inside = Window.partitionBy("_key").orderBy(day)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("_key", *days.columns, *[F.sum(c).over(upto).alias(f"_t_{n}") for n, c in sums.items()],
                       *[F.max(f"_v_{n}").over(until).alias(f"_u_{n}") for n in before])
    out = rows.join(totals, "_key")
    own = {n: F.coalesce(F.col(f"_s_{n}") + F.col(f"_t_{n}"), F.col(f"_s_{n}"), F.col(f"_t_{n}")) for n in sums}
    # a value inside the block is later than the prefix, but not larger by that
    own |= {n: F.greatest(F.col(f"_m_{n}"), F.col(f"_u_{n}")) for n in before}
    return out.select(*[c for c in days.columns if c not in own], *[v.alias(n) for n, v in own.items()])
