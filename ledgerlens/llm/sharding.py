"""Sharding by sampled splitters (DataFrame functions only).

1. A size-weighted sample of the keys is drawn: a record of size s is taken
   with probability min(1, s * m / total).  The draw is a hash of the key, so a
   repeated task draws the same.
2. Weighted quantiles of the sample are the boundaries of many more ranges than
   there are shards.  Exact totals of every range follow; ranges above twice
   their share are subdivided by a sample of their own.
3. Running totals inside each range, added to the totals of the ranges before
   it, give each record its place in key order.  A shard is an equal stretch of
   that order, so shard sizes differ by little more than one record.

The key is (``key``, ``tie``), two longs; as the tie-breaker takes part, a key
that holds a third of all rows is divided like any other stretch.  Only
boundaries and totals of ranges reach the driver: at most ``MAX_RANGES`` of
them (plus subdivisions), whatever the input.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_RANGES = 4096
RANGE_BYTES = 1 << 30
DRAWS_PER_RANGE = 32
OVERFULL = 2.0
ROUNDS = 3

LEAST = -(1 << 63)


def key_of(column: Column | str, default: int = LEAST) -> Column:
    """A key long without nulls."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("long"), F.lit(default))


def longs(values: list[int]) -> Column:
    """A list of longs as one literal (folded once by the optimiser), however long."""
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def lookup(values: list[int], index: Column) -> Column:
    """Entry ``index`` of a list of longs."""
    return F.get(longs(values), index)


def range_of(bounds: list[tuple[int, int]], key: Column, tie: Column) -> Column:
    """Number of boundaries at or below (key, tie), by binary search."""
    if not bounds:
        return F.lit(0)
    keys, ties = longs([b[0] for b in bounds]), longs([b[1] for b in bounds])
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def descend(at: Column, step: Column) -> Column:
        k, t = F.get(keys, at + step - 1), F.get(ties, at + step - 1)
        return F.when((k < key) | ((k == key) & (t <= tie)), at + step).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), descend)


def draw_bounds(rows: DataFrame, total: int, parts: int, seed: int) -> list[tuple[int, int]]:
    """At most ``parts - 1`` weighted quantiles of a sample of ``rows`` (_key, _tie, _size)."""
    if parts < 2 or not total:
        return []
    draws = parts * DRAWS_PER_RANGE
    weight = F.greatest(F.col("_size").cast("double"), F.lit(total / draws))
    chance = F.pmod(F.xxhash64(F.lit(seed), "_key", "_tie"), F.lit(1 << 40)) / float(1 << 40)
    sample = rows.where(chance * float(total) < F.col("_size") * float(draws)).select("_key", "_tie", weight.alias("_w"))
    order = Window.partitionBy(F.lit(0)).orderBy("_key", "_tie")
    marked = (sample
              .withColumn("_up", F.sum("_w").over(order.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("_all", F.sum("_w").over(Window.partitionBy(F.lit(0))))
              .withColumn("_q", F.floor(F.col("_up") * parts / F.col("_all")))
              .withColumn("_last", F.floor((F.col("_up") - F.col("_w")) * parts / F.col("_all"))))
    got = marked.where((F.col("_q") > F.col("_last")) & (F.col("_q") < parts)).select("_key", "_tie").collect()
    return [(r[0], r[1]) for r in got]


def range_totals(rows: DataFrame, bounds: list[tuple[int, int]]) -> dict[int, tuple[int, int]]:
    """{range: (size, rows)} of the ranges that have rows."""
    got = (rows.groupBy(range_of(bounds, F.col("_key"), F.col("_tie")).alias("_range"))
           .agg(F.sum("_size").alias("size"), F.count(F.lit(1)).alias("n")).collect())
    return {r["_range"]: (r["size"], r["n"]) for r in got}


def sampled_ranges(rows: DataFrame, parts: int | None = None, least: int = 1) -> tuple[list[tuple[int, int]], dict[int, tuple[int, int]]]:
    """Boundaries of ranges of near equal size over ``rows`` (_key, _tie, _size),
    and the totals of each range.  ``parts``: how many (default by ``RANGE_BYTES``,
    from ``least`` to ``MAX_RANGES``)."""
    total = rows.agg(F.sum("_size")).first()[0] or 0
    parts = parts or min(MAX_RANGES, max(least, -(-total // RANGE_BYTES)))
    bounds = sorted(set(draw_bounds(rows, total, parts, 11)))
    totals = range_totals(rows, bounds)
    for again in range(ROUNDS):
        share = max(1, total // parts)
        overfull = {r: v for r, v in totals.items() if v[0] > OVERFULL * share and v[1] > 1}
        if not overfull:
            break
        inside = rows.where(range_of(bounds, F.col("_key"), F.col("_tie")).isin(list(overfull)))
        size = sum(v[0] for v in overfull.values())
        finer = sorted(set(bounds) | set(draw_bounds(inside, size, 2 * -(-size // share), 100 + again)))
        if finer == bounds:
            break
        bounds, totals = finer, range_totals(rows, finer)
    return bounds, totals


def before(totals: dict[int, tuple[int, int]], n_ranges: int, what: int) -> list[int]:
    """Running totals before each range."""
    out, so_far = [], 0
    for r in range(n_ranges):
        out.append(so_far)
        so_far += totals.get(r, (0, 0))[what]
    return out


def shard_rows(df: DataFrame, key: Column, tie: Column, size: Column, n_shards: int = 24, parts: int | None = None) -> DataFrame:
    """``df`` with ``shard`` (0 to n_shards - 1, near equal sizes, consecutive in
    key order) and ``slot`` (place in the shard, gapless from 0).

    Null keys sort first, null sizes count as 0.  Repeated rows each get a slot
    of their own.  An empty input stays empty.  Input columns named ``shard`` or
    ``slot`` are replaced; names starting with ``_`` are reserved.
    """
    out = [c for c in df.columns if c not in ("shard", "slot")]
    rows = df.select(*out, key_of(key).alias("_key"), key_of(tie).alias("_tie"), F.coalesce(size.cast("long"), F.lit(0)).alias("_size"))
    bounds, totals = sampled_ranges(rows.select("_key", "_tie", "_size"), parts, least=8 * n_shards)
    n_ranges = len(bounds) + 1
    size_before, rows_before = before(totals, n_ranges, 0), before(totals, n_ranges, 1)
    total, n_rows = sum(v[0] for v in totals.values()), sum(v[1] for v in totals.values())

    def placed(some: DataFrame) -> DataFrame:
        order = Window.partitionBy("_range").orderBy("_key", "_tie", "_size")
        upto = order.rowsBetween(Window.unboundedPreceding, 0)
        at = F.col("_size_at") + lookup(size_before, F.col("_range"))
        # the shard holds the middle of the record; without any size, rows are dealt evenly
        where = F.expr(f"((2 * _at - _size) * {n_shards}) div {2 * total}") if total else F.expr(f"(_row * {n_shards}) div {max(1, n_rows)}")
        return (some.withColumn("_size_at", F.sum("_size").over(upto))
                .withColumn("_rank", F.row_number().over(order))
                .withColumn("_at", at)
                .withColumn("_row", F.col("_rank") - 1 + lookup(rows_before, F.col("_range")))
                .withColumn("shard", F.least(where, F.lit(n_shards - 1)).cast("int")))

    ranged = rows.withColumn("_range", range_of(bounds, F.col("_key"), F.col("_tie")))
    first = (placed(ranged.select("_key", "_tie", "_size", "_range"))
             .groupBy("shard").agg(F.min("_row").alias("first")).collect())  # a row for each shard
    starts = {r["shard"]: r["first"] for r in first}
    return (placed(ranged)
            .withColumn("slot", F.col("_row") - lookup([starts.get(s, 0) for s in range(n_shards)], F.col("shard")))
            .select(*out, "shard", "slot"))
