"""A Bloom filter of fixed size, to leave most rows out before a join.

The filter has ``LONGS`` words whatever the input, so it may be broadcast.  It only
spares work: an exact join follows, and with more keys than it is made for it just
lets more rows through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONGS = 1 << 18  # 2 MB
_SEEDS = (101, 202, 303)


def bloom_bits(keys: DataFrame, key: str) -> np.ndarray:
    """The filter of a long column."""
    bit = F.explode(F.array(*[F.pmod(F.xxhash64(key, F.lit(s)), F.lit(LONGS * 64)) for s in _SEEDS]))
    words = (keys.select(bit.alias("bit")).groupBy((F.col("bit") / 64).cast("int").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, int(bit % 64)))").alias("bits")))
    got = words.toArrow()
    out = np.zeros(LONGS, np.int64)
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return out.view(np.uint64)


def maybe_in(df: DataFrame, key: str, bits: np.ndarray, wanted: bool = True) -> DataFrame:
    """Rows of ``df`` whose key may be in the filter, or (``wanted=False``) surely is not."""
    sent = df.sparkSession.sparkContext.broadcast(bits)
    columns = df.columns
    names = [f"_bloom{s}" for s in _SEEDS]
    hashed = df.select(*df.columns, *[F.pmod(F.xxhash64(key, F.lit(s)), F.lit(LONGS * 64)).alias(n) for s, n in zip(_SEEDS, names, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = sent.value
        for batch in batches:
            ok = np.ones(batch.num_rows, bool)
            for n in names:
                bit = batch.column(n).to_numpy()
                ok &= (words[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1
            yield batch.select(columns).filter(pa.array(ok == wanted))

    return hashed.mapInArrow(run, df.schema)


def bitmap(hashes: DataFrame, key: str) -> np.ndarray:
    """A bit for each value of a long column that is a hash already, by its low bits."""
    return bitmaps(hashes.select(key, F.lit(0).alias("which")), key, "which", 1)[0]


def bitmaps(hashes: DataFrame, key: str, which: str, n: int) -> np.ndarray:
    """``n`` bitmaps in one pass: a row's bit is in the one with the number ``which``, from 0."""
    low = F.col(key).bitwiseAND(F.lit(LONGS * 64 - 1))
    words = (hashes.groupBy(F.col(which).alias("which"), F.shiftright(low, 6).cast("int").alias("word"))
             .agg(F.expr(f"bit_or(shiftleft(1L, int({key} & 63)))").alias("bits")))
    got = words.toArrow()
    out = np.zeros((n, LONGS), np.int64)
    out[got.column("which").to_numpy(), got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return out.view(np.uint64)


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    low = keys.astype(np.int64) & (LONGS * 64 - 1)
    return (bits[low >> 6] >> (low & 63).astype(np.uint64)) & np.uint64(1) == 1
