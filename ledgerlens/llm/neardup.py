"""MinHash near-duplicates: one-permutation hashing, optimal densification, bands, stars.

1. A text's set of word shingles is hashed once; each of ``BINS`` bins keeps its
   least hash, and an empty bin borrows from a full one that a fixed random
   sequence names (optimal densification).  Bands of ``ROWS`` bins are bucket keys.
   Texts of equal sets are one class and go on as one row.
2. A bucket's classes are linked to one centre each (a star), not to each other, so
   candidates are as many as bucket entries.  Each class also has the parities of its hashes
   in ``PARITIES`` cells.  Two classes' parities differ in no more cells than their sets differ in shingles, so
   a pair with too many is no link.  Any other candidate is confirmed on both full sets.
3. A bucket whose classes are then still in several components gets further centres:
   its classes outside its largest component, few at first and then more, until each
   of them has been one.  So every bucket's links between components are found without
   forming all its pairs.
4. Components are found by alternating stars on stored tables.

Two sets of Jaccard similarity s share some bucket with probability
1 - (1 - s**ROWS)**BANDS: 0.999997 at 0.8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm import textwords as tw
from ledgerlens.llm.components import components
from ledgerlens.llm.storage import stored

BANDS, ROWS = 24, 4
BINS = BANDS * ROWS
ID_BITS = 54  # of a shingle's hash; the other ten bits number the texts of a batch
BATCH_ROWS = 1 << (64 - ID_BITS)
#: Cells of a set's parities, 64 in a long.
PARITIES = 512
ODD = [f"odd{i}" for i in range(PARITIES // 64)]
#: Centres of a bucket in each round; the last number repeats.
CENTRES = (8, 64, 4096)

_MASK = np.uint64((1 << ID_BITS) - 1)


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts, offsets), for at most ``BATCH_ROWS`` texts.

    A text of fewer than ``k`` words is one shingle, a text without words has none.
    """
    words = tw.words_of(texts, tw.SPACE_SEPARATED, tw.LOWER)
    counts, first = words.counts(), words.first[:-1]
    full = counts >= k
    at = tw.ranges(first[full], counts[full] - k + 1)
    hashes = [tw.sequence_hashes(words.hash, k)[at]]
    owner = [np.repeat(np.flatnonzero(full), counts[full] - k + 1)]
    for n in range(1, k):
        few = np.flatnonzero(counts == n)
        if len(few):
            hashes.append(tw.sequence_hashes(words.hash, n, seed=n)[first[few]])
            owner.append(few)
    ids = tw.distinct((np.concatenate(owner).astype(np.uint64) << np.uint64(ID_BITS)) | (np.concatenate(hashes) & _MASK))
    offsets = np.searchsorted(ids >> np.uint64(ID_BITS), np.arange(len(texts) + 1).astype(np.uint64))
    return ids & _MASK, offsets


def _borrowing(attempts: int = 256) -> np.ndarray:
    """For each attempt and bin, the bin to borrow from."""
    return (tw.random_words(attempts * BINS, 77) % np.uint64(BINS)).reshape(attempts, BINS).astype(np.int64)


_BORROW = _borrowing()


def signatures(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """texts x BINS least hashes, densified; rows of texts without shingles are zero."""
    n, sizes = len(offsets) - 1, np.diff(offsets)
    sig = np.zeros(n * BINS, np.uint64)
    full = np.zeros(n * BINS, bool)
    place = np.repeat(np.arange(n), sizes) * BINS + (ids % np.uint64(BINS)).astype(np.int64)
    sig[place[::-1]] = ids[::-1] // np.uint64(BINS)  # ascending ids: the least is written last
    full[place] = True
    dense, want = sig.copy(), np.flatnonzero(~full & np.repeat(sizes > 0, BINS))
    for attempt in range(len(_BORROW)):
        if not len(want):
            break
        source = want - want % BINS + _BORROW[attempt][want % BINS]
        ok = full[source]
        dense[want[ok]] = sig[source[ok]]
        want = want[~ok]
    for i in want.tolist():  # hardly ever: the next full bin
        row = i - i % BINS
        ring = row + (i % BINS + np.arange(BINS)) % BINS
        dense[i] = sig[ring[np.argmax(full[ring])]]
    return dense.reshape(n, BINS)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """texts x BANDS bucket keys."""
    rows = sig.reshape(len(sig), BANDS, ROWS)
    key = np.broadcast_to(tw.random_words(BANDS, 31), rows.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for r in range(ROWS):
            key = tw.mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, r])
    return key


def set_hashes(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One hash of each whole set."""
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(tw.mix(ids + np.uint64(1)))])
        return tw.mix(sums[offsets[1:]] - sums[offsets[:-1]] + np.diff(offsets).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def parities(ids: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each of ``ODD`` one long of each text: the bits of cells with an odd number of its hashes."""
    cell = ids >> np.uint64(ID_BITS - PARITIES.bit_length() + 1)
    bit, part, out = np.uint64(1) << (cell & np.uint64(63)), cell >> np.uint64(6), []
    for i in range(len(ODD)):
        upto = np.concatenate([[np.uint64(0)], np.bitwise_xor.accumulate(np.where(part == np.uint64(i), bit, np.uint64(0)))])
        out.append((upto[offsets[1:]] ^ upto[offsets[:-1]]).view(np.int64))
    return out


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in tw.small_batches(batches, "text"):
        for i in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(i, BATCH_ROWS)


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, text_key, n_shingles, set (a hash of the shingle set, null if empty), bands, ``ODD``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            ids, off = shingle_sets(batch.column("text"), k)
            n = np.diff(off)
            keys = band_keys(signatures(ids, off)).reshape(-1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(n, pa.int64()),
                 pa.array(set_hashes(ids, off).view(np.int64), pa.int64(), mask=n == 0),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * BANDS, pa.int32()), pa.array(keys)),
                 *map(pa.array, parities(ids, off))],
                ["doc_id", "text_key", "n_shingles", "set", "bands", *ODD])
        tw.release()

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        run, "doc_id bigint, text_key bigint, n_shingles bigint, set bigint, bands array<bigint>, " + ", ".join(f"{c} bigint" for c in ODD))


def full_sets(docs: DataFrame, k: int) -> DataFrame:
    """set, ids: the shingle hashes of each row of ``docs`` (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            ids, off = shingle_sets(batch.column("text"), k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(set_hashes(ids, off).view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids.view(np.int64)))], ["set", "ids"])
        tw.release()

    return docs.select("text").mapInArrow(run, "set bigint, ids array<bigint>")


def similar(a: Column, b: Column, percent: int) -> Column:
    shared = F.size(F.array_intersect(a, b))
    return 100 * shared >= percent * (F.size(a) + F.size(b) - shared)


def may_be_similar(percent: int) -> Column:
    """False only where a class (n, ``ODD``) and a centre (m, ``ODD`` with ``centre_``) surely are not similar, by
    sizes and parities: they share at most (n + m - differing cells) / 2 shingles."""
    n, m = F.col("n"), F.col("m")
    apart = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"centre_{c}"))) for c in ODD), F.lit(0))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((n + m - apart) * (100 + percent) >= 2 * percent * (n + m))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, text_key, n_shingles, component_id, kept.

    Words are separated by ASCII white space, A-Z folded.  Two texts are linked when
    their shingle sets have a Jaccard similarity of at least ``percent`` / 100.
    component_id is the least doc_id that links reach, kept says that it is the row's
    own.  Null, empty and blank texts have no shingles and are linked with nothing.
    Rows of one doc_id and text are one document; rows of one doc_id and other texts
    are others.  Null doc_ids are never the least; a component of only such rows has a
    null component_id, and its rows are kept.  Other columns are ignored.
    """
    sketch = stored(sketches(docs, k), "sketches")
    classes = stored(sketch.where("set is not null").groupBy("set").agg(
        F.min("doc_id").alias("label"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("one"),
        F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), *[F.first(c).alias(c) for c in ODD]), "classes")

    # buckets of at least two classes, each with a centre
    entries = classes.select(F.explode("bands").alias("key"), "set", "n")
    buckets = entries.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("set").alias("centre")).where("size > 1")
    members = stored(entries.join(buckets.select("key", "centre"), "key"), "buckets")
    shared = members.select("set").distinct()
    reps = classes.join(shared, "set").select(F.col("one.doc_id").alias("_id"), F.col("one.text_key").alias("_key")).distinct()
    texts = docs.select("doc_id", "text").join(
        reps, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key")), "left_semi")
    sets = stored(full_sets(texts, k).dropDuplicates(["set"]), "sets")

    def checked(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b), each with ``ok``: whether its full sets are similar.  Stored, since links and later rounds read it."""
        with_b = pairs.join(sets.select(F.col("set").alias("b"), F.col("ids").alias("b_ids")), "b")
        with_a = with_b.join(sets.select(F.col("set").alias("a"), F.col("ids").alias("a_ids")), "a")
        return stored(with_a.select("a", "b", similar(F.col("a_ids"), F.col("b_ids"), percent).alias("ok")), "pairs")

    def links(pairs: DataFrame) -> DataFrame:
        return pairs.where("ok").select(F.col("a").alias("u"), F.col("b").alias("v"))

    def pair(a: str, b: str) -> list[Column]:
        return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]

    alike, centre_odd = may_be_similar(percent), [F.col(c).alias(f"centre_{c}") for c in ODD]
    odd = classes.select("set", *ODD)
    sizes = classes.select(F.col("set").alias("centre"), F.col("n").alias("m"), *centre_odd)
    tried = checked(members.where("set <> centre").select("centre", "set", "n").distinct()
                    .join(odd, "set").join(sizes, "centre").where(alike).select(*pair("centre", "set")))
    found = components(links(tried))
    centres = None  # classes that were further centres, by bucket

    for most in iter_centres():
        placed = members.join(found.select(F.col("u").alias("set"), "v"), "set", "left").withColumn("root", F.coalesce("v", "set")).drop("v")
        parts = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
        split = parts.groupBy("key").agg(F.max(F.struct("size", "root"))["root"].alias("major"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
        active = stored(placed.join(split.select("key", "major"), "key").join(odd, "set"), "active")
        left = active.where("root <> major and set <> centre")
        if centres is not None:
            left = left.join(centres, ["key", "set"], "left_anti")
        order = Window.partitionBy("key").orderBy("set")
        ranked = stored(left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most + 1)
                        .select("key", "rank", F.col("set").alias("centre"), F.col("n").alias("m"), F.col("root").alias("centre_root"), *centre_odd), "centres")
        last = ranked.agg(F.max("rank")).first()[0]
        if last is None:
            break
        chosen = ranked.where(F.col("rank") <= most)
        pairs = checked(chosen.join(active.drop("centre"), "key").where((F.col("root") != F.col("centre_root")) & alike)
                        .select(*pair("centre", "set")).distinct().join(tried, ["a", "b"], "left_anti"))
        if not links(pairs).isEmpty():
            found = components(found.unionAll(links(pairs)))
        if last <= most:  # two classes of a bucket that are still apart were apart before, so that one of them has been a centre
            break
        tried = tried.unionAll(pairs)
        now = chosen.select("key", F.col("centre").alias("set"))
        centres = now if centres is None else centres.unionAll(now)

    rooted = classes.select("set", "label").join(found.select(F.col("u").alias("set"), "v"), "set", "left").withColumn("root", F.coalesce("v", "set"))
    least = rooted.groupBy("root").agg(F.min("label").alias("component"))
    named = stored(rooted.join(least, "root").select("set", "component"), "components")
    out = sketch.join(named, "set", "left").withColumn(
        "component_id", F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component")))
    return out.select("doc_id", "text_key", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def iter_centres() -> Iterator[int]:
    yield from CENTRES
    while True:
        yield CENTRES[-1]


def distinct_documents(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` whose document is the least of its component, columns unchanged."""
    gone = (near_duplicates(docs, k, percent).where(~F.col("kept"))
            .select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct())
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key")), "left_anti")
