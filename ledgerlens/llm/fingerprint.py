"""Document fingerprints: a homomorphic multiset hash (DataFrame functions only).

A text is the multiset of its paragraphs (non-empty lines).  Each paragraph is
hashed to a wide vector and the vectors are summed lane by lane modulo powers of
two, so the order of the paragraphs does not matter, and a paragraph is inserted
or deleted by adding or subtracting its vector (``insert``, ``delete``).

Lanes of a paragraph's vector:

* ``WIDE`` lanes of 32 bits, independent hashes of the whole paragraph; they
  decide equality.
* ``PACKED`` longs of a 32-bit and a 28-bit lane: how many of the paragraph's
  phrases (three words each, one from every word that two others follow) have a
  given hash bit set.  With the number of phrases, a lane gives a sum of random
  signs, and the cosine of two such vectors estimates the likeness of the texts.
  Phrases overlap, so a word put in or taken out changes three of them at most.
  A packed long is a sum modulo 2**60; its lanes hold any text of fewer than 2**28
  phrases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.sharding import key_of, lookup, range_of, sampled_ranges

WIDE = 8
QUARTERS = 4  # a 64-bit hash is four longs of sixteen 4-bit counters
GROUP = 15  # so many phrases fit the 4-bit counters
PHRASE = 3
EIGHTHS = 8  # a long of 4-bit counters is eight longs of two lanes, the last of one
PACKED = QUARTERS * EIGHTHS
LANE_BITS = 32
LANE = (1 << LANE_BITS) - 1
WIDE_MASK = (1 << 32) - 1
PACK_MASK = (1 << 60) - 1
NIBBLE_BITS = int("1" * 15, 16)  # the low bit of each 4-bit counter but the top one
NIBBLES = 0xF | 0xF << LANE_BITS
#: Rows of a table are put in order in ranges of about so many bytes.
RANGE_BYTES = 4 << 20
MAX_RANGES = 1 << 16

NAMES = [f"w{i}" for i in range(WIDE)] + ["n"] + [f"p{i}" for i in range(PACKED)]


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda p: p != "")


def phrase_hashes(paragraph: Column) -> Column:
    """Hashes of the paragraph's phrases: ``PHRASE`` words from each place, or all of fewer."""
    words = F.transform(F.filter(F.split(paragraph, " "), lambda w: w != ""), lambda w: F.xxhash64(w))
    phrases = F.transform(F.array(words), lambda w: F.transform(  # a lambda, so that the words are hashed once
        F.when(F.size(w) > 0, F.sequence(F.lit(0), F.greatest(F.size(w) - PHRASE, F.lit(0)))).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(PHRASE)])))
    return phrases[0]


def _zero(names: list[str]) -> Column:
    return F.struct(*[F.lit(0).cast("long").alias(n) for n in names])


def _counted(hashes: Column) -> Column:
    """How many of at most ``GROUP`` hashes have each bit set, in 4-bit counters."""
    names = [f"q{i}" for i in range(QUARTERS)]
    return F.aggregate(hashes, _zero(names), lambda acc, h: F.struct(*[
        (acc[q] + F.shiftrightunsigned(h, i).bitwiseAND(F.lit(NIBBLE_BITS))).alias(q) for i, q in enumerate(names)]))


def _sign_counts(hashes: Column) -> Column:
    groups = F.transform(F.sequence(F.lit(0), F.floor((F.size(hashes) - 1) / GROUP).cast("int")),
                         lambda g: _counted(F.slice(hashes, g * GROUP + 1, GROUP)))
    return F.aggregate(
        F.when(F.size(hashes) > 0, groups), F.struct(F.size(hashes).cast("long").alias("n"), *[F.lit(0).cast("long").alias(f"p{i}") for i in range(PACKED)]),
        lambda acc, g: F.struct(acc["n"].alias("n"), *[
            (acc[f"p{i}"] + F.shiftrightunsigned(g[f"q{i // EIGHTHS}"], 4 * (i % EIGHTHS)).bitwiseAND(F.lit(NIBBLES)))
            .bitwiseAND(F.lit(PACK_MASK)).alias(f"p{i}") for i in range(PACKED)]))


def vector(text: Column) -> Column:
    """The fingerprint vector of a text (null: the empty text), a struct of longs."""
    text = F.coalesce(text, F.lit(""))
    wide = F.aggregate(
        paragraphs(text), _zero(NAMES[:WIDE]),
        lambda acc, p: F.struct(*[(acc[f"w{i}"] + F.xxhash64(F.lit(i), p).bitwiseAND(F.lit(WIDE_MASK))).bitwiseAND(F.lit(WIDE_MASK)).alias(f"w{i}")
                                  for i in range(WIDE)]))
    hashes = F.flatten(F.transform(paragraphs(text), phrase_hashes))
    packed = F.transform(F.array(hashes), _sign_counts)[0]  # a lambda, so that the hashes are made once
    packed = F.coalesce(packed, _zero(NAMES[WIDE:]))
    return F.struct(wide.alias("wide"), packed.alias("packed"))


def _lanes(v: Column) -> Column:
    """Sums of random signs, one for each lane."""
    low = [v["packed"][f"p{i}"].bitwiseAND(F.lit(LANE)) for i in range(PACKED)]
    high = [F.shiftrightunsigned(v["packed"][f"p{i}"], LANE_BITS) for i in range(PACKED) if i % EIGHTHS < EIGHTHS - 1]
    return F.transform(F.array(*low, *high), lambda c: c * 2.0 - v["packed"]["n"])


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: 1 for equal vectors, else the cosine of the sign sums, at least 0."""
    x, y = _lanes(a), _lanes(b)
    cosine = _dot(x, y) / F.sqrt(F.greatest(_dot(x, x) * _dot(y, y), F.lit(1.0)))
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def as_string(v: Column) -> Column:
    """Fixed-width lowercase hex of all lanes."""
    return F.lower(F.concat(*[F.lpad(F.hex(v["wide"][f"w{i}"]), 8, "0") for i in range(WIDE)],
                            *[F.lpad(F.hex(v["packed"][n]), 16, "0") for n in NAMES[WIDE:]]))


def _combined(a: Column, b: Column, sign: int) -> Column:
    return F.struct(
        F.struct(*[F.pmod(a["wide"][n] + sign * b["wide"][n], F.lit(WIDE_MASK + 1)).alias(n) for n in NAMES[:WIDE]]).alias("wide"),
        F.struct((a["packed"]["n"] + sign * b["packed"]["n"]).alias("n"),
                 *[F.pmod(a["packed"][n] + sign * b["packed"][n], F.lit(PACK_MASK + 1)).alias(n) for n in NAMES[WIDE + 1:]]).alias("packed"))


def insert(v: Column, added: Column) -> Column:
    """Vector of a text after the paragraphs of vector ``added`` were put in."""
    return _combined(v, added, 1)


def delete(v: Column, removed: Column) -> Column:
    """Vector of a text after the paragraphs of vector ``removed`` were taken out."""
    return _combined(v, removed, -1)


def with_next(df: DataFrame, key: str, tie: Column, size: Column, carry: list[str]) -> DataFrame:
    """``df`` with ``next_<c>`` for each column ``c`` of ``carry``: its value in the
    row that follows in descending order of ``key`` (after the last: the first).

    Rows are ordered in ranges of near equal size.  The row that begins a range is
    also sent, as a ghost, to the range before it, so no range needs another and
    each row's text is shuffled once.  Null keys come last; rows of equal keys
    follow each other by ``tie``.
    """
    rows = df.select(*df.columns, key_of(key).alias("_key"), key_of(tie).alias("_tie"), size.cast("long").alias("_size"))
    slim = rows.select("_key", "_tie", "_size")
    total = slim.agg(F.sum("_size")).first()[0] or 0
    bounds, totals = sampled_ranges(slim, parts=min(MAX_RANGES, max(1, -(-total // RANGE_BYTES))))
    here = range_of(bounds, F.col("_key"), F.col("_tie"))
    tops = {r["_range"]: r["top"] for r in
            slim.groupBy(here.alias("_range")).agg(F.max(F.struct("_key", "_tie")).alias("top")).collect()}
    held = sorted(tops)
    above = {r: held[(i + 1) % len(held)] for i, r in enumerate(held)}  # the highest row wraps to the lowest range
    n = len(bounds) + 1
    col = lambda f: lookup([f(r) if r in tops else 0 for r in range(n)], F.col("_range"))
    is_top = (F.col("_key") == col(lambda r: tops[r]["_key"])) & (F.col("_tie") == col(lambda r: tops[r]["_tie"]))
    places = F.when(is_top, F.array(F.struct(F.col("_range").cast("long").alias("r"), F.lit(0).alias("ghost")),
                                    F.struct(col(lambda r: above[r]).alias("r"), F.lit(1).alias("ghost")))).otherwise(
        F.array(F.struct(F.col("_range").cast("long").alias("r"), F.lit(0).alias("ghost"))))
    order = Window.partitionBy("_r").orderBy("_ghost", F.col("_key").desc(), F.col("_tie").desc())
    spread = (rows.withColumn("_range", here).withColumn("_place", F.explode(places))
              .select(*df.columns, "_key", "_tie", F.col("_place.r").alias("_r"), F.col("_place.ghost").alias("_ghost")))
    followed = spread.select(*df.columns, "_ghost", *[F.lead(c).over(order).alias(f"next_{c}") for c in carry])
    return followed.where("_ghost = 0").drop("_ghost")


def edited_text(text: Column, following: Column, n_chars: Column) -> Column:
    """The last floor(n/3) code points replaced by the first as many of ``following``."""
    k = F.floor(n_chars / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), (n_chars - k).cast("int")), F.substring(following, F.lit(1), k))


def fingerprints(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``vector`` and ``fingerprint`` of each whole text (null: empty).
    Input columns of those names are replaced."""
    keep = [c for c in df.columns if c not in ("vector", "fingerprint")]
    return (df.withColumn("_v", vector(F.col(text)))
            .select(*keep, F.col("_v").alias("vector"), as_string(F.col("_v")).alias("fingerprint")))
