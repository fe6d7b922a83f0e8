"""Substring de-duplication with an FM-index for each shard.

Each window of ``WINDOW`` words has an anchor: the least hash among its word
sequences of ``GRAM``.  Equal windows have equal anchors.  Consecutive windows that
have their anchor at the same place form a run.  So

1. runs whose anchor occurs once hold no repeat and are left out;
2. equal runs are one: all but the first are repeats as a whole;
3. the different runs of an anchor go to one shard, where an FM-index is built over
   them, they are streamed against it, and matching statistics give the windows that
   occur in several places; all but the first of each are repeats.

An anchor with very many different runs would overfill a shard.  Its runs are divided
into single windows, for which steps 1 and 2 are the whole answer.

The work is proportional to the text: no document meets another but through a
shared anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textwords as tw
from ledgerlens.llm.bloom import bloom_bits, maybe_in
from ledgerlens.llm.fmindex import FMIndex
from ledgerlens.llm.storage import arrow_rows, stored

WINDOW = 20
GRAM = 6
#: Words in a shard, about.
SHARD_WORDS = 400_000
#: An anchor whose different runs have more words than this is divided into windows.
HOT_WORDS = 100_000
#: Words and runs sent on at once; texts (with their runs) handed to a Python worker at once.
OUT_WORDS, BATCH_TEXTS = 200_000, 500

LAST = (1 << 63) - 1

PLACE_BITS = 24
_PLACE = np.uint64((1 << PLACE_BITS) - 1)


def document_order() -> list[Column]:
    """doc_id (null: last) and a hash of the text: the order in which texts come first."""
    return [F.coalesce(F.col("doc_id"), F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("text_key")]


def find_runs(words: tw.Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, anchor) of each run; windows are numbered by their first word."""
    n = len(words.hash) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = tw.sequence_hashes(words.hash, gram)
    # least hash in its upper bits, then leftmost: one number decides both
    place = np.arange(len(grams), dtype=np.uint64) & _PLACE
    least, span, width = (grams & ~_PLACE) | place, window - gram + 1, 1
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    start = np.arange(n)
    at = start + ((least & _PLACE).astype(np.int64) - start) % (1 << PLACE_BITS)
    least = grams[at]
    text = words.text_of()
    valid = np.flatnonzero(text[:n] == text[window - 1:])
    if not len(valid):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    opens = np.ones(len(valid), bool)
    opens[1:] = (valid[1:] != valid[:-1] + 1) | (at[valid[1:]] != at[valid[:-1]]) | (text[valid[1:]] != text[valid[:-1]])
    first = np.flatnonzero(opens)
    size = np.diff(np.append(first, len(valid)))
    return valid[first], size, least[valid[first]]


def stretch_hashes(hashes: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each stretch of words, by doubling: blocks of 1, 2, 4 ... words."""
    out = lengths.astype(np.uint64)
    block, width, at, left = hashes, 1, first.copy(), lengths.copy()
    codes = tw.random_words(2 * 64, 4242)
    level = 0
    with np.errstate(over="ignore"):
        while left.any():
            odd = (left & width) > 0
            out[odd] = tw.mix(out[odd] * codes[level] + block[at[odd]])
            at[odd] += width
            left = np.where(odd, left - width, left)
            nxt = tw.mix(block[:-width] * (codes[level + 64] | np.uint64(1)) + block[width:]) if len(block) > width else block[:0]
            block, width, level = nxt, width * 2, level + 1
    return out


def runs(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """doc, text_key, start, n (windows), anchor, content (a hash of the run's words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tw.small_batches(batches, "text"):
            words = tw.words_of(batch.column("text"), tw.SPACE_SEPARATED)
            begin, n, anchor = find_runs(words, window, gram)
            text = np.searchsorted(words.first, begin, "right") - 1
            content = stretch_hashes(words.hash, begin, n + window - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(pa.array(text)), batch.column("text_key").take(pa.array(text)), pa.array(begin - words.first[text], pa.int32()),
                 pa.array(n, pa.int32()), pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64))],
                ["doc", "text_key", "start", "n", "anchor", "content"])

    return docs.select(*document_order(), "text").mapInArrow(
        run, "doc bigint, text_key bigint, start int, n int, anchor bigint, content bigint")


def run_words(texts: DataFrame, window: int) -> DataFrame:
    """anchor, hot, doc, text_key, start, words: the words of the runs in column ``runs`` of
    ``texts`` (doc, text_key, text, runs); hot runs as single windows, anchored by their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tw.small_batches(batches, "text"):
            words = tw.words_of(batch.column("text"), tw.SPACE_SEPARATED)
            wanted = batch.column("runs")
            text = np.repeat(np.arange(batch.num_rows), wanted.value_lengths().to_numpy())
            inner = wanted.flatten()
            start, n, hot, anchor = (inner.field(f).to_numpy(zero_copy_only=False) for f in ("start", "n", "hot", "anchor"))
            again = np.where(hot, n, 1)
            which = np.repeat(np.arange(len(start)), again)
            start = start[which] + (np.arange(len(which)) - np.repeat(np.cumsum(again) - again, again))
            hot, text, anchor, size = hot[which], text[which], anchor[which].copy(), np.where(hot[which], window, n[which] + window - 1)
            at = words.first[text] + start
            if hot.any():
                anchor[hot] = stretch_hashes(words.hash, at[hot], size[hot]).view(np.int64)
            held = np.where(hot, 0, size)  # single windows need no words
            upto, i = np.cumsum(held + 1), 0
            while i < len(held):  # the words of a slice's runs overlap, so they come out in pieces
                j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + OUT_WORDS, "right")))
                own = slice(i, j)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[own], pa.int64()), pa.array(hot[own], pa.bool_()), batch.column("doc").take(pa.array(text[own])),
                     batch.column("text_key").take(pa.array(text[own])), pa.array(start[own], pa.int32()),
                     pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(held[own])]), pa.int32()),
                                              pa.array(words.hash[tw.ranges(at[own], held[own])].view(np.int64)))],
                    ["anchor", "hot", "doc", "text_key", "start", "words"])
                i = j

    return texts.select("doc", "text_key", "text", "runs").mapInArrow(
        run, "anchor bigint, hot boolean, doc bigint, text_key bigint, start int, words array<bigint>")


def shard_repeats(table: pa.Table, window: int) -> pa.Table:
    """Repeated stretches of one shard's runs: (doc, text_key, start, end) in words."""
    table = table.sort_by([("doc", "ascending"), ("text_key", "ascending"), ("start", "ascending")])
    lists = table.column("words").combine_chunks()
    lengths = lists.value_lengths().to_numpy().astype(np.int64)
    index = FMIndex(words=lists.flatten().to_numpy().view(np.uint64), lengths=lengths)
    n = lengths - window + 1
    run = np.repeat(np.arange(len(n)), n)
    offset = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    begin = index.start[run] + offset
    length, suffix = index.matching_statistics(index.text, begin + window, window, others=2)
    found = np.flatnonzero(length == window)
    # equal windows share their interval; the text is in document order, so the first place is the earliest
    _, earliest, group = np.unique(suffix[found], return_index=True, return_inverse=True)
    later = found[earliest[group] != np.arange(len(found))]
    run, offset = run[later], offset[later]
    opens = np.ones(len(later), bool)
    opens[1:] = (run[1:] != run[:-1]) | (offset[1:] != offset[:-1] + 1)
    last = np.append(np.flatnonzero(opens)[1:] - 1, len(later) - 1) if len(later) else np.zeros(0, np.int64)
    run, offset, end = run[opens], offset[opens], offset[last] + window
    start = table.column("start").to_numpy()[run]
    return pa.table({"doc": table.column("doc").take(pa.array(run)), "text_key": table.column("text_key").take(pa.array(run)),
                     "start": pa.array(start + offset, pa.int32()), "end": pa.array(start + end, pa.int32())})


def repeated_stretches(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc, text_key, cuts: for each document with repeats, its stretches [start, end) of
    words that are covered by windows which start earlier elsewhere."""
    doc = ["doc", "text_key"]
    all_runs = runs(docs, window, gram)
    often = all_runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("anchor")
    shared = stored(all_runs.join(often, "anchor"), "runs")
    firsts = stored(shared.groupBy("anchor", "content").agg(F.min(F.struct(*doc, "start", "n")).alias("first")), "first-runs")
    stretch = lambda start, n: [start.alias("start"), (start + n + (window - 1)).cast("int").alias("end")]
    whole = (shared.join(firsts, ["anchor", "content"])
             .where((F.col("doc") != F.col("first.doc")) | (F.col("text_key") != F.col("first.text_key")) | (F.col("start") != F.col("first.start")))
             .select(*doc, *stretch(F.col("start"), F.col("n"))))

    several = (firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col("first.n") + (window - 1)).alias("_words")).where("_n > 1")
               .select("anchor", (F.col("_words") > HOT_WORDS).alias("hot"), "_words"))
    wanted = stored(firsts.join(several, "anchor").groupBy("first.doc", "first.text_key").agg(
        F.collect_list(F.struct("first.start", "first.n", "hot", "anchor")).alias("runs")), "wanted")
    bits = bloom_bits(wanted, "text_key")
    texts = maybe_in(docs.select(*document_order(), "text"), "text_key", bits).dropDuplicates(doc).join(wanted, doc)
    with arrow_rows(docs.sparkSession, BATCH_TEXTS):
        cut = stored(run_words(texts, window), "run-words")

    total = several.where("not hot").agg(F.sum("_words")).first()[0] or 0
    shards = max(1, -(-total // SHARD_WORDS))
    by_shard = cut.where("not hot").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    fm = by_shard.groupBy("shard").applyInArrow(lambda t: shard_repeats(t, window), "doc bigint, text_key bigint, start int, end int")

    single = cut.where("hot").select("anchor", *doc, "start")
    earliest = single.groupBy("anchor").agg(F.min(F.struct(*doc, "start")).alias("first"))
    hot = single.join(earliest, "anchor").where(F.struct(*doc, "start") != F.col("first")).select(*doc, *stretch(F.col("start"), F.lit(1)))
    return stored(whole.unionAll(fm).unionAll(hot).groupBy(*doc).agg(F.collect_list(F.struct("start", "end")).alias("cuts")), "cuts")


def _kept(docs: DataFrame, cuts: bool) -> DataFrame:
    """doc, text_key, n_words, n_removed, kept: each text's words without ``cuts``, joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tw.small_batches(batches, "text"):
            n_words, n_removed, kept = [], [], []
            gone = batch.column("cuts").to_pylist() if cuts else [()] * batch.num_rows
            for text, stretches in zip(batch.column("text").to_pylist(), gone, strict=True):
                words = (text or "").encode().split()
                if stretches:
                    out = tw.covered(len(words), np.array([c["start"] for c in stretches]), np.array([c["end"] for c in stretches]))
                    rest = [w for w, x in zip(words, out.tolist(), strict=True) if not x]
                else:
                    rest = words
                n_words.append(len(words))
                n_removed.append(len(words) - len(rest))
                kept.append(b" ".join(rest))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("text_key"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept])], ["doc", "text_key", "n_words", "n_removed", "kept_sha256"])

    return docs.mapInArrow(run, "doc bigint, text_key bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_sha256.

    Words are separated by ASCII white space and taken unchanged.  A word is removed if a
    window of ``window`` words around it also starts earlier: in a smaller doc_id (null:
    last; equal doc_ids: by a hash of the text) or earlier in the same text.  Windows are
    judged on the input.  Texts of fewer words, empty and null ones lose nothing.  Rows of
    one doc_id and text are one document.  Other columns are ignored.
    """
    doc = ["doc", "text_key"]
    cuts = repeated_stretches(docs, window)
    rows = docs.select("doc_id", *document_order(), "text")
    bits = bloom_bits(cuts, "text_key")
    changed = _kept(maybe_in(rows.select(*doc, "text"), "text_key", bits).dropDuplicates(doc).join(cuts, doc), True)
    with arrow_rows(docs.sparkSession, BATCH_TEXTS):
        changed = stored(changed.select(*doc, "n_removed", F.col("kept_sha256").alias("_kept")), "changed")
    base = _kept(rows.select(*doc, "text"), False).select(*doc, "n_words", "kept_sha256")
    out = base.join(changed, doc, "left")
    return out.select(F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"), "n_words",
                      F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("_kept", "kept_sha256").alias("kept_sha256"))
