"""Benchmark decontamination with a distributed positional inverted index.

The index is a table of segments.  A segment covers some consecutive documents
(about ``textwords.SLICE_BYTES`` of text) and holds, for each term of the test
vocabulary, the list of its positions.  Positions count words through the whole
segment, with a gap between documents that no phrase can bridge.

A phrase is looked up from its rarest term (the shortest list in the segment):
the list, shifted by the term's offset in the phrase, gives candidate starts,
which are intersected with the shifted lists of the other terms, next-rarest
first.  Proximity matches are looked up the same way: a window of a test item, cut from it
without overlap, matches where all its distinct words (``LEAST_TERMS`` at least) stand
within ``SPREAD`` words in any order; the places of its rarest word that have each other word
near enough are tried.  So passages with words put in, left out or moved about are found too.
Documents are never shuffled and no pair of documents is formed.

Test items are sent to the tasks in blocks of at most ``BLOCK_BYTES`` of text;
a larger benchmark is done block by block and the results are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textwords as tw
from ledgerlens.llm.storage import stored

WINDOW = 10
BLOCK_BYTES = 2 << 20
#: Words within which a proximity match holds all words of a window, and words that such a window must have.
SPREAD, LEAST_TERMS = 20, 6

SEGMENT = ("doc_ids array<bigint>, text_keys array<bigint>, n_words array<int>, first array<int>, "
           "terms array<bigint>, counts array<int>, steps array<int>")
FOUND = "doc_id bigint, text_key bigint, n_words bigint, starts array<int>, ends array<int>, items array<string>, near array<string>"


class Phrases:
    """Distinct word windows of test items, as rows of term hashes; and, without overlap, their sets of words."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        words = tw.words_of(pa.array([t for _, t in items], pa.string()), tw.ALPHANUMERIC, tw.LOWER)
        owners: dict[bytes, set] = {}
        sets: dict[bytes, set] = {}
        for i, (name, _) in enumerate(items):
            own = words.hash[words.first[i]:words.first[i + 1]]
            for s in range(max(1, len(own) - window + 1) if len(own) else 0):
                owners.setdefault(own[s:s + window].tobytes(), set()).add(None if name is None else str(name))
            for s in {*range(0, len(own) - window + 1, window), max(0, len(own) - window)}:
                terms = tw.distinct(own[s:s + window])
                if len(terms) >= LEAST_TERMS and name is not None:
                    sets.setdefault(terms.tobytes(), set()).add(str(name))
        self.window = window
        self.lengths = np.array([len(k) // 8 for k in owners], np.int64)
        self.terms = np.zeros((len(owners), window), np.uint64)
        for r, k in enumerate(owners):
            self.terms[r, :len(k) // 8] = np.frombuffer(k, np.uint64)
        self.owners = [sorted(x for x in v if x is not None) for v in owners.values()]
        inside = np.arange(window) < self.lengths[:, None]
        self.vocabulary = np.unique(self.terms[inside])
        self.near = [np.frombuffer(k, np.uint64) for k in sets]
        self.near_owners = list(sets.values())
        self.near_terms, self.near_lengths = np.zeros((len(sets), window), np.uint64), np.array([len(x) for x in self.near], np.int64)
        for r, x in enumerate(self.near):
            self.near_terms[r, :len(x)] = x


def build_segment(ids: np.ndarray, keys: np.ndarray, texts: pa.Array, vocabulary: np.ndarray, gap: int) -> dict:
    """Posting lists of the vocabulary's terms over some texts."""
    words = tw.words_of(texts, tw.ALPHANUMERIC, tw.LOWER)
    at = np.arange(len(words.hash)) + words.text_of() * gap
    term = np.searchsorted(vocabulary, words.hash)
    known = np.zeros(0, bool) if not len(vocabulary) else vocabulary[np.minimum(term, len(vocabulary) - 1)] == words.hash
    term, at = term[known], at[known]
    order = np.argsort(term, kind="stable")
    term, at = term[order], at[order]
    held, counts = np.unique(term, return_counts=True)
    steps = np.diff(at, prepend=0)
    if len(held):
        firsts = np.cumsum(counts) - counts
        steps[firsts] = at[firsts]
    return {"doc_ids": ids, "text_keys": keys, "n_words": words.counts(),
            "first": words.first[:-1] + np.arange(len(ids)) * gap,
            "terms": vocabulary[held].view(np.int64) if len(held) else np.zeros(0, np.int64), "counts": counts, "steps": steps}


class Postings:
    """The posting lists of a segment, sorted by term and position."""

    def __init__(self, terms: np.ndarray, counts: np.ndarray, steps: np.ndarray):
        self.terms, self.counts = terms.view(np.uint64), counts.astype(np.int64)
        self.ends = np.cumsum(self.counts)
        self.starts = self.ends - self.counts
        run = np.cumsum(steps.astype(np.int64))
        base = np.zeros(len(self.terms), np.int64)
        base[1:] = run[self.starts[1:] - 1]
        self.at = run - np.repeat(base, self.counts)
        self.span = int(self.at.max()) + 2 if len(self.at) else 2
        self.keys = np.repeat(np.arange(len(self.terms)), self.counts) * self.span + self.at

    def find(self, terms: np.ndarray) -> np.ndarray:
        """Number of each term's list, -1 without one."""
        if not len(self.terms):
            return np.full(terms.shape, -1)
        i = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[i] == terms, i, -1)

    def has(self, lists: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whether each list holds the position."""
        want = lists * self.span + at
        i = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return (self.keys[i] == want) & (at >= 0) & (at < self.span)

    def phrases(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, start) of every exact occurrence."""
        inside = np.arange(phrases.window) < phrases.lengths[:, None]
        lists = np.where(inside, self.find(phrases.terms), -2)
        alive = np.flatnonzero(~(lists == -1).any(axis=1))
        if not len(alive) or not len(self.at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lists = lists[alive]
        sizes = np.where(lists >= 0, self.counts[np.maximum(lists, 0)], np.iinfo(np.int64).max)
        rarest = np.argsort(sizes, axis=1, kind="stable")
        rows = np.arange(len(alive))
        seed = lists[rows, rarest[:, 0]]
        row = np.repeat(rows, self.counts[seed])
        start = self.at[tw.ranges(self.starts[seed], self.counts[seed])] - rarest[row, 0]
        for step in range(1, phrases.window):
            offset = rarest[row, step]
            which = lists[row, offset]
            ok = which == -2  # the phrase is shorter
            ok[~ok] = self.has(which[~ok], start[~ok] + offset[~ok])
            row, start = row[ok], start[ok]
        return alive[row], start

    def nearby(self, phrases: Phrases, span: int = SPREAD) -> list[tuple[int, list[tuple[int, int]]]]:
        """(number of a set of words, its ``proximity`` stretches) of every set that has some."""
        inside = np.arange(phrases.window) < phrases.near_lengths[:, None]
        lists = np.where(inside, self.find(phrases.near_terms), -2)
        alive = np.flatnonzero(~(lists == -1).any(axis=1))
        if not len(alive) or not len(self.at):
            return []
        lists = lists[alive]
        sizes = np.where(lists >= 0, self.counts[np.maximum(lists, 0)], np.iinfo(np.int64).max)
        rarest = np.argsort(sizes, axis=1, kind="stable")
        seed = lists[np.arange(len(alive)), rarest[:, 0]]
        row = np.repeat(np.arange(len(alive)), self.counts[seed])
        at = self.at[tw.ranges(self.starts[seed], self.counts[seed])]
        for step in range(1, phrases.window):
            which = lists[row, rarest[row, step]]
            ok = which == -2  # the set is smaller
            base, place = which[~ok] * self.span, at[~ok]
            i = np.minimum(np.searchsorted(self.keys, base + np.maximum(place - span + 1, 0)), len(self.keys) - 1)
            ok[~ok] = (self.keys[i] >= base) & (self.keys[i] < base + np.minimum(place + span, self.span))
            row, at = row[ok], at[ok]
        found = ((int(r), self.proximity(phrases.near[r], span)) for r in alive[tw.distinct(row)])
        return [(r, stretches) for r, stretches in found if stretches]

    def proximity(self, terms: np.ndarray, span: int) -> list[tuple[int, int]]:
        """[start, end) of the shortest stretches of at most ``span`` positions that
        begin with one of ``terms`` and hold them all, in any order."""
        lists = self.find(np.unique(np.asarray(terms, np.uint64)))
        if not len(lists) or (lists < 0).any():
            return []
        near = [self.at[self.starts[i]:self.ends[i]] for i in sorted(lists, key=lambda i: self.counts[i])]
        left = np.unique(np.concatenate(near))
        i = np.searchsorted(near[0], left - span + 1)  # only around the rarest term
        left = left[(i < len(near[0])) & (near[0][np.minimum(i, len(near[0]) - 1)] < left + span)]
        right = left.copy()
        for own in near:
            i = np.searchsorted(own, left)
            right = np.maximum(right, np.where(i < len(own), own[np.minimum(i, len(own) - 1)], left + span))
        ok = right - left < span
        left, right = left[ok], right[ok]
        shortest = np.append(right[1:] > right[:-1], True) if len(right) else np.zeros(0, bool)
        return [(int(a), int(b) + 1) for a, b in zip(left[shortest], right[shortest], strict=True)]



def index_documents(docs: DataFrame, phrases: Phrases) -> DataFrame:
    """Segments over all rows of ``docs`` (doc_id, text_key, text)."""
    # a gap, so that no shifted list and no stretch can meet another document's positions
    vocabulary, gap = docs.sparkSession.sparkContext.broadcast(phrases.vocabulary), max(phrases.window, SPREAD)
    kinds = {"doc_ids": pa.int64(), "text_keys": pa.int64(), "n_words": pa.int32(), "first": pa.int32(),
             "terms": pa.int64(), "counts": pa.int32(), "steps": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tw.small_batches(batches, "text"):
            s = build_segment(batch.column("doc_id"), batch.column("text_key"), batch.column("text"), vocabulary.value, gap)
            yield pa.RecordBatch.from_arrays([pa.array([s[k]], pa.list_(kind)) if isinstance(s[k], np.ndarray)
                                              else pa.ListArray.from_arrays(pa.array([0, len(s[k])], pa.int32()), s[k])
                                              for k, kind in kinds.items()], list(kinds))
        tw.release()

    return docs.select("doc_id", "text_key", "text").mapInArrow(run, SEGMENT)


def search(segments: DataFrame, phrases: Phrases) -> DataFrame:
    """A row for each document of the segments: its merged hit intervals
    ``[starts, ends)`` in words, the items of the phrases found in it, and those with
    proximity matches."""
    sent = segments.sparkSession.sparkContext.broadcast(phrases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = sent.value
        for batch in batches:
            for r in range(batch.num_rows):
                col = {n: batch.column(n)[r].values for n in batch.schema.names}
                val = {n: v.to_numpy(zero_copy_only=False) for n, v in col.items() if n not in ("doc_ids", "text_keys")}
                lists = Postings(val["terms"], val["counts"], val["steps"])
                phrase, start = lists.phrases(queries)
                n, first = val["n_words"].astype(np.int64), val["first"].astype(np.int64)
                doc = np.searchsorted(first, start, "right") - 1
                begin = start - first[doc]
                order = np.lexsort((begin, doc))
                phrase, begin, doc = phrase[order], begin[order], doc[order]
                end = begin + queries.lengths[phrase]
                starts, ends, items = [[] for _ in n], [[] for _ in n], [set() for _ in n]
                for p, d, s, e in zip(phrase.tolist(), doc.tolist(), begin.tolist(), end.tolist(), strict=True):
                    items[d].update(queries.owners[p])
                    if ends[d] and s <= ends[d][-1]:
                        ends[d][-1] = max(ends[d][-1], e)
                    else:
                        starts[d].append(s)
                        ends[d].append(e)
                near = [set() for _ in n]
                for p, stretches in lists.nearby(queries):
                    for d in np.searchsorted(first, [s for s, _ in stretches], "right") - 1:
                        near[d].update(queries.near_owners[p])
                yield pa.RecordBatch.from_arrays(
                    [col["doc_ids"], col["text_keys"], pa.array(n, pa.int64()), pa.array(starts, pa.list_(pa.int32())),
                     pa.array(ends, pa.list_(pa.int32())), *[pa.array([sorted(x) for x in names], pa.list_(pa.string())) for names in (items, near)]],
                    ["doc_id", "text_key", "n_words", "starts", "ends", "items", "near"])
        tw.release()

    return segments.mapInArrow(run, FOUND)




def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, text_key, n_words, n_hit
    (words inside an occurrence of a window), items (sorted, distinct, as strings) and near (the same, of the
    items with a proximity match).

    Words are runs of a-z (A-Z folded), 0-9 and characters beyond ASCII.  A window
    is ``window`` consecutive words of an item, or the whole item if it has fewer.
    Null and empty texts have no words; items without words match nothing; null
    item_ids hit but are not named.  Repeated rows give repeated results; an empty
    benchmark gives no hits.  Other columns are ignored.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    tests = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    found = None
    for b in range(blocks):
        block = tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        phrases = Phrases([(r["item_id"], r["text"]) for r in block.collect()], window)  # one block, of bounded size
        part = search(stored(index_documents(rows, phrases), "postings"), phrases)
        found = part if found is None else found.unionAll(part)
    if blocks > 1:  # a row, or n equal rows, gave `blocks` results each
        found = (found.groupBy("doc_id", "text_key", "n_words")
                 .agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"),
                      *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("items", "near")], F.count(F.lit(1)).alias("_n"))
                 .withColumn("_copy", F.explode(F.sequence(F.lit(1), (F.col("_n") / blocks).cast("int")))))
        # merged intervals: those that begin beyond all earlier ends
        pairs = F.array_sort(F.arrays_zip("starts", "ends"))
        n_hit = F.aggregate(pairs, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach")),
                            lambda a, p: F.struct((a["n"] + F.greatest(F.lit(0), p["ends"] - F.greatest(p["starts"], a["reach"]))).alias("n"),
                                                  F.greatest(a["reach"], p["ends"]).alias("reach")), lambda a: a["n"])
    else:
        n_hit = F.aggregate(F.zip_with("starts", "ends", lambda s, e: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select("doc_id", "text_key", "n_words", n_hit.alias("n_hit"), "items", "near")


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows of ``docs`` that hold no window of the benchmark, columns unchanged."""
    hit = (contamination(docs, benchmark, window).where("n_hit > 0")
           .select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct())
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key")), "left_anti")
