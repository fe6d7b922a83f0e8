"""Line de-duplication by an exact set-similarity join.

A line is the set of its words (ASCII white space between them, A-Z folded).  Two
lines match when the Jaccard similarity of their sets is at least ``PERCENT`` / 100.

1. Word counts of the whole corpus go into a sketch of fixed size.  It orders the
   words of a line from rare to frequent (ties by hash).
2. Each line is posted once by the hash of its set: of equal sets all but the first line are
   removed (a task sends only its first one).  Lines of more than three words are also posted by
   the words of their prefix, the first n - ceil(0.8 n) + 1: lines that match share one of those.
   Postings are dealt to groups of lists as packed arrays.
3. In a word's list, pairs must also pass the length filter, the positional filter and a bitmap
   bound of their difference (128 bits for lines of ``LONG`` words or more, else 64).  A line is paired with
   the ``EARLIEST`` earlier lines that pass with the least difference of their bitmaps, for a start.
4. Pairs are verified on the full sets, which are read from the texts for the lines in pairs
   only; a line with an earlier match is removed.
5. A line that had more earlier candidates than were tried, and no match among them,
   is then paired with all of them, by word and band of sizes.  Lists of very frequent words are
   divided at random in step 2 and completed here.

Lists of up to three words match equal sets only and are not posted by word.

A line is known by its doc_id, the 64-bit hash of its text (only where the doc_id may occur more than once) and its number.  Words are compared by some 46 bits
of their hash (42 and the count's byte) inside a line, 32 in lists, 40 when pairs are verified; sets by 64.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textwords as tw
from ledgerlens.llm.bloom import bitmap, bitmaps, in_bitmap
from ledgerlens.llm.storage import arrow_rows, stored

PERCENT = 80
EARLIEST = 24
LONG = 64
#: Counters of the sketch, sent to the tasks as one byte each.
COUNTER_BITS = 20
BLOCK = 1 << 12
#: Text whose postings make one group of lists (a posting for each 35 bytes or so).
GROUP_BYTES = 8 << 20
#: Lists of words that occur more often than this are divided.
LONG_LIST = 1_000_000
#: Of a longer list, only so many of the earliest lines are partners at first.
PARTNERS = 5_000
#: Pairs held at once, few enough for a core's cache.
PAIRS = 1 << 15
#: Equal lines that a task leaves out after the first; forgotten at this many.
SEEN = 100_000
#: Postings that a task holds before it sends them.
HELD = 300_000

#: Texts handed to a Python worker at once, and bytes of them handled at once.
BATCH_TEXTS, TEXT_SLICE = 2_000, 1 << 20

#: Lines handled at once; their numbers and the words' order share 64 bits.
LINES_BITS = 14
WORD_BITS = 42
U64 = np.uint64

LAST = (1 << 63) - 1
LINE = ["doc", "key", "line"]


def line_order() -> list[Column]:
    """doc (null doc_ids last) and key of a document: rows of one doc_id and text are one."""
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text", F.lit("no doc_id"))).otherwise(F.xxhash64("text"))
    return [F.coalesce(F.col("doc_id"), F.lit(LAST)).alias("doc"), key.alias("key")]


def line_hash(doc: np.ndarray, key: np.ndarray, line: np.ndarray) -> np.ndarray:
    """64 bits for a line (or, with line -1, a text), for the bitmaps."""
    with np.errstate(over="ignore"):
        return tw.mix(tw.mix(doc.view(U64) + U64(1)) ^ (key.view(U64) + line.astype(np.int64).view(U64) * U64(0x9E3779B97F4A7C15))).view(np.int64)


def hash_bitmap(lines: DataFrame, of_text: bool = False) -> np.ndarray:
    """Bitmap of the ``line_hash`` of lines (doc, key, line), or of their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, key, line = (batch.column(c).to_numpy() for c in LINE)
            yield pa.RecordBatch.from_arrays([pa.array(line_hash(doc, key, np.full(len(doc), -1) if of_text else line))], ["hash"])

    return bitmap(lines.select(*LINE).mapInArrow(run, "hash bigint"), "hash")


def text_and_line_bitmaps(lines: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """``hash_bitmap`` of the texts and of the lines, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, key, line = (batch.column(c).to_numpy() for c in LINE)
            hashes = np.concatenate([line_hash(doc, key, np.full(len(doc), -1)), line_hash(doc, key, line)])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat([0, 1], len(doc)), pa.int32()), pa.array(hashes)], ["which", "hash"])

    return tuple(bitmaps(lines.select(*LINE).mapInArrow(run, "which int, hash bigint"), "hash", "which", 2))


def repeated_ids(docs: DataFrame) -> np.ndarray:
    """Bitmap of the doc_ids that occur more than once."""
    doc = line_order()[0]
    twice = docs.groupBy(doc).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return hash_bitmap(twice.select("doc", F.lit(0).cast("long").alias("key"), F.lit(-1).alias("line")))


def own_keys(doc: np.ndarray, key: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    """The key of a text: its hash where the doc_id alone may not tell it apart, else zero."""
    zero = np.zeros(len(doc), np.int64)
    return np.where((doc == LAST) | in_bitmap(repeated, line_hash(doc, zero, zero - 1)), key, 0)


class Lines:
    """Word sets of some lines, each from rare to frequent words.  The words of line i are
    ``words[first[i]:first[i] + size[i]]``: level of the count, then bits of the hash."""

    def __init__(self, lines: pa.Array, level_of: np.ndarray):
        words = tw.words_of(lines, tw.SPACE_SEPARATED, tw.LOWER)
        n = len(lines)
        level = level_of[bucket_of(words.hash)].astype(U64)
        owner = words.text_of().astype(U64)
        both = tw.distinct((owner << U64(64 - LINES_BITS)) | (level << U64(WORD_BITS)) | (words.hash >> U64(64 - WORD_BITS)))
        self.words, self.owner = both & U64((1 << (64 - LINES_BITS)) - 1), (both >> U64(64 - LINES_BITS)).astype(np.int64)
        self.size = np.bincount(self.owner, minlength=n)
        self.first = np.cumsum(self.size) - self.size
        with np.errstate(over="ignore"):
            sums = np.concatenate([[U64(0)], np.cumsum(tw.mix(self.words + U64(1)))])
            self.set = tw.mix(sums[self.first + self.size] - sums[self.first] + self.size.astype(U64))


def line_blocks(batch: pa.RecordBatch, level_of: np.ndarray, repeated: np.ndarray, asked: np.ndarray | None = None) -> Iterator[tuple[dict[str, np.ndarray], Lines]]:
    """(doc, key and line, word sets) of the lines of some texts, a block at a time; with ``asked``, of the lines that may be in that bitmap."""
    split = pc.split_pattern(pc.fill_null(batch.column("text").cast(pa.large_string()), ""), "\n")
    lines, n_lines = split.flatten(), split.value_lengths().to_numpy().astype(np.int64)
    text = np.repeat(np.arange(batch.num_rows), n_lines)
    number = np.arange(len(lines)) - np.repeat(np.cumsum(n_lines) - n_lines, n_lines)
    doc, key = (batch.column(c).to_numpy() for c in ("doc", "key"))
    key = own_keys(doc, key, repeated)
    if asked is not None:
        use = in_bitmap(asked, line_hash(doc[text], key[text], number))
        lines, text, number = lines.filter(pa.array(use)), text[use], number[use]
    for i in range(0, len(lines), 1 << LINES_BITS):
        own = slice(i, i + (1 << LINES_BITS))
        yield {"doc": doc[text[own]], "key": key[text[own]], "line": number[own]}, Lines(lines.slice(i, 1 << LINES_BITS), level_of)


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    """Counter of words."""
    return (hashes & U64((1 << COUNTER_BITS) - 1)).astype(np.int64)


def rarity(docs: DataFrame) -> np.ndarray:
    """One byte for each counter: four times the logarithm (base 2) of its words' count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTER_BITS, np.int64)
        for batch in tw.small_batches(batches, "text", TEXT_SLICE):
            words = tw.words_of(batch.column("text"), tw.SPACE_SEPARATED, tw.LOWER)
            np.add.at(total, bucket_of(words.hash), 1)
        parts = total.reshape(-1, BLOCK)
        held = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array([zlib.compress(parts[i].tobytes(), 1) for i in held], pa.binary())], ["block", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(c), np.int64) for c in table.column("counts").to_pylist())
        level = np.minimum(255, np.round(4 * np.log2(1 + total))).astype(np.uint8)
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int32()), "levels": pa.array([level.tobytes()], pa.binary())})

    got = docs.select("text").mapInArrow(count, "block int, counts binary").groupBy("block").applyInArrow(add, "block int, levels binary").toArrow()
    out = np.zeros(1 << COUNTER_BITS, np.uint8)
    for block, levels in zip(got.column("block").to_pylist(), got.column("levels").to_pylist(), strict=True):
        out[block * BLOCK:(block + 1) * BLOCK] = np.frombuffer(levels, np.uint8)
    return out


def needed(size: np.ndarray, percent: int) -> np.ndarray:
    """Words that a match of a line of this size must share with it at least."""
    return -(-size * percent // 100)


# --- postings ----------------------------------------------------------------------
#: What is sent for a line, and for a posting (``at`` is its line in the same message).
LINE_KINDS = {"doc": "<i8", "key": "<i8", "line": "<i4", "size": "<i4", "bits": "<u8", "more": "<u8", "twin": "<u4"}
POST_KINDS = {"word": "<u4", "salt": "<u4", "at": "<u4", "place": "<i4"}
SET_KINDS = {"set": "<u8", "doc": "<i8", "key": "<i8", "line": "<i4"}


def prefixes(ids: dict[str, np.ndarray], lines: Lines, use: np.ndarray, percent: int, only_words: np.ndarray | None = None) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """(lines, postings) of the lines to ``use`` that have more than three words, with ``only_words`` by the words that may be in that
    bitmap; ``salt`` is the word's level, until its list is divided."""
    place = np.arange(len(lines.words)) - lines.first[lines.owner]
    most = np.where(use & (lines.size > 3), lines.size - needed(lines.size, percent), -1)
    sent = np.flatnonzero(place <= most[lines.owner])
    if only_words is not None:
        sent = sent[in_bitmap(only_words, list_words(lines.words[sent]))]
    words, owner = lines.words[sent], lines.owner[sent]
    rows = tw.distinct(owner)
    size = lines.size[rows]
    bits, more = np.zeros(len(rows), U64), np.zeros(len(rows), U64)
    if len(rows):
        own = lines.words[tw.ranges(lines.first[rows], size)]
        first = np.cumsum(size) - size
        one, high = U64(1) << (own & U64(63)), own & U64(64) > 0
        more = np.bitwise_or.reduceat(np.where(high, one, U64(0)), first)
        bits = np.bitwise_or.reduceat(np.where(high, U64(0), one), first)
        # short lines have both halves in one
        short = size < LONG
        bits[short] |= more[short]
        more[short] = 0
    number = np.zeros(len(lines.size), np.int64)
    number[rows] = np.arange(len(rows))
    return ({"doc": ids["doc"][rows], "key": ids["key"][rows], "line": ids["line"][rows], "size": size, "bits": bits, "more": more, "twin": lines.set[rows] >> U64(32)},
            {"word": list_words(words), "salt": words >> U64(WORD_BITS), "at": number[owner], "place": place[sent]})


def list_words(words: np.ndarray) -> np.ndarray:
    """The bits of words that name their lists."""
    return words >> U64(WORD_BITS - 32) & U64(0xFFFFFFFF)


def rows_of_bytes(columns: dict[str, np.ndarray], kinds: dict[str, str]) -> np.ndarray:
    """Columns side by side: the bytes of a row are a row."""
    return np.hstack([np.ascontiguousarray(columns[n].astype(k, copy=False)).view(np.uint8).reshape(-1, np.dtype(k).itemsize) for n, k in kinds.items()])


def packed(rows: np.ndarray) -> bytes:
    """``rows_of_bytes`` as bytes: the first bytes of all rows, then the second, and so on, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(rows.T))


def unpacked(blob: bytes, kinds: dict[str, str]) -> dict[str, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n, at, out = len(raw) // sum(np.dtype(k).itemsize for k in kinds.values()), 0, {}
    for name, k in kinds.items():
        size = n * np.dtype(k).itemsize
        out[name] = np.ascontiguousarray(raw[at:at + size].reshape(np.dtype(k).itemsize, n).T).view(k).ravel()
        at += size
    return out


def joined(parts: list[dict[str, np.ndarray]], kinds: dict[str, str]) -> dict[str, np.ndarray]:
    return {n: np.concatenate([p[n] for p in parts]) if parts else np.zeros(0, k) for n, k in kinds.items()}


def posted(docs: DataFrame, known: tuple, percent: int, groups: int) -> DataFrame:
    """Messages to the groups: (group, lines, posts, sets, copies).  ``sets`` are lines by the hash of their set,
    ``copies`` lines that have an equal earlier one in their task."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def messages(lines: list, posts: list, sets: list, copies: list) -> Iterator[pa.RecordBatch]:
        base = np.cumsum([0] + [len(x["doc"]) for x in lines])
        posts = [p | {"at": p["at"] + b} for p, b in zip(posts, base[:-1], strict=True)]
        lines, posts, sets, copies = joined(lines, LINE_KINDS), joined(posts, POST_KINDS), joined(sets, SET_KINDS), joined(copies, SET_KINDS)
        # a list is no longer than its word's count; a list that may be long is divided at random
        parts = np.ceil(np.exp2(posts["salt"].astype(np.int64) / 4) / LONG_LIST).astype(np.int64)
        own = line_hash(*(lines[n] for n in LINE))[posts["at"].astype(np.int64)].view(U64) >> U64(8)
        salt = np.where(parts > 1, own.astype(np.int64) % np.maximum(parts, 1) + 1, 0) & 0xFFFFFFFF
        posts["salt"] = salt
        post_group = (tw.mix(posts["word"].astype(U64) + (salt.astype(U64) << U64(32))) % U64(groups)).astype(np.int64)
        set_group = (tw.mix(sets["set"].astype(U64)) % U64(groups)).astype(np.int64)
        copy_group = np.arange(len(copies["doc"])) % groups
        small = np.min_scalar_type(groups)  # numbers of two bytes are sorted by their digits
        orders = [(np.argsort(g.astype(small), kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(g, minlength=groups))]))
                  for g in (post_group, set_group, copy_group)]
        line_rows, post_rows = rows_of_bytes(lines, LINE_KINDS), rows_of_bytes(posts, POST_KINDS)[orders[0][0]]
        set_rows, copy_rows = (rows_of_bytes(x, SET_KINDS)[o] for x, (o, _) in zip((sets, copies), orders[1:], strict=True))
        at_of, spot = posts["at"][orders[0][0]], list(POST_KINDS).index("at")
        before = sum(np.dtype(k).itemsize for k in list(POST_KINDS.values())[:spot])
        rows = []
        for g in range(groups):
            mine = [slice(e[g], e[g + 1]) for _, e in orders]
            if all(x.start == x.stop for x in mine):
                continue
            # a group's postings are in the order of their lines
            at = at_of[mine[0]]
            new = np.append(True, at[1:] != at[:-1])[:len(at)]
            post = post_rows[mine[0]]
            post[:, before:before + 4] = (np.cumsum(new) - 1).astype(POST_KINDS["at"]).view(np.uint8).reshape(-1, 4)
            rows.append((g, packed(line_rows[at[new]]), packed(post), packed(set_rows[mine[1]]), packed(copy_rows[mine[2]])))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), *[pa.binary()] * 4), strict=True)],
                                             ["group", "lines", "posts", "sets", "copies"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level_of, repeated = sent.value
        seen: dict[int, tuple[int, int, int]] = {}  # the earliest line so far of each set
        held, size = ([], [], [], []), 0
        for batch in tw.small_batches(batches, "text", TEXT_SLICE):
            for ids, lines in line_blocks(batch, level_of, repeated):
                first, copy = np.zeros(len(lines.size), bool), np.zeros(len(lines.size), bool)
                full = np.flatnonzero(lines.size)
                places = zip(*(ids[n][full].tolist() for n in LINE), strict=True)
                for i, s, at in zip(full.tolist(), lines.set[full].tolist(), places, strict=True):
                    if (before := seen.get(s)) is None or at < before:
                        seen[s] = at
                        first[i] = True
                    elif at > before:
                        copy[i] = True
                if len(seen) > SEEN:
                    seen = {}
                for out, part in zip(held, (*prefixes(ids, lines, first, percent), *[
                        {"set": lines.set[x]} | {n: ids[n][x] for n in LINE} for x in (first, copy)]), strict=True):
                    out.append(part)
                size += len(held[1][-1]["at"]) + int(first.sum() + copy.sum())
                if size > HELD:
                    yield from messages(*held)
                    held, size = ([], [], [], []), 0
        if size:
            yield from messages(*held)
        del held, seen
        tw.release()

    return docs.select(*line_order(), "text").mapInArrow(run, "group int, lines binary, posts binary, sets binary, copies binary")


def posting_rows(docs: DataFrame, known: tuple, percent: int, only_lines: tuple[np.ndarray, np.ndarray] | None = None,
                 only_words: np.ndarray | None = None) -> DataFrame:
    """Postings as rows (doc, key, line, word, place, size, bits, more, twin) of the lines (bitmaps of texts and of lines), or
    by the words, that may be in a bitmap."""
    sent = docs.sparkSession.sparkContext.broadcast((*known, only_lines, only_words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level_of, repeated, asked_lines, asked_words = sent.value
        for batch in tw.small_batches(batches, "text", TEXT_SLICE):
            if asked_lines is not None:
                doc, key = (batch.column(c).to_numpy() for c in ("doc", "key"))
                own = line_hash(doc, own_keys(doc, key, repeated), np.full(len(doc), -1))
                batch = batch.filter(pa.array(in_bitmap(asked_lines[0], own)))
            for ids, lines in line_blocks(batch, level_of, repeated, None if asked_lines is None else asked_lines[1]):
                rows, posts = prefixes(ids, lines, np.ones(len(lines.size), bool), percent, asked_words)
                at = posts["at"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["doc"][at]), pa.array(rows["key"][at]), pa.array(rows["line"][at], pa.int32()), pa.array(posts["word"].astype(np.int64)),
                     pa.array(posts["place"], pa.int32()), pa.array(rows["size"][at], pa.int32()), *[pa.array(rows[c][at].view(np.int64)) for c in ("bits", "more")],
                     pa.array(rows["twin"][at].astype(np.int64))], ["doc", "key", "line", "word", "place", "size", "bits", "more", "twin"])

    return docs.select(*line_order(), "text").mapInArrow(run, "doc bigint, key bigint, line int, word bigint, place int, size int, bits bigint, more bigint, twin bigint")


# --- pairs -------------------------------------------------------------------------
def bits_apart(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> np.ndarray:
    """Differing bits of the bitmaps of lines (bits, more, size), folded to 64 unless both are long."""
    long = (a["size"] >= LONG) & (b["size"] >= LONG)
    apart = np.bitwise_count(np.where(long, a["bits"] ^ b["bits"], (a["bits"] | a["more"]) ^ (b["bits"] | b["more"])))
    return apart.astype(np.int64) + np.where(long, np.bitwise_count(a["more"] ^ b["more"]), 0)


def columns_apart() -> Column:
    """The same of columns, those of the other line with ``early_``."""
    a, b, c, d = F.col("bits"), F.col("early_bits"), F.col("more"), F.col("early_more")
    long = (F.col("size") >= LONG) & (F.col("early_size") >= LONG)
    return F.when(long, F.bit_count(a.bitwiseXOR(b)) + F.bit_count(c.bitwiseXOR(d))).otherwise(
        F.bit_count(a.bitwiseOR(c).bitwiseXOR(b.bitwiseOR(d))))


def may_match(size_a, size_b, place_a, place_b, apart, least, percent: int):
    """Length, positional and bitmap filters; ``apart``: differing bits of the bitmaps,
    ``least``: the least of two numbers.  For numpy arrays and for columns alike."""
    # |a & b| * (100 + percent) >= percent * (|a| + |b|)
    both = size_a + size_b
    length = (size_a * 100 >= size_b * percent) & (size_b * 100 >= size_a * percent)
    most = least(size_a - place_a, size_b - place_b)
    positional = most * (100 + percent) >= both * percent
    bitmap = (both - apart) * (100 + percent) >= both * percent * 2
    return length & positional & bitmap


FOUND = "kind int, doc bigint, key bigint, line int, early_doc bigint, early_key bigint, early_line int"
GONE, PAIR, MORE = 0, 1, 2


def _found(kind: int, late: dict[str, np.ndarray], early: dict[str, np.ndarray] | None = None) -> pa.Table:
    n = len(late["doc"])
    out = {"kind": pa.array(np.full(n, kind), pa.int32())}
    for side, rows in (("", late), ("early_", early)):
        for name in LINE:
            kind_of = pa.int32() if name == "line" else pa.int64()
            out[side + name] = pa.nulls(n, kind_of) if rows is None else pa.array(rows[name]).cast(kind_of)
    return pa.table(out)


def _take(rows: dict[str, np.ndarray], at: np.ndarray) -> dict[str, np.ndarray]:
    return {n: rows[n][at] for n in LINE}


def equal_sets(sets: dict[str, np.ndarray]) -> pa.Table:
    """Lines that have an equal set in an earlier line."""
    order = np.lexsort([sets[n] for n in ("line", "key", "doc", "set")])
    rows = {n: v[order] for n, v in sets.items()}
    opens = np.append(True, rows["set"][1:] != rows["set"][:-1])[:len(order)]
    start = np.flatnonzero(opens)[np.cumsum(opens) - 1] if len(order) else np.zeros(0, np.int64)
    gone = np.any([rows[n] != rows[n][start] for n in LINE], axis=0)
    return _found(GONE, _take(rows, gone))


def by_two(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Stable order by two numbers, the second not negative; where both fit 64 bits together, as one number."""
    wide = int(second.max(initial=0)).bit_length()
    if max(int(first.max(initial=0)), -int(first.min(initial=0))).bit_length() + wide <= 62:
        return np.argsort(first << wide | second, kind="stable")
    return np.lexsort([second, first])


def list_pairs(table: pa.Table, percent: int) -> pa.Table:
    """Rows of ``FOUND`` for one group: copies, pairs, and lines (``MORE``) whose lists have candidates that were not tried."""
    blobs = {c: table.column(c).to_pylist() for c in ("lines", "posts", "sets", "copies")}
    lines, posts = [unpacked(x, LINE_KINDS) for x in blobs["lines"]], [unpacked(x, POST_KINDS) for x in blobs["posts"]]
    base = np.cumsum([0] + [len(x["doc"]) for x in lines])
    posts = joined([p | {"at": p["at"].astype(np.int64) + b} for p, b in zip(posts, base[:-1], strict=True)], POST_KINDS)
    lines = joined(lines, LINE_KINDS)
    out = [equal_sets(joined([unpacked(x, SET_KINDS) for x in blobs["sets"]], SET_KINDS)),
           _found(GONE, joined([unpacked(x, SET_KINDS) for x in blobs["copies"]], SET_KINDS))]
    # a number for each line in order, one for lines of equal sets: the first stands for all, the others are removed anyway
    order = np.lexsort([lines[n] for n in ("line", "key", "doc")]) if lines["key"].any() else by_two(lines["doc"], lines["line"].astype(np.int64))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    at = posts["at"].astype(np.int64)
    salt = posts["salt"].astype(np.int64)
    word = posts["word"].astype(np.int64) | salt << 32  # the parts of a divided list are lists of their own
    # lines that are equal in all of these are neighbours in the order of a hash
    alike = np.argsort(tw.mix(tw.mix(lines["more"] ^ (lines["twin"].astype(U64) << U64(32) | lines["size"].astype(U64))) ^ lines["bits"]))
    other = np.any([lines[n][alike[1:]] != lines[n][alike[:-1]] for n in ("more", "bits", "twin", "size")], axis=0)
    twin = np.empty(len(alike), np.int64)
    twin[alike] = np.cumsum(np.append(False, other)[:len(alike)])
    use = by_two(word, rank[at])
    twins = use[by_two(word[use], twin[at[use]])]  # still by rank among themselves
    same = (word[twins[1:]] == word[twins[:-1]]) & (twin[at[twins[1:]]] == twin[at[twins[:-1]]])
    kept = np.zeros(len(use), bool)
    kept[twins[np.append(True, ~same)[:len(twins)]]] = True
    use = use[kept[use]]
    word, at, salt, place = word[use], at[use], salt[use], posts["place"][use].astype(np.int64)
    size, sketch = lines["size"][at].astype(np.int64), {n: lines[n][at] for n in ("bits", "more", "size")}
    n = len(at)
    opens = np.append(True, word[1:] != word[:-1])[:n]
    start = np.flatnonzero(opens)[np.cumsum(opens) - 1] if n else np.zeros(0, np.int64)
    earlier = np.minimum(np.arange(n) - start, PARTNERS)
    least, most = needed(size, percent), size * 100 // percent  # sizes of the lines that a line may match
    late, early, short = [], [], [np.flatnonzero((salt > 0) | (np.arange(n) - start > PARTNERS))]
    upto = np.cumsum(earlier)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + PAIRS, "right")))
        a = np.repeat(np.arange(i, j), earlier[i:j])
        b = tw.ranges(start[i:j], earlier[i:j])
        # the length filter first: it needs the least
        near = np.flatnonzero((b_size := size[b]) >= np.repeat(least[i:j], earlier[i:j]))
        near = near[b_size[near] <= most[a[near]]]
        a, b = a[near], b[near]
        apart = bits_apart(*({n: v[x] for n, v in sketch.items()} for x in (a, b)))
        ok = may_match(size[a], size[b], place[a], place[b], apart, np.minimum, percent)
        a, b, apart = a[ok], b[ok], apart[ok]
        likeliest = by_two(a, apart)  # and by b, in whose order they are
        a, b = a[likeliest], b[likeliest]
        new = np.append(True, a[1:] != a[:-1])[:len(a)]
        nth = np.arange(len(a)) - np.flatnonzero(new)[np.cumsum(new) - 1] if len(a) else np.zeros(0, np.int64)
        late.append(at[a[nth < EARLIEST]])
        early.append(at[b[nth < EARLIEST]])
        short.append(a[nth == EARLIEST])
        i = j
    late, early = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (late, early))
    both = tw.distinct(late * max(1, len(order)) + early)
    late, early = np.divmod(both, max(1, len(order)))
    short = tw.distinct(at[np.concatenate(short)])
    out += [_found(PAIR, _take(lines, late), _take(lines, early)), _found(MORE, _take(lines, short))]
    return pa.concat_tables(out)


# --- verification --------------------------------------------------------------------
#: Bytes of a word when sets are compared.
WORD_BYTES = 5
#: Lines whose sets one task compares, about; words compared at once.
CELL_LINES, COMPARED = 5_000, 1 << 20


def by_late(pairs: DataFrame) -> DataFrame:
    """Stored (doc, key, line, early): each later line with its earlier partners, once."""
    early = F.struct(*[F.col(f"early_{n}").alias(n) for n in LINE])
    return stored(pairs.groupBy(*LINE).agg(F.collect_set(early).alias("early")), "tried")


def line_sets(docs: DataFrame, known: tuple, wanted: DataFrame) -> DataFrame:
    """(doc, key, line, words) of the ``wanted`` lines, and of some more: bitmaps of their hashes
    choose them, an exact join follows.  ``words`` are ``WORD_BYTES`` of each, in order."""
    sent = docs.sparkSession.sparkContext.broadcast((*known, *text_and_line_bitmaps(wanted)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level_of, repeated, texts, asked = sent.value
        done: set[tuple[int, int]] = set()  # repeated rows are one document
        for batch in tw.small_batches(batches, "text", TEXT_SLICE):
            doc, key = (batch.column(c).to_numpy() for c in ("doc", "key"))
            key = own_keys(doc, key, repeated)
            use = in_bitmap(texts, line_hash(doc, key, np.full(len(doc), -1)))
            for i in np.flatnonzero(use & (key != 0)).tolist():
                if (at := (int(doc[i]), int(key[i]))) in done:
                    use[i] = False
                done.add(at)
            if len(done) > SEEN:
                done = set()
            for ids, lines in line_blocks(batch.filter(pa.array(use)), level_of, repeated, asked):
                at = np.flatnonzero(lines.size)
                n = lines.size[at]
                short = tw.mix(lines.words[tw.ranges(lines.first[at], n)]) >> U64(64 - 8 * WORD_BYTES)
                # sorted in each line; the order by rarity is done with
                short = np.sort(np.repeat(np.arange(len(at)), n).astype(U64) << U64(8 * WORD_BYTES) | short) & U64((1 << 8 * WORD_BYTES) - 1)
                raw = np.ascontiguousarray(short.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES]).tobytes()
                off = WORD_BYTES * np.concatenate([[0], np.cumsum(n)])
                words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([pa.array(ids["doc"][at]), pa.array(ids["key"][at]), pa.array(ids["line"][at], pa.int32()), words.cast(pa.binary())],
                                                 [*LINE, "words"])
        tw.release()

    rows = docs.select(*line_order(), "text").mapInArrow(run, "doc bigint, key bigint, line int, words binary")
    return rows.groupBy(*LINE).agg(F.first("words").alias("words"))


def matching(tried: pa.Table, sets: pa.Table, percent: int) -> pa.Table:
    """(doc, key, line) of the later lines of a cell that match one of their partners."""
    tried, sets = tried.combine_chunks(), sets.combine_chunks()
    if not len(tried):
        return tried.select(LINE)
    raw, off = tw.text_bytes(sets["words"].combine_chunks())
    wide = np.zeros((len(raw) // WORD_BYTES, 8), np.uint8)
    wide[:, :WORD_BYTES] = raw.reshape(-1, WORD_BYTES)
    words, size, first = wide.view("<u8").ravel(), np.diff(off) // WORD_BYTES, off[:-1] // WORD_BYTES
    known = line_hash(*(sets[n].to_numpy() for n in LINE))
    order = np.argsort(known)

    def place(doc: np.ndarray, key: np.ndarray, line: np.ndarray) -> np.ndarray:
        return order[np.searchsorted(known[order], line_hash(doc, key, line))]

    early = tried["early"].combine_chunks()
    owner, flat = np.repeat(np.arange(len(tried)), early.value_lengths().to_numpy()), early.flatten()
    a = place(*(tried[n].to_numpy() for n in LINE))[owner]
    b = place(*(flat.field(n).to_numpy() for n in LINE))
    ok = np.zeros(len(tried), bool)
    upto, i = np.cumsum(size[a] + size[b]), 0
    while i < len(a):
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + COMPARED, "right")))
        n = np.arange(j - i).astype(U64) << U64(8 * WORD_BYTES)
        # equal values are words that the sets of a pair share
        both = np.sort(np.concatenate([words[tw.ranges(first[x[i:j]], size[x[i:j]])] | np.repeat(n, size[x[i:j]]) for x in (a, b)]))
        shared = np.bincount((both[1:][both[1:] == both[:-1]] >> U64(8 * WORD_BYTES)).astype(np.int64), minlength=j - i)
        ok[owner[i:j][shared * 100 >= percent * (size[a[i:j]] + size[b[i:j]] - shared)]] = True
        i = j
    return tried.select(LINE).filter(pa.array(ok))


def verified(docs: DataFrame, known: tuple, tried: DataFrame, percent: int) -> DataFrame:
    """(doc, key, line) of the later lines of ``by_late`` that match a partner on their full sets.

    Later lines with the same first partner go to one cell, since they mostly share the others
    too, and so do the sets of all of them, each once; where a partner has very many, its later lines
    go to all cells."""
    cells = max(8, -(-tried.count() // CELL_LINES))
    partner = F.array_min("early").alias("_first")
    hot = tried.groupBy(partner).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > CELL_LINES)
    placed = tried.withColumn("_first", F.array_min("early")).join(hot, "_first", "left")
    spread = F.when(F.col("_n").isNull(), F.xxhash64("_first")).otherwise(F.xxhash64(*LINE))
    placed = placed.select(F.pmod(spread, F.lit(cells)).cast("int").alias("cell"), *LINE, "early")
    asked = placed.select("cell", F.explode(F.array_union("early", F.array(F.struct(*LINE)))).alias("_l")).select(
        F.col("cell").alias("_cell"), "_l.*").distinct()
    sets = line_sets(docs, known, asked.select(*LINE)).join(asked.hint("merge"), LINE)
    return placed.groupBy("cell").cogroup(sets.groupBy("_cell")).applyInArrow(
        lambda left, right: matching(left, right, percent), "doc bigint, key bigint, line int")


def size_band(size: Column, percent: int) -> Column:
    """Sizes of lines that match are in the same or in neighbouring bands."""
    return F.floor(F.log(size.cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("int")


def repeated_lines(docs: DataFrame, known: tuple, percent: int = PERCENT) -> DataFrame:
    """(doc, key, line) of every line with an earlier match."""
    groups = max(8, -(-(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // GROUP_BYTES))
    found = stored(posted(docs, known, percent, groups).groupBy("group").applyInArrow(lambda t: list_pairs(t, percent), FOUND), "line-pairs")
    pair = [*LINE, *[f"early_{n}" for n in LINE]]
    copies = found.where(F.col("kind") == GONE).select(*LINE)
    tried = by_late(found.where(F.col("kind") == PAIR))
    matched = stored(verified(docs, known, tried, percent), "matched")

    more = found.where(F.col("kind") == MORE).select(*LINE).distinct()
    open_lines = stored(more.join(matched.unionAll(copies), LINE, "left_anti"), "open-lines")
    if not open_lines.isEmpty():
        late = posting_rows(docs, known, percent, only_lines=text_and_line_bitmaps(open_lines)).join(open_lines, LINE)
        late = stored(late.dropDuplicates([*LINE, "word"]), "late")
        early = posting_rows(docs, known, percent, only_words=bitmap(late, "word"))
        early = early.withColumn("band", size_band(F.col("size"), percent)).withColumnsRenamed({
            c: f"early_{c}" for c in ("doc", "key", "line", "size", "place", "bits", "more", "twin")})
        near = size_band(F.col("size"), percent)
        late = late.withColumn("band", F.explode(F.array(near - 1, near, near + 1)))
        before = F.struct("early_doc", "early_key", "early_line") < F.struct("doc", "key", "line")
        twins = F.lit(True)
        for c in ("twin", "bits", "more", "size"):
            twins &= F.col(c) == F.col(f"early_{c}")
        ok = ~twins & may_match(F.col("size"), F.col("early_size"), F.col("place"), F.col("early_place"), columns_apart(), F.least, percent)
        rest = by_late(late.join(early, ["word", "band"]).where(before & ok).select(*pair))
        matched = matched.unionAll(verified(docs, known, rest, percent))
    return copies.unionAll(matched).distinct()


def cut_lines(docs: DataFrame, known: tuple, percent: int = PERCENT) -> DataFrame:
    """doc, key, gone: for each text with repeated lines, their numbers from 0 in order."""
    return stored(repeated_lines(docs, known, percent).groupBy("doc", "key").agg(F.array_sort(F.collect_list("line")).alias("gone")), "cut-lines")


def with_own_keys(rows: DataFrame, known: tuple, texts: np.ndarray, wanted: bool) -> DataFrame:
    """``rows`` with ``_key`` as lines have it and ``n_lines``, of the texts that may be (or surely are not) in a bitmap."""
    sent = rows.sparkSession.sparkContext.broadcast((known[1], texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, asked = sent.value
        for batch in batches:
            doc = batch.column("_doc").to_numpy()
            key = own_keys(doc, batch.column("_key").to_numpy(), repeated)
            batch = batch.set_column(batch.schema.get_field_index("_key"), "_key", pa.array(key))
            batch = batch.filter(pa.array(in_bitmap(asked, line_hash(doc, key, np.full(len(doc), -1))) == wanted))
            text = batch.column("text")
            n_lines = pc.if_else(pc.greater(pc.binary_length(text), 0), pc.add(pc.count_substring(text, "\n"), 1), 0)
            yield batch.append_column("n_lines", pc.fill_null(n_lines, 0).cast(pa.int64()))

    return rows.mapInArrow(run, rows.select("*", F.lit(0).cast("long").alias("n_lines")).schema)


def without_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``text`` without the lines whose numbers are in ``gone``."""
    for batch in batches:
        kept = []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True):
            if gone:
                out = set(gone)
                text = "\n".join([x for i, x in enumerate(text.split("\n")) if i not in out])
            kept.append(text)
        yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(kept, batch.column("text").type))


def without_repeated_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``, and ``n_lines``, ``n_removed``.

    A line is removed when a line of a smaller doc_id (null: last; equal doc_ids: by a 64-bit hash
    of the text), or an earlier line of the same text, matches it; lines are judged on the
    input.  Lines without words stay.  Null and empty texts have no lines and stay as they
    are.  Rows of one doc_id and text are one document.  Texts may have any number of lines and lines
    any number of words.  Other columns stay; input columns named n_lines or n_removed are replaced.
    """
    keep = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    with arrow_rows(docs.sparkSession, BATCH_TEXTS):
        known = rarity(docs), repeated_ids(docs)
        cuts = cut_lines(docs.select("doc_id", "text"), known, percent)
        # texts without any cut are not shuffled
        texts = hash_bitmap(cuts.select("doc", "key", F.lit(-1).alias("line")))
    doc, key = line_order()
    rows = docs.select(*keep, doc.alias("_doc"), key.alias("_key"))
    cuts = cuts.select(F.col("doc").alias("_doc"), F.col("key").alias("_key"), "gone")
    # the same plan at every size
    cut = with_own_keys(rows, known, texts, True).join(cuts.hint("merge"), ["_doc", "_key"], "left")
    cut = cut.withColumn("n_removed", F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long"))
    cut = cut.select(*keep, "n_lines", "n_removed", "gone")
    cut = cut.mapInArrow(without_lines, cut.schema).drop("gone")
    whole = with_own_keys(rows, known, texts, False).select(*keep, "n_lines", F.lit(0).cast("long").alias("n_removed"))
    return cut.unionByName(whole)
