"""Alignment of the token ids of two tokenizers over the bytes of each text.

A is a byte-level BPE (``tokenizers``), B a piece model with byte fallback (``sentencepiece``) that puts a
space before a text; A encodes the same space and text.  Neither has a token that reaches from another
character into a space, so a text is cut before such spaces, and each distinct chunk is encoded and
aligned once by a worker; chunks that a tokenizer does not give back byte for byte leave their text
without tokens.

How many documents hold an id pair linked is counted in two ways.  The identity map gives for each id of A
the id of B with the same bytes; those pairs are counted in vectors of A's vocabulary, which
tasks sum before anything is shuffled.  Only the other pairs, from irregular groups, enter a shuffle, and a
block of documents sends each of its pairs once.  The totals come back to each block the same way.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textwords as tw
from ledgerlens.llm.storage import stored
from ledgerlens.llm.tokenfile import decode, encode

#: Bytes of text in a block; a longer text is a block of its own and is aligned in parts.
TEXT_SLICE = 4 << 20
#: Chunks that a worker remembers.
REMEMBERED = 400_000
#: Chunks that are aligned at once, and encoded in one string.
ENCODED, JOINED = 20_000, 32

SPACE = 0x20
# The last byte before a cut: an ASCII character that is no white space, or the end of a
# character whose first byte rules white space out.
PRINTABLE = np.zeros(256, bool)
PRINTABLE[0x21:0x7F] = True
LETTERS_2, LETTERS_3, LETTERS_4 = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
LETTERS_2[0xC3:0xE0] = True
LETTERS_3[0xE4:0xEE] = True
LETTERS_4[0xF0:0xF5] = True


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level tokenizers write for each byte."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class Vocabulary:
    """Bytes of each id: id ``i`` has ``flat[starts[i]:starts[i] + sizes[i]]``."""

    flat: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        sizes = np.array([len(t) for t in tokens], np.int64)
        return cls(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(sizes) - sizes, sizes)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[tw.ranges(self.starts[ids], self.sizes[ids])]


def safe_ends(raw: np.ndarray) -> np.ndarray:
    """Whether a chunk may end with the byte: the last one of a character that is no white space."""
    inner = (raw >= 0x80) & (raw < 0xC0)
    safe = PRINTABLE[raw]
    safe[1:] |= inner[1:] & LETTERS_2[raw[:-1]]
    safe[2:] |= inner[2:] & LETTERS_3[raw[:-2]]
    safe[3:] |= inner[3:] & LETTERS_4[raw[:-3]]
    return safe


def cuts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions at which a chunk begins: the start of each text, and each space after a
    character that is none, unless only spaces follow in the text."""
    begins = raw == SPACE
    begins[1:] &= safe_ends(raw)[:-1]
    # nothing is cut off that is only spaces: a run of them can be cut at its first one
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b > a and raw[b - 1] == SPACE:
            others = np.flatnonzero(raw[a:b] != SPACE)
            if len(others):
                begins[a + others[-1] + 1] = False
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(begins)


class Aligner:
    """Chunks of texts, encoded by both tokenizers and aligned."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        tokens = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            tokens[i] = bytes(map(letters.__getitem__, token))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        inside = [i for i, p in enumerate(pieces) if re.search("[^▁]▁", p)]
        if inside:
            raise ValueError(f"tokens of {path_b} reach into a space: {inside[:3]}")
        # control pieces and the unknown piece have no bytes, so a text that holds one does not come back whole
        as_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i)
                    else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.va, self.vb = Vocabulary.of(tokens), Vocabulary.of(as_bytes)
        # plain pieces go before single bytes
        same = {x: i for i, x in reversed(list(enumerate(as_bytes))) if x}
        same |= {x: i for i, x in reversed(list(enumerate(as_bytes))) if x and not self.b.is_byte(i)}
        self.same = np.array([same.get(x, -1) if x else -1 for x in tokens], np.int64)
        self.names = [str(i) for i in range(max(len(tokens), len(pieces)))]
        self.forget()

    def forget(self) -> None:
        self.chunks = pa.array([], pa.large_binary())
        self.bad = np.zeros(0, bool)
        self.numbers = np.zeros((0, 4), np.int64)  # n_a, n_b, n_groups, n_links
        self.strings = np.zeros(0, object)
        self.pair_first, self.pairs, self.times = np.zeros(1, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def _encoded(self, chunks: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, how many for each chunk) of A and of B; a chunk begins with a space, which B adds itself."""
        out = []
        for ids in ([x.ids for x in self.a.encode_batch_fast(chunks, add_special_tokens=False)], self.b.encode([c[1:] for c in chunks], num_threads=1)):
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            out.append((np.fromiter(chain.from_iterable(ids), np.int64, int(sizes.sum())), sizes))
        return out

    def _encoded_together(self, chunks: list[str], ends: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """The same for chunks that others may follow, several in one string; ``ends`` are their ends as bytes."""
        out = []
        for v, (ids, _) in zip((self.va, self.vb), self._encoded(["".join(chunks[i:i + JOINED]) for i in range(0, len(chunks), JOINED)]), strict=True):
            at = np.cumsum(v.sizes[ids])
            last = np.searchsorted(at, ends)
            if len(at) == 0 or last[-1] != len(at) - 1 or (at[last] != ends).any():
                return self._encoded(chunks)
            out.append((ids, np.diff(last, prepend=-1)))
        return out

    def _learn(self, new: pa.Array, together: bool) -> None:
        """Encode and align chunks that are not known yet."""
        chunks = new.cast(pa.large_string()).to_pylist()
        raw, off = tw.text_bytes(new)
        (a, n_a), (b, n_b) = self._encoded_together(chunks, off[1:]) if together else self._encoded(chunks)
        chunk_a, chunk_b = np.repeat(np.arange(len(chunks)), n_a), np.repeat(np.arange(len(chunks)), n_b)
        bad = np.zeros(len(chunks), bool)
        for v, ids, of in ((self.va, a, chunk_a), (self.vb, b, chunk_b)):
            sizes = np.bincount(of, v.sizes[ids], len(chunks)).astype(np.int64)
            bad |= sizes != np.diff(off)
            whole = ~bad
            fits = whole[of]
            differ = v.joined(ids[fits]) != raw[tw.ranges(off[:-1][whole], np.diff(off)[whole])]
            at = np.repeat(np.flatnonzero(whole), np.diff(off)[whole])
            bad[at[differ]] = True
            bad |= np.bincount(of[v.sizes[ids] == 0], minlength=len(chunks)) > 0
        a, chunk_a, b, chunk_b = a[~bad[chunk_a]], chunk_a[~bad[chunk_a]], b[~bad[chunk_b]], chunk_b[~bad[chunk_b]]
        # all chunks as one string: chunks end at ends of both
        end_a, end_b = np.cumsum(self.va.sizes[a]), np.cumsum(self.vb.sizes[b])
        start_a, start_b = end_a - self.va.sizes[a], end_b - self.vb.sizes[b]
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        lo, hi = np.searchsorted(end_b, start_a, "right"), np.searchsorted(start_b, end_a, "left")
        link_a, link_b = np.repeat(np.arange(len(a)), hi - lo), tw.ranges(lo, hi - lo)
        last_of = np.searchsorted(end_a, common)  # the token of A that ends a group
        count = lambda of: np.bincount(of, minlength=len(chunks))
        numbers = np.stack([count(chunk_a), count(chunk_b), count(chunk_a[last_of]), count(chunk_a[link_a])], axis=1)
        # pairs of a chunk and how often they are linked in it
        keys = a[link_a].astype(np.uint64) << np.uint64(32) | b[link_b].astype(np.uint64)
        distinct, which = np.unique(keys, return_inverse=True)
        both, times = np.unique(chunk_a[link_a] * max(1, len(distinct)) + which, return_counts=True)
        of, which = np.divmod(both, max(1, len(distinct)))
        # a1,a2|b1;a3|b2,b3 and a line end behind each chunk
        n, m = len(a), len(b)
        order = np.lexsort((np.concatenate([np.arange(n), np.arange(m)]), np.repeat([0, 1], [n, m]), np.concatenate([group_a, group_b])))
        ends = np.concatenate([np.diff(group_a, append=-1) != 0, np.diff(group_b, append=-1) != 0])
        closes = np.concatenate([np.zeros(n, bool), np.diff(chunk_b, append=-1) != 0])
        kind = np.where(~ends, 0, np.where(np.arange(n + m) < n, 1, np.where(closes, 3, 2)))[order]
        written = "".join([self.names[i] + ",|;\n"[k] for i, k in zip(np.concatenate([a, b])[order].tolist(), kind.tolist(), strict=True)])
        strings = np.zeros(len(chunks), object)
        strings[~bad] = written.split("\n")[:-1]
        first = np.searchsorted(of, np.arange(1, len(chunks) + 1))
        self.chunks = pa.concat_arrays([self.chunks, new])
        self.bad = np.concatenate([self.bad, bad])
        self.numbers = np.concatenate([self.numbers, numbers])
        self.strings = np.concatenate([self.strings, strings])
        self.pair_first = np.concatenate([self.pair_first, self.pair_first[-1] + first])
        self.pairs = np.concatenate([self.pairs, distinct[which]])
        self.times = np.concatenate([self.times, times])

    def _numbered(self, raw: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Number of each chunk."""
        if len(self.chunks) > REMEMBERED:
            self.forget()
        bounds = pa.py_buffer(np.append(begins, len(raw)).astype(np.int64))
        coded = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, bounds, pa.py_buffer(raw)]).dictionary_encode()
        new = coded.dictionary.filter(pc.is_null(pc.index_in(coded.dictionary, self.chunks)))
        if len(new):
            own, off = tw.text_bytes(new)
            joins = pa.array(safe_ends(own)[off[1:] - 1] & ~pc.match_substring(new, "▁".encode()).to_numpy(zero_copy_only=False))
            for some, together in ((new.filter(joins), True), (new.filter(pc.invert(joins)), False)):
                for i in range(0, len(some), ENCODED):
                    self._learn(some.slice(i, ENCODED), together)
        at = pc.index_in(coded.dictionary, self.chunks).to_numpy(zero_copy_only=False).astype(np.int64)
        return at[coded.indices.to_numpy()]

    def part(self, raw: np.ndarray, offsets: np.ndarray, begins: np.ndarray) -> tuple:
        """For texts of whole chunks: (bad or not, numbers, strings of each chunk by text,
        and (text, pair, times) of the linked pairs)."""
        n = len(offsets) - 1
        which = self._numbered(raw, begins)
        first = np.searchsorted(begins, offsets)
        text = np.repeat(np.arange(n), np.diff(first))
        bad = np.bincount(text[self.bad[which]], minlength=n) > 0
        summed = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(self.numbers[which], axis=0)])
        numbers = np.where(bad[:, None], 0, summed[first[1:]] - summed[first[:-1]])
        strings = [[] if bad[i] else self.strings[which[first[i]:first[i + 1]]].tolist() for i in range(n)]
        # distinct chunks of each text, then their pairs
        fits = ~bad[text]
        both, often = np.unique(text[fits] * len(self.bad) + which[fits], return_counts=True)
        of, chunk = np.divmod(both, len(self.bad))
        sizes = self.pair_first[chunk + 1] - self.pair_first[chunk]
        at = tw.ranges(self.pair_first[chunk], sizes)
        distinct, pair = np.unique(self.pairs[at], return_inverse=True)
        times = self.times[at] * np.repeat(often, sizes)
        both, where = np.unique(np.repeat(of, sizes) * max(1, len(distinct)) + pair, return_inverse=True)
        of, pair = np.divmod(both, max(1, len(distinct)))
        return bad, numbers, strings, of, distinct[pair], np.bincount(where, times, len(both)).astype(np.int64)

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(n_a, n_b, n_groups, n_links for each text; sha256 of its groups; text, pair and times of its links).
        A null or empty text, and one that does not come back whole, has no tokens."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        full = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string()))
        full = pc.if_else(pc.equal(texts, ""), pa.scalar("", pa.large_string()), full)
        raw, offsets = tw.text_bytes(full)
        begins = cuts(raw, offsets)
        if len(raw) <= 2 * TEXT_SLICE or len(texts) > 1:
            bad, numbers, strings, of, pairs, times = self.part(raw, offsets, begins)
            shas = [hashlib.sha256(";".join(s).encode()).hexdigest() if s else "" for s in strings]
            return numbers, shas, of, pairs, times
        return self._long(raw, begins)

    def _long(self, raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """One long text, in parts of whole chunks."""
        starts = np.unique(begins[np.searchsorted(begins, np.arange(0, begins[-1] + 1, TEXT_SLICE))])
        total, sha, pairs, times = np.zeros((1, 4), np.int64), hashlib.sha256(), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for a, b in zip(starts, np.append(starts[1:], len(raw)), strict=True):
            own = begins[(begins >= a) & (begins < b)] - a
            bad, numbers, strings, _, p, t = self.part(raw[a:b], np.array([0, b - a]), own)
            if bad[0]:
                return np.zeros((1, 4), np.int64), [""], np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
            total += numbers
            sha.update((";" * bool(a) + ";".join(strings[0])).encode())
            pairs, where = np.unique(np.concatenate([pairs, p]), return_inverse=True)
            times = np.bincount(where, np.concatenate([times, t]), len(pairs)).astype(np.int64)
        return total, [sha.hexdigest()], np.zeros(len(pairs), np.int64), pairs, times


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner, kept between tasks."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


BLOCKS = ("block string, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_pairs long, "
          "gaps binary, times binary, pairs binary, documents binary")
NAMES = [x.split()[0] for x in BLOCKS.split(", ")]
KINDS = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]] for x in BLOCKS.split(", ")]


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Stored blocks of documents.  A document's row holds its numbers and its linked pairs, as
    places in the block's list (gaps between them) and how often each is linked; one more row
    holds that list (``pairs``) and how many documents of the block have each (``documents``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for batch in tw.small_batches(batches, "text", TEXT_SLICE):
            n = batch.num_rows
            numbers, shas, of, pairs, times = own.texts(batch.column("text"))
            listed, place = np.unique(pairs, return_inverse=True)
            counts = np.bincount(of, minlength=n)
            gaps = np.diff(place, prepend=0)
            first = np.cumsum(counts) - counts
            gaps[first[counts > 0]] = place[first[counts > 0]]
            columns = [[uuid.uuid4().hex] * n, batch.column("doc_id").cast(pa.int64()).to_pylist(), *numbers.T.tolist(), shas, counts.tolist()]
            for values in (gaps, times):
                control, data, i, j = encode(values, counts)
                columns.append([control[a:b].tobytes() + data[c:d].tobytes() for a, b, c, d in zip(i[:-1], i[1:], j[:-1], j[1:], strict=True)])
            columns += [[None] * n] * 2
            last = [columns[0][0]] + [None] * 9 + [listed.astype("<u8").tobytes(), np.bincount(place, minlength=len(listed)).astype("<i8").tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([*c, x], k) for c, x, k in zip(columns, last, KINDS, strict=True)], NAMES)

    return stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, BLOCKS), "aligned", "zstd")


def _pair_rows(blocks: DataFrame, same: np.ndarray) -> tuple[np.ndarray, DataFrame]:
    """(documents for each id of A that hold it linked to the id with its bytes; rows (block, pair, n) of all other pairs)."""
    lists = blocks.where(F.col("pairs").isNotNull()).select("block", "pairs", "documents")

    def split(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
        for block, pairs, documents in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "documents")), strict=True):
            keys, n = np.frombuffer(pairs, "<u8"), np.frombuffer(documents, "<i8")
            yield block, keys, n, same[keys >> np.uint64(32)] == (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)

    def identical(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(same), np.int64)
        for batch in batches:
            for _, keys, n, plain in split(batch):
                counts[(keys[plain] >> np.uint64(32)).astype(np.int64)] += n[plain]
        met = np.flatnonzero(counts)
        if len(met):
            yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], ["a", "n"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, keys, n, plain in split(batch):
                yield pa.RecordBatch.from_arrays([pa.array([block] * int((~plain).sum()), pa.string()), pa.array(keys[~plain].astype(np.int64)),
                                                  pa.array(n[~plain])], ["block", "pair", "n"])

    vector = np.zeros(len(same), np.int64)
    # one row for each id of A at most
    for r in lists.mapInArrow(identical, "a long, n long").groupBy("a").agg(F.sum("n").alias("n")).collect():
        vector[r["a"]] = r["n"]
    return vector, lists.mapInArrow(others, "block string, pair long, n long")


def aligned_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row of ``docs`` (doc_id, text).

    ``n_links`` counts the overlapping pairs of token occurrences, ``count_sum`` sums over them how many documents
    hold their id pair linked, ``n_best`` counts those whose pair no other pair of their id of A beats.  Null and empty texts,
    and texts that a tokenizer does not give back, have no tokens: zeros and an empty string.  Null doc_ids
    and repeated rows are documents like any other; other columns are not read; an empty table gives no rows."""
    blocks = aligned_blocks(docs, path_a, path_b)
    same = aligner(path_a, path_b).same
    vector, others = _pair_rows(blocks, same)
    totals = stored(others.groupBy("pair").agg(F.sum("n").alias("total")), "pair-totals")
    best = vector.copy()
    for r in totals.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("total").alias("n")).collect():  # at most one row for each id of A
        best[r["a"]] = max(best[r["a"]], r["n"])
    found = others.select("block", "pair").join(totals, "pair").select("block", "pair", "total")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        lists = left.filter(pc.is_valid(left["pairs"]))
        rows = left.filter(pc.is_null(left["pairs"]))
        keys = np.frombuffer(lists["pairs"][0].as_py(), "<u8")
        a = (keys >> np.uint64(32)).astype(np.int64)
        known, total = right["pair"].to_numpy(), right["total"].to_numpy()
        order = np.argsort(known)
        plain = same[a] == (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        count = vector[a]
        count[~plain] = total[order[np.searchsorted(known[order], keys[~plain].astype(np.int64))]] if (~plain).any() else 0
        top = count == best[a]
        n = rows["n_pairs"].to_numpy()
        values = []
        for name in ("gaps", "times"):
            held = rows[name].to_pylist()
            control = [np.frombuffer(x, np.uint8, -(-int(k) // 4)) for x, k in zip(held, n, strict=True)]
            data = [np.frombuffer(x, np.uint8, offset=-(-int(k) // 4)) for x, k in zip(held, n, strict=True)]
            values.append(decode(np.concatenate(control), np.concatenate(data), n).astype(np.int64))
        gaps, times = values
        ends = np.concatenate([[0], np.cumsum(n)])
        place = np.cumsum(gaps)
        place -= np.repeat(np.concatenate([[0], place])[ends[:-1]], n)
        sums = [np.diff(np.concatenate([[0], np.cumsum(x)])[ends]) for x in (times * top[place], times * count[place])]
        return pa.table({"doc_id": rows["doc_id"], "n_a": rows["n_a"], "n_b": rows["n_b"], "n_groups": rows["n_groups"], "n_links": rows["n_links"],
                         "n_best": pa.array(sums[0]), "count_sum": pa.array(sums[1]), "groups_sha256": rows["groups_sha256"]})

    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(
        finish, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
