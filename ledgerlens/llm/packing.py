"""Best-fit packing of tokenised documents by swap-based local search.

Pieces are dealt at random into groups of about ``GROUP_PIECES``.  A group is
packed best-fit, longest first; then local search works on its underfull bins: it
moves a piece, exchanges one for one, or two for one, between two of them, always
towards the fuller bin, so that the sum of squared fills grows, until a pass finds
nothing; bins that run empty are gone.  The pieces of bins that stay underfull are
dealt into new, fewer groups and packed again, ``ROUNDS`` times in all.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textwords as tw
from ledgerlens.llm.storage import stored
from ledgerlens.llm.wordids import word_ids

CAPACITY = 4096
END_ID = 1
GROUP_PIECES = 20_000
ROUNDS = 3
#: Bins of at least this fill are left alone by later rounds.
FULL = 0.998
#: Partner bins that one pass of the local search tries for a bin; a pass without gain is
#: followed by one with the next partners, until all were tried.
PARTNERS = 64
#: Bytes of text encoded at once.
TOKEN_SLICE = 4 << 20

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, salt int"


# --- token ids ---------------------------------------------------------------
def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``capacity`` ids of each row of ``docs`` (doc_id, text).

    A document is the ids of its whole text by the tokenizer's plain call (without special
    tokens added; their strings in a text are what the call makes of them) and ``end_id``; null
    counts as empty and is one piece of one id.  Only documents longer than ``capacity`` are cut.
    ``salt`` is drawn at random, to tell equal rows apart: store the pieces before using it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, draw = word_ids(path), random.Random()
        for batch in tw.small_batches(batches, "text", TOKEN_SLICE):
            ids, off = coder.of_texts(batch.column("text"))
            rows: list[tuple] = []
            for r, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                own = np.append(ids[off[r]:off[r + 1]], end_id).astype("<u4")
                for piece, start in enumerate(range(0, len(own), capacity)):
                    part = own[start:start + capacity]
                    rows.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes()), draw.getrandbits(31)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "salt"])
        tw.release()

    return docs.select("doc_id", "text").mapInArrow(run, PIECE)


# --- packing one group ---------------------------------------------------------
def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest item first, each into the fullest bin that holds it."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free room
    rooms = 0  # a bit for each room that has bins
    bins: list[list[int]] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fit = rooms >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        room -= n
        by_room[room].append(b)
        rooms |= 1 << room
    return bins


class Swaps:
    """Local search over the underfull bins of a group."""

    def __init__(self, bins: list[list[int]], lengths: np.ndarray, capacity: int):
        self.capacity = capacity
        # a bin: sorted [(length, item)]
        self.bins = {b: sorted((int(lengths[i]), i) for i in items) for b, items in enumerate(bins)}
        self.fill = {b: sum(n for n, _ in items) for b, items in self.bins.items()}
        self.order = sorted((f, b) for b, f in self.fill.items() if f < capacity)  # underfull, by fill

    def _change(self, b: int, out: list[tuple], into: list[tuple]) -> None:
        at = bisect_right(self.order, (self.fill[b], b)) - 1
        if at >= 0 and self.order[at] == (self.fill[b], b):
            del self.order[at]
        for x in out:
            self.bins[b].remove(x)
        for x in into:
            insort(self.bins[b], x)
        self.fill[b] += sum(n for n, _ in into) - sum(n for n, _ in out)
        if not self.bins[b]:
            del self.bins[b], self.fill[b]
        elif self.fill[b] < self.capacity:
            insort(self.order, (self.fill[b], b))

    def _best(self, low: int, high: int) -> tuple[int, list[tuple], list[tuple]]:
        """The largest gain of bin ``high``: (gain, pieces from low, pieces given back)."""
        a, room = self.bins[low], self.capacity - self.fill[high]
        best: tuple[int, list[tuple], list[tuple]] = (0, [], [])
        seen = -1
        for give in [(0, -1), *self.bins[high]]:
            if give[0] == seen:
                continue  # the same length again
            seen, most = give[0], give[0] + room
            i = bisect_right(a, (most, 1 << 60)) - 1
            back = [give] if give[1] >= 0 else []
            if i >= 0 and a[i][0] - give[0] > best[0]:
                best = (a[i][0] - give[0], [a[i]], back)
            if back:  # two for one: the best pair sum of at most `most`
                lo, hi = 0, len(a) - 1
                while lo < hi:
                    pair = a[lo][0] + a[hi][0]
                    if pair > most:
                        hi -= 1
                    else:
                        if pair - give[0] > best[0]:
                            best = (pair - give[0], [a[lo], a[hi]], back)
                        lo += 1
            if best[0] == room:
                break
        return best

    def run(self) -> list[list[int]]:
        """Bins of one make-up (the same lengths) gain alike, so only one of them is tried for all."""
        skip = 0  # partners that were tried by a pass without gain
        while True:
            alike: dict[tuple[int, ...], list[int]] = {}
            for _, b in self.order:
                alike.setdefault(tuple(n for n, _ in self.bins[b]), []).append(b)
            kinds = list(alike.values())  # from the emptiest up
            if skip >= len(kinds):
                break
            partners, improved = kinds[::-1][skip:skip + PARTNERS], False
            for lows in kinds:
                for highs in partners:
                    # towards the fuller bin, so the sum of squares grows
                    while lows and len(highs) > (highs is lows) and self.fill[highs[0]] >= self.fill[lows[-1]]:
                        low, high = lows[-1], highs[-1 - (highs is lows)]
                        gain, out, back = self._best(low, high)
                        if gain <= 0:
                            break
                        self._change(low, out, back)
                        self._change(high, back, out)
                        lows.remove(low)  # both have another make-up now
                        highs.remove(high)
                        improved = True
            skip = 0 if improved else skip + PARTNERS
        return [[i for _, i in items] for items in self.bins.values()]


def pack_group(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    return Swaps(best_fit(lengths, capacity), lengths, capacity).run()


# --- packing a table -------------------------------------------------------------
def _packed(rows: DataFrame, capacity: int, level: int) -> DataFrame:
    """Group by ``_group``; gives ``sequence_id``, ``offset`` and ``_fill``."""
    out = [f for f in rows.schema.fields if f.name not in ("_group", "sequence_id", "offset", "_fill")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out) + ", sequence_id bigint, offset bigint, _fill bigint"
    names = [f.name for f in out]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        group = int(pdf["_group"].iloc[0])
        pdf = pdf.sort_values(["length", "_draw"], kind="stable").reset_index(drop=True)  # the same in a repeated task
        lengths = pdf["length"].to_numpy(np.int64)
        sequence, offset, fill = (np.zeros(len(pdf), np.int64) for _ in range(3))
        for b, items in enumerate(pack_group(lengths, capacity)):
            n = lengths[items]
            sequence[items] = (level << 56) + (group << 24) + b
            offset[items] = np.cumsum(n) - n
            fill[items] = n.sum()
        return pdf[names].assign(sequence_id=sequence, offset=offset, _fill=fill)

    return rows.groupBy("_group").applyInPandas(run, schema)


def pack(pieces: DataFrame, key: list[Column], capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: sequences of at most
    ``capacity``, each gapless from 0.  ``length`` is 1 to ``capacity``; ``key``
    deals rows to groups, so it should tell them apart.  An empty table stays empty."""
    names = pieces.columns
    rows = pieces.withColumn("_draw", F.xxhash64(*key))
    done = None
    for level in range(ROUNDS):
        n = rows.count()
        if not n and done is not None:
            break
        groups = max(1, -(-n // group_pieces))
        placed = stored(_packed(rows.withColumn("_group", F.pmod(F.xxhash64("_draw", F.lit(level)), F.lit(groups))), capacity, level),
                        f"packed-{level}")
        last = level == ROUNDS - 1 or groups == 1  # one group was searched whole
        kept = placed if last else placed.where(F.col("_fill") >= int(FULL * capacity))
        done = kept if done is None else done.unionByName(kept)
        if last:
            break
        rows = placed.where(F.col("_fill") < int(FULL * capacity)).select(*names, "_draw")
    return done.select(*names, "sequence_id", "offset")


def packed_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Token pieces of ``docs`` (doc_id, text) packed into sequences; see
    ``token_pieces`` and ``pack``.  Other columns are dropped; null doc_ids and
    repeated rows are packed like any other row."""
    pieces = stored(token_pieces(docs, path, capacity), "pieces")
    return pack(pieces, [F.col(c) for c in ("doc_id", "piece", "ids_crc32", "salt")], capacity).drop("salt")
