"""Words of Arrow string columns as numpy arrays: positions and 64-bit hashes.

All work is on UTF-8 bytes, so a class of separator *bytes* defines the words:
every byte from 0x80 up belongs to a multi-byte character and is a word byte.
Nulls count as empty texts.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20  # texts handled at once; a longer text is a slice of its own
BLOCK_BYTES = 1 << 16  # bytes hashed at once, few enough for a core's cache

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (the splitmix64 finaliser)."""
    x = np.asarray(x, U64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def random_words(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


SPACE_SEPARATED = np.ones(256, bool)
SPACE_SEPARATED[[0x20, *range(0x09, 0x0E)]] = False

ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[0x80:] = True
ALPHANUMERIC[0x30:0x3A] = True
ALPHANUMERIC[0x61:0x7B] = True

NO_FOLD = np.arange(256, dtype=np.uint8)
LOWER = NO_FOLD.copy()
LOWER[0x41:0x5B] += 32

_BYTE_CODES = random_words(256, 7)
_BASE = U64(0xD6E8FEB86659FD93)  # odd, so it has an inverse modulo 2**64
_POWERS = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        with np.errstate(over="ignore"):
            for name, base in (("up", int(_BASE)), ("down", pow(int(_BASE), -1, 1 << 64))):
                steps = np.full(n, base, U64)
                steps[0] = 1
                _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets): text i is ``bytes[offsets[i]:offsets[i + 1]]``."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


@dataclass
class Words:
    """Words of some texts, in order.  ``first[i]:first[i + 1]`` are text i's."""

    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    raw: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def translated(raw: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``table[raw]`` for a table of 256 bytes or booleans, without indices of eight bytes each."""
    return np.frombuffer(raw.tobytes().translate(table.tobytes()), table.dtype)


def find_words(raw: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end positions of the maximal runs of word bytes in each text."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = translated(raw, word_bytes)
    opens = inside.copy()
    np.greater(inside[1:], inside[:-1], out=opens[1:])
    closes = inside.copy()
    np.greater(inside[:-1], inside[1:], out=closes[:-1])
    edge = offsets[(offsets > 0) & (offsets < n)]
    opens[edge] = inside[edge]
    closes[edge - 1] = inside[edge - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def words_of(texts: pa.Array, word_bytes: np.ndarray, fold: np.ndarray = NO_FOLD) -> Words:
    """Words after ``fold`` (a byte-to-byte table) was applied."""
    raw, offsets = text_bytes(texts)
    if fold is not NO_FOLD:
        raw = translated(raw, fold)
    start, end = find_words(raw, offsets, word_bytes)
    hashes = np.empty(len(start), U64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(start):
            j = max(i + 1, int(np.searchsorted(end, start[i] + BLOCK_BYTES, "right")))
            lo, hi = start[i], end[j - 1]
            up, down = _powers(int(hi - lo) + 1)
            sums = np.zeros(hi - lo + 1, U64)
            np.cumsum(_BYTE_CODES[raw[lo:hi]] * up[:-1], out=sums[1:])
            s, e = start[i:j] - lo, end[i:j] - lo
            hashes[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U64) * _BYTE_CODES[1])
            i = j
    return Words(np.searchsorted(start, offsets), start, end, hashes, raw)


def sequence_hashes(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of each ``k`` consecutive words (positions that cross texts included)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    codes = random_words(k, 1000 + seed)
    out = np.zeros(n, U64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out = mix(out + (hashes[j:j + n] ^ codes[j]) * (codes[j] | U64(1)))
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(s, s + n)`` of all pairs."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(np.asarray(starts, np.int64) - (np.cumsum(lengths) - lengths), lengths)
    return np.arange(total) + shift


def release() -> None:
    """Give freed memory back to the machine: Python workers live on between tasks, beside
    the executor's heap.  Without glibc only Arrow's part."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def distinct(x: np.ndarray) -> np.ndarray:
    """The sorted distinct numbers of ``x`` (``np.unique`` hashes them first, which takes far longer)."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])[:len(x)]]


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mask of the positions below ``n`` inside any ``[start, end)``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:n]) > 0


def small_batches(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of Arrow batches with at most ``limit`` bytes of text or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        at = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        i, before = 0, 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(at, before + limit, "right")))
            yield batch.slice(i, j - i)
            i, before = j, at[j - 1]
