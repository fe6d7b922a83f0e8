"""Quality classifier: a small convolutional network over bytes, in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it.  Each
byte is a vector of class flags and two fixed numbers; learned filters slide over
a chunk, and the maximum of each filter is the chunk's vector.  Mean, maximum and
minimum over the chunks are the text's vector, from which a hidden layer makes
one probability.

Training takes a bounded sample (``SAMPLE_ROWS`` of each label, in the order of a
hash, texts of at most ``SAMPLE_TEXT`` bytes) on the driver.  Scoring reads every
whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ledgerlens.llm import textwords as tw

CHUNK, STEP = 128, 96
WIDTH, STRIDE = 8, 4
FILTERS, HIDDEN = 24, 16
EPOCHS, BATCH, RATE = 14, 64, 0.004
SAMPLE_ROWS = 1500
SAMPLE_TEXT = 20_000
#: Chunks held as floats at once.
BLOCK_CHUNKS = 4096


def byte_vectors() -> np.ndarray:
    """256 x 8: flags of six byte classes and two fixed numbers."""
    b = np.arange(256)
    upper, lower, digit = (b >= 65) & (b <= 90), (b >= 97) & (b <= 122), (b >= 48) & (b <= 57)
    blank, high = (b == 32) | ((b >= 9) & (b <= 13)), b >= 128
    other = ~(upper | lower | digit | blank | high) & (b > 0)
    noise = np.random.default_rng(5).uniform(-1, 1, (2, 256))
    noise[:, 0] = 0  # padding
    return np.stack([upper, lower, digit, blank, high, other, *noise], axis=1).astype(np.float32)


BYTES = byte_vectors()
DEPTH = BYTES.shape[1]
PLACES = (CHUNK - WIDTH) // STRIDE + 1


def chunks_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(chunks as rows of bytes, number of chunks of each text, at least one)."""
    sizes = np.diff(offsets)
    n = np.maximum(1, -(-np.maximum(sizes - (CHUNK - STEP), 1) // STEP))
    text = np.repeat(np.arange(len(sizes)), n)
    begin = offsets[:-1][text] + (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * STEP
    at = begin[:, None] + np.arange(CHUNK)
    inside = at < offsets[1:][text][:, None]
    padded = np.append(raw, np.uint8(0))
    return np.where(inside, padded[np.where(inside, at, len(raw))], 0).astype(np.uint8), n


def windows(chunks: np.ndarray) -> np.ndarray:
    """(chunks, places, WIDTH * DEPTH), a view over the byte vectors."""
    x = np.ascontiguousarray(BYTES[chunks])
    s = x.strides
    return np.lib.stride_tricks.as_strided(x, (len(x), PLACES, WIDTH * DEPTH), (s[0], s[1] * STRIDE, s[2]), writeable=False)


@dataclass
class Network:
    filters: np.ndarray  # WIDTH * DEPTH x FILTERS
    bias: np.ndarray
    hidden: np.ndarray  # 3 * FILTERS x HIDDEN
    hidden_bias: np.ndarray
    out: np.ndarray  # HIDDEN
    out_bias: np.ndarray

    @staticmethod
    def start(seed: int = 3) -> Network:
        r = np.random.default_rng(seed)
        draw = lambda n, m: (r.standard_normal((n, m)) * np.sqrt(2 / n)).astype(np.float32)
        return Network(draw(WIDTH * DEPTH, FILTERS), np.zeros(FILTERS, np.float32), draw(3 * FILTERS, HIDDEN),
                       np.zeros(HIDDEN, np.float32), draw(HIDDEN, 1)[:, 0], np.zeros(1, np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def chunk_maxima(self, chunks: np.ndarray) -> np.ndarray:
        parts = [np.maximum((windows(chunks[i:i + BLOCK_CHUNKS]) @ self.filters).max(axis=1) + self.bias, 0)
                 for i in range(0, len(chunks), BLOCK_CHUNKS)]
        return np.concatenate(parts) if parts else np.zeros((0, FILTERS), np.float32)

    def combined(self, maxima: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first = np.cumsum(n) - n
        pooled = np.concatenate([np.add.reduceat(maxima, first) / n[:, None].astype(np.float32),
                                 np.maximum.reduceat(maxima, first), np.minimum.reduceat(maxima, first)], axis=1)
        h = np.maximum(pooled @ self.hidden + self.hidden_bias, 0)
        z = np.clip(h @ self.out + self.out_bias[0], -30, 30)
        return pooled, h, 1 / (1 + np.exp(-z))

    def score(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        chunks, n = chunks_of(*tw.text_bytes(texts))
        return self.combined(self.chunk_maxima(chunks), n)[2].astype(np.float64)

    def gradients(self, chunks: np.ndarray, n: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        win = windows(chunks)
        raw = win @ self.filters
        top = raw.argmax(axis=1)
        maxima = np.maximum(np.take_along_axis(raw, top[:, None, :], 1)[:, 0] + self.bias, 0)
        pooled, h, p = self.combined(maxima, n)
        dz = (((p - labels) * weight) / weight.sum()).astype(np.float32)
        dh = dz[:, None] * self.out * (h > 0)
        dp = dh @ self.hidden.T
        text = np.repeat(np.arange(len(n)), n)
        mean, high, low = dp[:, :FILTERS], dp[:, FILTERS:2 * FILTERS], dp[:, 2 * FILTERS:]
        dm = (mean / n[:, None].astype(np.float32))[text]
        for part, of in ((high, pooled[:, FILTERS:2 * FILTERS]), (low, pooled[:, 2 * FILTERS:])):
            at = maxima == of[text]  # shared by the chunks that tie
            ties = np.add.reduceat(at.astype(np.float32), np.cumsum(n) - n)
            dm += at * (part / ties)[text]
        dm *= maxima > 0
        hit = np.take_along_axis(win, top.transpose(0, 1)[:, :, None], 1)  # chunks x filters x inputs
        return [np.einsum("cf,cfi->if", dm, hit), dm.sum(axis=0), pooled.T @ dh, dh.sum(axis=0), h.T @ dz, np.array([dz.sum()])]


def train(rows: list[tuple[str, int]], counts: dict[int, int], epochs: int = EPOCHS) -> Network:
    """Fit to (text, label) rows; ``counts`` has how often each label occurs in all
    training rows, so that the probability fits them and not the balanced sample."""
    net = Network.start()
    rows = sorted(rows, key=lambda r: (len(r[0]), r[0]))
    labels = np.array([y for _, y in rows], np.float32)
    if not len(rows) or labels.min() == labels.max():
        share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
        net.out[:] = 0
        net.out_bias[0] = np.log(share / (1 - share))
        return net
    chunks, n = chunks_of(*tw.text_bytes(pa.array([t for t, _ in rows], pa.string())))
    first = np.cumsum(n) - n
    each = np.array([1 / (labels == y).mean() for y in labels], np.float32)  # both labels weigh the same
    rng = np.random.default_rng(9)
    state = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    step, total = 0, epochs * -(-len(rows) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for i in range(0, len(rows), BATCH):
            pick = order[i:i + BATCH]
            step += 1
            rate = RATE * (1 - step / (total + 1))
            grads = net.gradients(chunks[tw.ranges(first[pick], n[pick])], n[pick], labels[pick], each[pick])
            for w, g, (m, v) in zip(net.weights(), grads, state, strict=True):
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                w -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def remainder(column: str, of: int) -> Column:
    """crc32 of the column as text, modulo ``of``."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(of))


def fit(docs: DataFrame, labels: DataFrame, training: Column, rows: int = SAMPLE_ROWS) -> Network:
    """A network for ``labels.quality`` from the rows of ``labels`` where ``training``
    (a condition on doc_id) holds.  Null texts and labels other than 0 and 1 teach nothing."""
    known = labels.where(training & F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    order = [F.xxhash64("doc_id", F.lit(17)), F.col("doc_id")]
    ids = [known.where(F.col("quality") == y).orderBy(*order).limit(rows) for y in (0, 1)]
    # at most 2 * rows ids, so they may be broadcast; one text of SAMPLE_TEXT bytes for each
    sample = (docs.select("doc_id", "text").join(F.broadcast(ids[0].unionAll(ids[1])), "doc_id")
              .where(F.octet_length("text") <= SAMPLE_TEXT).groupBy("doc_id", "quality").agg(F.min("text").alias("text")).collect())
    return train([(r["text"], r["quality"]) for r in sample], counts)


def scored(docs: DataFrame, network: Network, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with ``score``, the probability of label 1 of each whole text.

    Null and empty texts are scored as one empty chunk.  All columns and rows stay; a
    column already named ``score`` is replaced."""
    keep = docs.drop(score)
    sent = docs.sparkSession.sparkContext.broadcast(network)
    schema = StructType([*keep.schema.fields, StructField(score, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tw.small_batches(batches, text, 2 << 20):
            scores = pa.array(sent.value.score(batch.column(text)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, score])
        tw.release()

    return keep.mapInArrow(run, schema)
