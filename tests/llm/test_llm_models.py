"""The byte network and the compression classifier against plain loops."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from ledgerlens.llm import langid, quality

TEXTS = ["", "Plain words, twice.", "é ñ 日本 🙂 " * 40, "x" * 700, "ABC 123\n\n!!! " * 90, "short"]


def plain_score(net: quality.Network, text: str) -> float:
    """One text by loops: chunks of the whole text, each filter at each place, the largest per chunk, then
    mean, largest and least over the chunks, one hidden layer and one probability."""
    raw = text.encode()
    n = max(1, math.ceil(max(len(raw) - (quality.CHUNK - quality.STEP), 1) / quality.STEP))
    maxima = []
    for c in range(n):
        chunk = raw[c * quality.STEP:c * quality.STEP + quality.CHUNK].ljust(quality.CHUNK, b"\0")
        best = [-math.inf] * quality.FILTERS
        for p in range(0, quality.CHUNK - quality.WIDTH + 1, quality.STRIDE):
            seen = np.concatenate([quality.BYTES[b] for b in chunk[p:p + quality.WIDTH]]).astype(float)
            for f in range(quality.FILTERS):
                best[f] = max(best[f], float(seen @ net.filters[:, f]))
        maxima.append([max(0.0, best[f] + float(net.bias[f])) for f in range(quality.FILTERS)])
    per_filter = list(zip(*maxima, strict=True))
    pooled = np.array([sum(x) / n for x in per_filter] + [max(x) for x in per_filter] + [min(x) for x in per_filter])
    hidden = [max(0.0, float(pooled @ net.hidden[:, h]) + float(net.hidden_bias[h])) for h in range(quality.HIDDEN)]
    z = sum(a * float(b) for a, b in zip(hidden, net.out, strict=True)) + float(net.out_bias[0])
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def test_scores_equal_plain_loops():
    net = quality.Network.start(7)
    got = net.score(pa.array([*TEXTS, None]))
    assert got == pytest.approx([plain_score(net, t) for t in [*TEXTS, ""]], abs=1e-4)


def test_every_byte_is_in_a_chunk():
    for size in (0, 1, quality.CHUNK - 1, quality.CHUNK, quality.CHUNK + 1, 3 * quality.CHUNK + 17):
        raw = np.arange(size, dtype=np.int64) % 251 + 1
        chunks, n = quality.chunks_of(raw.astype(np.uint8), np.array([0, size]))
        places = {c * quality.STEP + i for c in range(n[0]) for i in range(quality.CHUNK)}
        assert set(range(size)) <= places
        assert all(chunks[c, i] == (raw[c * quality.STEP + i] if c * quality.STEP + i < size else 0) for c in range(n[0]) for i in range(0, quality.CHUNK, 13))


def loss(net, chunks, n, labels, weight):
    _, _, p = net.combined(net.chunk_maxima(chunks), n)
    p = np.clip(p.astype(float), 1e-9, 1 - 1e-9)
    return float((weight * -(labels * np.log(p) + (1 - labels) * np.log(1 - p))).sum() / weight.sum())


def test_gradients_equal_differences():
    net = quality.Network.start(5)
    for w in net.weights():  # as differences need more digits
        assert w.dtype == np.float32
    net = quality.Network(*[w.astype(np.float64) for w in net.weights()])
    letters = np.random.default_rng(4).choice(list("abcdefgh ABC.,1290\n"), (3, 700))  # nothing repeats, so no maximum is shared
    texts = ["".join(x[:k]) for x, k in zip(letters, (700, 300, 128), strict=True)]
    chunks, n = quality.chunks_of(*quality.tw.text_bytes(pa.array(texts, pa.string())))
    labels, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])
    grads, rng = net.gradients(chunks, n, labels, weight), np.random.default_rng(2)
    for w, g in zip(net.weights(), grads, strict=True):
        for at in rng.integers(0, w.size, min(12, w.size)):
            held, step = w.flat[at], 1e-6
            w.flat[at] = held + step
            up = loss(net, chunks, n, labels, weight)
            w.flat[at] = held - step
            down = loss(net, chunks, n, labels, weight)
            w.flat[at] = held
            assert float(np.asarray(g).flat[at]) == pytest.approx((up - down) / (2 * step), rel=2e-2, abs=2e-5)


RAW = {"en": b"the quick brown fox jumps over the lazy dog and the cat " * 20, "fr": "le renard brun saute par-dessus le chien paresseux été ".encode() * 20,
       "de": "der schnelle braune fuchs springt über den faulen hund ".encode() * 20}


@pytest.mark.parametrize("text", ["The quick brown dog", "Le chien été", "über den Hund", "x", "the cat " * 3000])
def test_predictions_equal_plain_sizes(text):
    """The language whose dictionary leaves the fewest bytes, counted with fresh compressors for each block."""
    raw = text.lower().encode()
    sizes = {}
    for name, content in RAW.items():
        sizes[name] = 0
        for i in range(0, len(raw), langid.BLOCK_BYTES):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            c = zstandard.ZstdCompressor(dict_data=d, level=langid.LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False)
            sizes[name] += len(c.compress(raw[i:i + langid.BLOCK_BYTES]))
    best, second = sorted(sizes.values())[:2]
    name, score, rejected = langid.Coder(RAW).predict(text)
    assert sizes[name] == best and name == next(x for x in RAW if sizes[x] == best)
    assert rejected == ((second - best) / second < langid.NARROW) and score == pytest.approx(1 - math.exp(-(second - best) / second / langid.SCALE))


@pytest.mark.parametrize("text", [None, "", "123 !!!", "\n"])
def test_texts_without_letters_are_unknown(text):
    assert langid.Coder(RAW).predict(text) == (langid.UNKNOWN, 0.0, True)
