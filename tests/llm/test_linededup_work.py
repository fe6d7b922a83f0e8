"""How much line de-duplication does: words are looked for only where they are needed, and the faster forms give what the plain ones do."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import linededup as ld
from ledgerlens.llm import textwords as tw
from ledgerlens.llm.bloom import LONGS

LEVELS = np.zeros(1 << ld.COUNTER_BITS, np.uint8)
NOTHING = np.zeros(LONGS, np.uint64)


def batch(texts: list[str | None]) -> pa.RecordBatch:
    n = len(texts)
    return pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([0] * n, pa.int64()), pa.array(texts, pa.string())], ["doc", "key", "text"])


def test_only_asked_lines_are_cut_into_words():
    texts = batch([None, "", "\n".join(f"a{i} b{i} c{i} d{i} e{i}" for i in range(1000))])
    asked = NOTHING.copy()
    own = int(ld.line_hash(np.array([2]), np.array([0]), np.array([7]))[0]) & (LONGS * 64 - 1)
    asked[own >> 6] |= np.uint64(1) << np.uint64(own & 63)
    (ids, lines), = ld.line_blocks(texts, LEVELS, NOTHING, asked)
    assert ids["doc"].tolist() == [2] and ids["line"].tolist() == [7] and lines.size.tolist() == [5]
    every = [x for x in ld.line_blocks(texts, LEVELS, NOTHING)]
    assert sum(len(x["line"]) for x, _ in every) == 1002  # a null text and an empty one have one empty line each
    at = next(i for i, (d, n) in enumerate(zip(every[0][0]["doc"], every[0][0]["line"], strict=True)) if (d, n) == (2, 7))
    assert every[0][1].set[at] == lines.set[0]


def pairs_of_list(sizes: list[int]) -> pa.Table:
    """One word's list of lines of these sizes, equal in their bitmaps (as far as the sizes go), as a group."""
    n = len(sizes)
    lines = {"doc": np.arange(n), "key": np.zeros(n, np.int64), "line": np.zeros(n, np.int64), "size": np.array(sizes),
             "bits": np.zeros(n, np.uint64), "more": np.zeros(n, np.uint64), "twin": np.arange(n)}
    posts = {"word": np.full(n, 9), "salt": np.zeros(n), "at": np.arange(n), "place": np.zeros(n)}
    none = {k: np.zeros(0, np.int64) for k in ld.SET_KINDS}
    blobs = [ld.packed(ld.rows_of_bytes(c, k)) for c, k in ((lines, ld.LINE_KINDS), (posts, ld.POST_KINDS), (none, ld.SET_KINDS), (none, ld.SET_KINDS))]
    return pa.table({c: pa.array([b], pa.binary()) for c, b in zip(("lines", "posts", "sets", "copies"), blobs, strict=True)})


def test_filters_see_only_pairs_of_fitting_sizes(monkeypatch):
    sizes = [10 * 2 ** (i % 6) for i in range(600)]
    compared, whole = [], ld.may_match
    monkeypatch.setattr(ld, "may_match", lambda a, *more: compared.append(len(a)) or whole(a, *more))
    found = ld.list_pairs(pairs_of_list(sizes), 80)
    assert sum(compared) == 6 * 100 * 99 // 2  # before: 600 * 599 / 2
    kinds = found.column("kind").to_numpy()
    got = {(x["doc"], x["early_doc"]) for x in found.to_pylist() if x["kind"] == ld.PAIR}
    want = {(i, j) for i in range(600) for j in [j for j in range(i) if sizes[j] == sizes[i]][:ld.EARLIEST]}
    assert got == want and (kinds == ld.MORE).sum() == 6 * (100 - ld.EARLIEST - 1)


@pytest.mark.parametrize("percent", [50, 67, 80, 100])
def test_length_limits_are_those_of_the_filter(percent):
    a, b = (x.ravel() for x in np.meshgrid(np.arange(1, 300), np.arange(1, 300)))
    ok = ld.may_match(a, b, a * 0, b * 0, a * 0, np.minimum, percent)
    assert not (ok & ~((b >= ld.needed(a, percent)) & (b <= a * 100 // percent))).any()


def test_bytes_of_columns_come_back():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000):
        posts = {"word": rng.integers(0, 1 << 32, n), "salt": rng.integers(0, 9, n), "at": np.arange(n), "place": rng.integers(0, 99, n)}
        back = ld.unpacked(ld.packed(ld.rows_of_bytes(posts, ld.POST_KINDS)), ld.POST_KINDS)
        assert all((back[k] == posts[k]).all() and len(back[k]) == n for k in posts)


def test_order_by_two_numbers():
    rng = np.random.default_rng(2)
    for high in (5, 1 << 40, (1 << 63) - 1):
        first, second = rng.integers(-high, high, 5000, endpoint=True), rng.integers(0, 30, 5000)
        assert (ld.by_two(first, second) == np.lexsort([second, first])).all()
    none = np.zeros(0, np.int64)
    assert len(ld.by_two(none, none)) == 0


def test_words_do_not_depend_on_blocks(monkeypatch):
    texts = pa.array(["ab \tCd " * 9000, None, "", "é" * 70000 + " x", " \n"])
    one = tw.words_of(texts, tw.SPACE_SEPARATED, tw.LOWER)
    monkeypatch.setattr(tw, "BLOCK_BYTES", 1 << 22)
    other = tw.words_of(texts, tw.SPACE_SEPARATED, tw.LOWER)
    for name in ("first", "start", "end", "hash", "raw"):
        assert (getattr(one, name) == getattr(other, name)).all()
    assert one.counts().tolist() == [18000, 0, 0, 2, 0]


def test_both_bitmaps_come_from_one_pass(spark):
    lines = spark.range(500).selectExpr("id % 7 AS doc", "id % 2 AS key", "CAST(id AS INT) AS line")
    texts, own = ld.text_and_line_bitmaps(lines)
    assert (texts == ld.hash_bitmap(lines, of_text=True)).all() and (own == ld.hash_bitmap(lines)).all()
    assert np.bitwise_count(texts).sum() == 14 and np.bitwise_count(own).sum() == 500
    nothing = ld.text_and_line_bitmaps(lines.where("doc < 0"))
    assert not any(x.any() for x in nothing)
