"""Candidate pairs of near-duplicates: those that surely are no link are not formed."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from ledgerlens.llm import neardup
from tests.llm import brute


def test_a_common_passage_does_not_pair_all_that_hold_it(llm_spark, monkeypatch):
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(140)]
    docs = {i: " ".join(passage + [f"w{rng.randrange(10**6)}" for _ in range(60)]) for i in range(0, 600, 2)}
    for i in range(0, 600, 20):  # some have a copy with a word changed
        docs[i + 1] = docs[i].rsplit(" ", 1)[0] + " changed"
    pairs = []
    store = neardup.stored

    def counted(df, name, *more):
        out = store(df, name, *more)
        pairs.append(out.count() if name == "pairs" else 0)
        return out

    monkeypatch.setattr(neardup, "stored", counted)
    df = llm_spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(df, 2).collect()}
    assert got == {d: component for d, _, component, _ in brute.components(list(docs.items()))}
    assert sum(pairs) < 4 * len(docs)


def test_parities_never_differ_in_more_cells_than_the_sets_do(llm_spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(900)]
    texts = ["", None, "one"] + [" ".join(words[a:a + n]) for a, n in ((rng.randrange(300), rng.randrange(1, 600)) for _ in range(60))]
    ids, off = neardup.shingle_sets(pa.array(texts, pa.string()), 2)
    sets = [set(ids[a:b].tolist()) for a, b in zip(off[:-1], off[1:], strict=True)]
    odd = np.array(neardup.parities(ids, off)).view(np.uint64)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            apart = int(np.bitwise_count(odd[:, i] ^ odd[:, j]).sum())
            assert apart <= len(a ^ b) and (apart - len(a ^ b)) % 2 == 0
    assert not odd[:, :2].any() and odd[:, 3:].any()
