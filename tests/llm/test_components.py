"""Components and rounds of centres: right, and no step more than it takes."""

from __future__ import annotations

import random

import pytest

from ledgerlens.llm import components, neardup
from tests.llm import brute


@pytest.fixture
def steps(monkeypatch):
    """Names of the tables that are stored."""
    names, store = [], components.stored

    def counted(df, name, *more):
        names.append(name)
        return store(df, name, *more)

    monkeypatch.setattr(components, "stored", counted)
    monkeypatch.setattr(neardup, "stored", counted)
    return names


def test_stars_take_one_step(llm_spark, steps):
    edges = [(i, 1) for i in range(2, 30)] + [(50, 40), (40, 50), (60, 60)]
    got = components.components(llm_spark.createDataFrame(edges, "u long, v long")).collect()
    assert sorted(map(tuple, got)) == [(i, 1) for i in range(2, 30)] + [(50, 40)]
    assert steps == ["links"]


def test_components_of_chains_and_random_links(llm_spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 140)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    least = {x: x for e in edges for x in e}
    for _ in least:
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    got = components.components(llm_spark.createDataFrame(edges, "u long, v long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, m) for x, m in least.items() if x != m)


def test_rounds_end_when_all_outside_the_largest_component_have_been_centres(llm_spark, steps):
    """Texts that share a bucket but no link: the round that compares them is the last."""
    base = [f"b{i}" for i in range(120)]
    rows = [(i, " ".join(base[:108] + [f"x{i}_{j}" for j in range(12)])) for i in range(6)] + [(9, " ".join(base))]
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(llm_spark.createDataFrame(rows, "doc_id bigint, text string"), 2).collect()}
    assert got == {d: c for d, _, c, _ in brute.components(rows)} and len(set(got.values())) == 1
    rows = [(i, " ".join(base[:102] + [f"x{i}_{j}" for j in range(18)])) for i in range(6)]
    steps.clear()
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(llm_spark.createDataFrame(rows, "doc_id bigint, text string"), 2).collect()}
    assert got == {d: c for d, _, c, _ in brute.components(rows)} == {i: i for i in range(6)}
    assert steps.count("active") == 1
