"""The pipeline's stages, each against its brute-force decision on its own input."""

from __future__ import annotations

import corpus_pipeline as pipe
from ledgerlens.llm import quality
from ledgerlens.llm.queries import table
from tests.llm import brute

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(llm_spark, tmp_path):
    docs = table(llm_spark, SF, "documents")
    assert [f for _, f in pipe.STAGES] == [pipe.accept_quality, pipe.drop_repeated_lines, pipe.drop_near_duplicates, pipe.drop_contaminated, pipe.pack_sequences]
    for i, (_, stage) in enumerate(pipe.STAGES[:-1]):
        before = {r["doc_id"]: r for r in docs.collect()}
        out = stage(llm_spark, docs, SF)
        assert out.columns == COLUMNS
        out.write.parquet(f"{tmp_path}/{i}")
        docs = llm_spark.read.parquet(f"{tmp_path}/{i}")
        after = {r["doc_id"]: r for r in docs.collect()}
        rows = [(d, r["text"]) for d, r in sorted(before.items())]
        if i == 0:
            net = quality.fit(table(llm_spark, SF, "documents"), table(llm_spark, SF, "labels"), quality.remainder("doc_id", 5) != 0)
            kept = {r["doc_id"] for r in quality.scored(table(llm_spark, SF, "documents"), net).collect() if r["score"] >= 0.3}
        elif i == 1:
            expected = {r[0]: r for r in brute.line_dedup(rows)}
            kept = {d for d, n, gone, _ in expected.values() if not gone or gone < n}
            assert all(len(r["text"]) == r["n_chars"] for r in after.values())
            assert all(len(after[d]["text"].split("\n")) == expected[d][1] - expected[d][2] for d in kept)
        elif i == 2:
            kept = {d for d, _, _, k in brute.components(rows, k=5) if k}
        else:
            items = [(r["item_id"], r["text"]) for r in table(llm_spark, SF, "benchmark").collect()]
            kept = {d for d, _, hit, _ in brute.contamination(rows, items) if not hit}
        assert set(after) == kept, i
        assert i == 1 or all(after[d] == before[d] for d in kept)
    packed = pipe.pack_sequences(llm_spark, docs, SF)
    assert {r["doc_id"] for r in packed.collect()} == set(after)


def test_run_on_extra_columns(llm_spark, tmp_path):
    from pyspark.sql import functions as F
    docs = table(llm_spark, SF, "documents").withColumns({"score": F.lit(1), "set": F.lit(2), "n_lines": F.lit(3)}).limit(60)
    for _, stage in pipe.STAGES[:-1]:
        docs = stage(llm_spark, docs, SF)
        assert docs.columns == [*COLUMNS, "score", "set", "n_lines"]
    assert docs.count() > 0
