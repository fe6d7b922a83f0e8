"""A training-corpus pipeline over ``documents``: each stage calls one operator of
``ledgerlens.llm`` and works on all rows that the one before it kept.

Stages but the last return the columns of ``documents`` (``n_chars`` follows the
text).  Null and empty texts go through every stage like any other; a text that
loses all its lines to the line stage goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import decontaminate, linededup, neardup, packing, quality
from ledgerlens.llm.queries import ACCEPTED, table, tokenizer_path
from ledgerlens.llm.storage import importable, stored

#: No SQL: a trained network, MinHash candidates and a packing search are among the stages.
ORACLE_SQL = None


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    importable(spark)
    network = quality.fit(docs, table(spark, sf_dir, "labels"), quality.remainder("doc_id", 5) != 0)
    return quality.scored(docs, network, score="_quality").where(F.col("_quality") >= ACCEPTED).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that match an earlier line."""
    importable(spark)
    out = linededup.without_repeated_lines(docs)
    out = out.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the least doc_id, of each component of near-duplicates."""
    importable(spark)
    return neardup.distinct_documents(docs, k=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten-word window of the benchmark."""
    importable(spark)
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents in sequences of at most 4096."""
    importable(spark)
    return packing.packed_documents(docs, tokenizer_path())


STAGES = [
    ("quality classifier", accept_quality),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage-{i}")
    return docs
