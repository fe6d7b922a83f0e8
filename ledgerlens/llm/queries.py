"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.storage import importable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*(columns or ("doc_id", "text")))


# --- 1: sharding -----------------------------------------------------------
from ledgerlens.llm import sharding  # noqa: E402


@register("op1_sharding")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts are neighbours in key order, so they share a shard unless a
    boundary falls among them."""
    docs = documents(spark, sf_dir).select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"), F.xxhash64("text").alias("text_key"))
    placed = sharding.shard_rows(docs, F.col("text_key"), F.col("doc_id"), F.col("size"), n_shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


# --- 10: document fingerprints ---------------------------------------------
from ledgerlens.llm import fingerprint  # noqa: E402


@register("op10_fingerprint")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = fingerprint.with_next(docs.withColumn("vector", fingerprint.vector(F.col("text"))), "doc_id", F.xxhash64("text"),
                                 F.octet_length("text") + 8, ["text", "vector"])
    both = both.withColumn("n_chars", F.length("text").cast("long"))
    edited = both.withColumn("edited", fingerprint.edited_text(F.col("text"), F.col("next_text"), F.col("n_chars")))
    edited = edited.withColumn("edited_vector", fingerprint.vector(F.col("edited")))
    v, e, n = F.col("vector"), F.col("edited_vector"), F.col("next_vector")
    return edited.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint.as_string(v).alias("fingerprint"),
                         fingerprint.as_string(e).alias("edited_fingerprint"),
                         fingerprint.likeness(v, e).alias("near_edited"), fingerprint.likeness(v, n).alias("near_next"))


# --- 7: benchmark decontamination ------------------------------------------
from ledgerlens.llm import decontaminate  # noqa: E402


@register("op7_decontaminate")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
                        F.size("near").cast("long").alias("n_near"), F.sha2(F.concat_ws(",", "near"), 256).alias("near_sha256"))


# --- 6: best-fit packing ------------------------------------------------------
from ledgerlens.llm import packing  # noqa: E402


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(documents(spark, sf_dir), tokenizer_path())


# --- 4: quality classifier -----------------------------------------------------
from ledgerlens.llm import quality  # noqa: E402

ACCEPTED = 0.3


@register("op4_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = documents(spark, sf_dir), quality.remainder("doc_id", 5) == 0
    network = quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return quality.scored(docs, network).select("doc_id", held_out.alias("held_out"), "score",
                                                (F.col("score") >= ACCEPTED).cast("int").alias("predicted"))


# --- 9: language identification -------------------------------------------------
from ledgerlens.llm import langid  # noqa: E402


@register("op9_langid")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = quality.remainder("doc_id", 4) == 2
    raw = langid.dictionaries(documents(spark, sf_dir, "doc_id", "text", "lang"), ~held_out)
    return langid.predicted(documents(spark, sf_dir), raw).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


# --- 2: near-duplicates -----------------------------------------------------------
from ledgerlens.llm import neardup  # noqa: E402


@register("op2_neardup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(documents(spark, sf_dir), k=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


# --- 3: substring de-duplication ------------------------------------------------------
from ledgerlens.llm import substring  # noqa: E402


@register("op3_substring")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.without_repeats(documents(spark, sf_dir))


# --- 8: line de-duplication -----------------------------------------------------------
from ledgerlens.llm import linededup  # noqa: E402


@register("op8_linededup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.without_repeated_lines(documents(spark, sf_dir))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


# --- 5: licence scans ---------------------------------------------------------------------
from ledgerlens.llm import license as licences  # noqa: E402


@register("op5_licenses")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.license_scan(documents(spark, sf_dir))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    places = F.transform("matches", lambda m: F.concat_ws(":", m["rule"], m["first"], m["last"]))
    return found.select("doc_id", "n_sentences", F.size("matches").cast("long").alias("n_matches"),
                        F.concat_ws(",", names).alias("licenses"), F.concat_ws(",", places).alias("rules"))


# --- 11: token-id output --------------------------------------------------------------------
from ledgerlens.llm import tokenfile  # noqa: E402


@register("op11_tokenids")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.token_digests(spark, tokenfile.write_token_files(documents(spark, sf_dir), tokenizer_path()))


# --- 12: Merkle dataset manifest ---------------------------------------------------------------
from ledgerlens.llm import merkle  # noqa: E402


@register("op12_merkle", merkle.manifest_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = documents(spark, sf_dir, *columns)
    found = merkle.verified_manifest(docs, columns, tampered={"text": merkle.tampered_text(F.col("doc_id"), F.col("text"))})
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                        "folded_root", "verified")


# --- 13: cross-tokenizer alignment -----------------------------------------------------------------
from ledgerlens.llm import alignment  # noqa: E402


@register("op13_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned_documents(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
