"""Token files, the Merkle manifest and the tokenizer alignment against brute force."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import alignment, merkle, tokenfile, wordids
from ledgerlens.llm.queries import ORACLE, QUERIES, documents, table, tokenizer_path
from tests.llm import brute

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use for columns of their own.
CLASHING = ["lo", "hi", "n", "digest", "kids", "path", "bucket", "_g", "_key", "block", "pair", "total", "ids", "tie", "salt", "file", "start",
            "found", "seen", "control", "n_pairs"]


def odd_texts(n=400, seed=5):
    rng = random.Random(seed)
    letters = [*"aAéÉßçñ .,!'1٣  \t\ń̈ıİſς中ك-_\x01\x0b\x1c\u0085　▁\x00🙂", "<|endoftext|>", "<s>", "<0x41>", "'s", " don't", " x ", "  ", " the", " été", "\r\n"]
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def odd(llm_spark):
    rng = random.Random(8)
    rows = [(i - 100, t, rng.choice(["en", None]), rng.choice(["s", "s", "s", "t", "é", None]), len(t)) for i, t in enumerate(odd_texts())]
    rows += rows[5:9] * 2 + [(None, "null id", None, None, None), (None, "null id", None, None, None), (7, None, None, "", None), (7, "", None, "", 0),
                             (8, "word " * 3000, "en", "one", 15000), (9, "   ", None, "s", 3), (10, " ", None, "s", 1), (11, "é" * 9000, None, None, 9)]
    return llm_spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(llm_spark):
    return llm_spark.createDataFrame([], SCHEMA)


def clashing(docs):
    return docs.select("*", *[F.lit("?").alias(c) for c in CLASHING])


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


# --- 11 ------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def plain_ids():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("counts", [[9], [1, 0, 3, 5], [4, 4, 1], [0, 0, 9], []])
def test_code_round_trip(counts):
    numbers = np.array([0, 255, 256, 65535, 65536, 1 << 24, 2**32 - 1, 5, 70000][:sum(counts)], np.uint32)
    control, data, first, at = tokenfile.encode(numbers, np.array(counts, np.int64))
    assert tokenfile.decode(control, data, np.array(counts, np.int64)).tolist() == numbers.tolist()
    assert len(first) == len(at) == len(counts) + 1 and at[-1] == len(data) and first[-1] == len(control)
    if len(counts) == 1:
        assert [x for p in tokenfile.decoded_parts(control, data, 9, 4) for x in p.tolist()] == numbers.tolist()


def test_word_ids_are_the_plain_calls(plain_ids):
    texts = [*odd_texts(3000, 1), None, ""]
    ids, off = wordids.WordIds(tokenizer_path()).of_texts(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:], strict=False)] == [plain_ids(t or "") for t in texts]


def test_long_texts_are_encoded_in_parts(plain_ids, monkeypatch):
    monkeypatch.setattr(wordids, "PART", 64)
    texts = ["été " * 50, "x" * 300 + " y", "", "a b", "<|endoftext|> " * 20]
    ids, off = wordids.WordIds(tokenizer_path()).of_texts(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:], strict=False)] == [plain_ids(t) for t in texts]


def test_other_tokenizers_encode_whole_texts():
    path = tokenizer_path("byte_bpe_50k.json")
    coder, plain = wordids.WordIds(path), Tokenizer.from_file(path)
    texts = ["Plain English, twice  spaced.\n\n", "é"]
    ids, off = coder.of_texts(pa.array(texts))
    assert not coder.by_word
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:], strict=False)] == [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]


def test_op11(llm_spark, plain_ids):
    want = brute.token_files([tuple(r) for r in documents(llm_spark, SF).collect()], plain_ids)
    assert rows_of(QUERIES["op11_tokenids"](llm_spark, SF), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)


def test_token_files(llm_spark, odd, plain_ids):
    folder = tokenfile.write_token_files(clashing(odd), tokenizer_path(), block_ids=300, file_ids=1500)
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = brute.token_files(docs, plain_ids)
    got = tokenfile.token_digests(llm_spark, folder).orderBy("start").collect()
    assert [(r["doc_id"], r["n_tokens"]) for r in got if r["doc_id"] not in (None, 7)] != []
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(
        (d is not None, d or 0, n, c) for d, _, n, c in want)
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()  # no gap
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    assert llm_spark.read.parquet(f"{folder}/blocks").select("file").distinct().count() > 5
    back = tokenfile.read_token_files(llm_spark, folder).collect()
    assert sorted((repr(r["doc_id"]), r["found"]) for r in back) == sorted((repr(d), [*plain_ids(t or ""), 1]) for d, t in docs)


def test_equal_rows_are_split_over_files(llm_spark):
    docs = llm_spark.range(400).select(F.lit(1).cast("long").alias("doc_id"), F.lit("the same words").alias("text"))
    folder = tokenfile.write_token_files(docs, tokenizer_path(), file_ids=200)
    sizes = [r["n"] for r in llm_spark.read.parquet(f"{folder}/blocks").groupBy("file").agg(F.sum("n_ids").alias("n")).collect()]
    assert sum(sizes) == 1600 and max(sizes) < 600


def test_damaged_blocks_raise():
    block = tokenfile.pack_block([1, None], [2, 0], [b"\x00"], [b"ab"])
    assert tokenfile.unpack_block(block)[0] == [1, None]
    with pytest.raises(ValueError):
        tokenfile.unpack_block(block[:-1] + b"x")


def test_empty_tables(llm_spark, empty):
    assert tokenfile.token_digests(llm_spark, tokenfile.write_token_files(empty, tokenizer_path())).count() == 0
    assert manifest(empty).count() == 0
    assert aligned(empty).count() == 0


# --- 12 ------------------------------------------------------------------------------
def manifest(docs):
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    return merkle.verified_manifest(docs, columns, tampered={"text": merkle.tampered_text(F.col("doc_id"), F.col("text"))}).withColumn(
        "proof_sha256", merkle.proof_digest(F.col("path")))


MERKLE = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_op12(llm_spark):
    docs = table(llm_spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()
    want = sorted(brute.merkle([tuple(r) for r in docs]), key=repr)
    assert rows_of(QUERIES["op12_merkle"](llm_spark, SF), *MERKLE) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert sorted(con.execute(ORACLE["op12_merkle"]).fetchall(), key=repr) == want


def test_manifest_of_odd_rows(odd):
    got = manifest(clashing(odd))
    want = brute.merkle([tuple(r) for r in odd.collect()])
    assert rows_of(got, *MERKLE) == sorted(want, key=repr)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 257])
def test_manifest_heights(llm_spark, n):
    docs = llm_spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("Text "), "id").alias("text"), F.lit(None).cast("string").alias("lang"),
                                     F.when(F.col("id") == 0, None).otherwise(F.lit("one")).alias("source"), F.lit(1).cast("long").alias("n_chars"))
    assert rows_of(manifest(docs), *MERKLE) == sorted(brute.merkle([tuple(r) for r in docs.collect()]), key=repr)


# --- 13 ------------------------------------------------------------------------------
PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def aligned(docs):
    return alignment.aligned_documents(docs, *PATHS)


@pytest.fixture(scope="module")
def plain_alignment():
    import re

    import sentencepiece

    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    letters = alignment.byte_letters()
    bytes_a = {i: bytes(letters[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
    return lambda docs: brute.alignment(docs, lambda t: a.encode(" " + t, add_special_tokens=False).ids, bytes_a, b.encode, bytes_b)


def test_op13(llm_spark, plain_alignment):
    want = plain_alignment([tuple(r) for r in documents(llm_spark, SF).collect()])
    assert rows_of(QUERIES["op13_alignment"](llm_spark, SF), *ALIGNED) == sorted(want, key=repr)


def test_alignment_of_odd_rows(odd, plain_alignment, monkeypatch):
    want = plain_alignment([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert rows_of(aligned(clashing(odd)), *ALIGNED) == sorted(want, key=repr)


def test_long_texts_are_aligned_in_parts(plain_alignment, monkeypatch):
    monkeypatch.setattr(alignment, "TEXT_SLICE", 50)
    text = "Many words, été après été,  and\n more  " * 30
    numbers, shas, _, pairs, times = alignment.Aligner(*PATHS).texts(pa.array([text]))
    want = plain_alignment([(1, text)])[0]
    assert (*numbers[0].tolist(), shas[0]) == (*want[1:5], want[7])
    assert times.sum() == want[4]
