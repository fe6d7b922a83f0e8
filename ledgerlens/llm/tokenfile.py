"""Token-ID output: frequency-ranked ids in a byte-aligned variable-length code.

An id is written as its rank by corpus frequency (rank 0 the most frequent), in one to
four bytes.  A control byte holds the byte counts of four ranks (two bits each, the first
in the low bits); control bytes and data bytes are kept apart, so a block is decoded by
looking up all its control bytes in one table.

``write_token_files`` tokenises each text once into a stored table, counts ids, splits
the documents by quantiles of a sample of their keys into files of about equal numbers of
ids in ascending doc_id order, and writes each file as a row of blocks; a block is a byte
string of its own (see ``pack_block``).  Spark's Parquet writer carries the byte strings, since
it reaches every store that the shared folder may be in.  ``read_token_files`` gives the ids back.
"""

from __future__ import annotations

import random
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import textwords as tw
from ledgerlens.llm.storage import shared_folder, stored
from ledgerlens.llm.wordids import word_ids

END_ID = 1
#: Bytes of text encoded at once.
TEXT_SLICE = 12 << 20
#: Ids of a block; a longer document is a block of its own.
BLOCK_IDS = 1 << 18
#: Ids of a file, as long as there are no more than MOST_FILES.
FILE_IDS = 1 << 22
MOST_FILES = 50_000
#: Keys that are drawn for each file to place its boundary.
SAMPLED = 40
#: Keys drawn at most (or four for each file).
MOST_KEYS = 400_000
#: Ids decoded at once.
STEP = 1 << 20

MAGIC = np.frombuffer(b"ranked01", np.int64)[0]


# --- the code ------------------------------------------------------------------
#: Byte counts of the four ranks of a control byte.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


def _slots(counts: np.ndarray) -> np.ndarray:
    """Place of each number among the slots of control bytes when each list begins with one of its own."""
    return np.arange(int(counts.sum())) + np.repeat(np.cumsum((-counts) % 4) - (-counts) % 4, counts)


def encode(ranks: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lists of unsigned 32-bit numbers, one after the other, ``counts`` long: (control bytes,
    data bytes, offsets of the lists in each).  What is left of a list's last control byte is zero."""
    ranks, counts = np.asarray(ranks, np.uint32), np.asarray(counts, np.int64)
    sizes = np.ones(len(ranks), np.uint8)
    most = int(ranks.max(initial=0))
    for limit in (1 << 8, 1 << 16, 1 << 24):
        if most >= limit:
            sizes += ranks >= limit
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    data = np.empty(int(ends[-1]), np.uint8)
    data[ends[:-1]] = ranks & 255
    for k in range(1, int(sizes.max(initial=1))):
        more = np.flatnonzero(sizes > k)
        data[ends[more] + k] = ranks[more] >> (8 * k) & 255
    firsts = np.concatenate([[0], np.cumsum(-(-counts // 4))])
    codes = np.zeros(4 * int(firsts[-1]), np.uint8)
    codes[_slots(counts)] = sizes - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    return control, data, firsts, ends[np.concatenate([[0], np.cumsum(counts)])]


def decode(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of ``encode``: one table look-up for each control byte."""
    counts = np.asarray(counts, np.int64)
    sizes = LENGTHS[control].ravel()
    if (counts % 4).any():
        sizes = sizes[_slots(counts)]
    at = np.cumsum(sizes, dtype=np.int64) - sizes
    out = data[at].astype(np.uint32)
    for k in range(1, int(sizes.max(initial=1))):
        more = np.flatnonzero(sizes > k)
        out[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def decoded_parts(control: np.ndarray, data: np.ndarray, n: int, step: int = STEP) -> Iterator[np.ndarray]:
    """``decode`` of one list, at most ``step`` (a multiple of 4) numbers at a time."""
    at = 0
    for i in range(0, n, step):
        some, m = control[i // 4:(min(n, i + step) + 3) // 4], min(step, n - i)
        size = int(LENGTHS[some].ravel()[:m].sum(dtype=np.int64))
        yield decode(some, data[at:at + size], np.array([m]))
        at += size


# --- a block ---------------------------------------------------------------------
def pack_block(doc_ids: list[int | None], counts: list[int], control: list[bytes], data: list[bytes]) -> bytes:
    """One block: a head of five long integers (magic, documents, control bytes, data bytes,
    crc32 of what follows), doc_ids, a byte for each (0: null), id counts, control bytes, data bytes.
    Each document begins with a control byte of its own."""
    body = b"".join([
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(), bytes(x is not None for x in doc_ids),
        np.array(counts, "<i8").tobytes(), *control, *data])
    head = np.array([MAGIC, len(doc_ids), sum(map(len, control)), sum(map(len, data)), zlib.crc32(body)], "<i8")
    return head.tobytes() + body


def unpack_block(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, id counts, control bytes, data bytes) of a block; a damaged one raises."""
    magic, n, n_control, n_data, crc = np.frombuffer(block, "<i8", 5).tolist()
    if magic != MAGIC or len(block) != 40 + 17 * n + n_control + n_data or zlib.crc32(memoryview(block)[40:]) != crc:
        raise ValueError("not a whole block of ranked ids")
    doc_ids, known = np.frombuffer(block, "<i8", n, 40), np.frombuffer(block, np.uint8, n, 40 + 8 * n)
    counts = np.frombuffer(block, np.uint8, 8 * n, 40 + 9 * n).view("<i8") if n else np.zeros(0, np.int64)
    return ([d if k else None for d, k in zip(doc_ids.tolist(), known.tolist(), strict=True)], counts,
            np.frombuffer(block, np.uint8, n_control, 40 + 17 * n), np.frombuffer(block, np.uint8, n_data, 40 + 17 * n + n_control))


# --- writing ---------------------------------------------------------------------
def id_type(path: str, end_id: int) -> np.dtype:
    return np.dtype("<u2" if max(word_ids(path).size, end_id + 1) <= 1 << 16 else "<u4")


def token_table(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Stored rows (doc_id, tie, salt, n, ids) of ``docs`` (doc_id, text) and, with null
    ``ids``, for each task the counts of the ids it met (``seen``: ids and counts)."""
    narrow = id_type(path, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, draw = word_ids(path), random.Random()
        counts = np.zeros(max(coder.size, end_id + 1), np.int64)
        for batch in tw.small_batches(batches, "text", TEXT_SLICE):
            ids, off = coder.of_texts(batch.column("text"))
            counts += np.bincount(ids, minlength=len(counts))
            counts[end_id] += batch.num_rows
            end = np.array([end_id], narrow).tobytes()
            ids = ids.astype(narrow)
            held = [ids[a:b].tobytes() + end for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("tie"), pa.array([draw.getrandbits(31) for _ in held], pa.int32()),
                 pa.array(np.diff(off) + 1), pa.array(held, pa.binary()), pa.nulls(len(held), pa.binary())],
                ["doc_id", "tie", "salt", "n", "ids", "seen"])
        if counts.any():
            met = np.flatnonzero(counts)
            seen = np.stack([met, counts[met]]).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                 pa.array([seen], pa.binary())], ["doc_id", "tie", "salt", "n", "ids", "seen"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    return stored(rows.mapInArrow(run, "doc_id long, tie long, salt int, n long, ids binary, seen binary"), "token-ids", "zstd")


def ranked_ids(tokens: DataFrame) -> np.ndarray:
    """Ids of the corpus by descending count, then ascending id: at most the vocabulary's, so they fit the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [np.frombuffer(x, "<i8").reshape(2, -1) for x in batch.column("seen").to_pylist()]
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.concatenate(pairs, axis=1)], ["id", "n"])

    seen = tokens.where(F.col("seen").isNotNull()).select("seen").mapInArrow(run, "id long, n long")
    rows = seen.groupBy("id").agg(F.sum("n").alias("n")).collect()
    return np.array([r["id"] for r in sorted(rows, key=lambda r: (-r["n"], r["id"]))], np.uint32)


def _key(doc_id: int | None, tie: int | None, salt: int) -> tuple:
    """Rows in the order of Spark's ascending sort (nulls first)."""
    return (doc_id is not None, doc_id or 0, tie is not None, tie or 0, salt)


def file_boundaries(tokens: DataFrame, n_files: int, sampled: int = SAMPLED) -> list[tuple]:
    """Keys (doc_id, tie, salt) that split the rows into files of about equal numbers of ids:
    quantiles of some ``sampled`` keys for each file, drawn in proportion to their ids.
    The salt splits rows that are equal in all else."""
    total = tokens.agg(F.sum("n")).first()[0] or 0
    if n_files < 2 or not total:
        return []
    # a row of at least a step's ids is always drawn, and counts as often as it holds a step
    step = total / (n_files * min(sampled, max(4, MOST_KEYS // n_files)))
    draw = F.floor(F.col("n") / step + F.pmod(F.xxhash64("doc_id", "tie", "salt"), F.lit(1 << 30)) / (1 << 30)).alias("w")
    rows = tokens.select("doc_id", "tie", "salt", draw).where("w > 0").collect()
    keys = sorted((_key(r["doc_id"], r["tie"], r["salt"]), r["w"]) for r in rows)
    at = np.cumsum([w for _, w in keys])
    places = np.searchsorted(at, at[-1] * np.arange(1, n_files) / n_files) if keys else []
    return sorted({keys[i][0] for i in places})


def write_token_files(docs: DataFrame, path: str, folder: str | None = None, end_id: int = END_ID, block_ids: int = BLOCK_IDS,
                      file_ids: int = FILE_IDS) -> str:
    """Write the ids of all texts of ``docs`` (doc_id, text), each followed by ``end_id``, and
    return the folder: ``ranks`` (rank, id) and ``blocks`` (file, block, start, n_ids, bytes).

    Files and their blocks are in ascending doc_id order (null first; equal doc_ids by a hash of the
    text); ``start`` counts the ids before a block in its file.  Null texts count as empty; repeated
    rows are written as often as they occur; other columns are not read; an empty table gives
    an empty folder."""
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark)}/ledgerlens-llm/token-files-{uuid.uuid4().hex}"
    table = token_table(docs, path, end_id)
    by_rank = ranked_ids(table)
    tokens = table.where(F.col("ids").isNotNull())
    total = tokens.agg(F.sum("n")).first()[0] or 0
    edges = file_boundaries(tokens, min(MOST_FILES, -(-total // file_ids)))
    narrow = id_type(path, end_id)
    rank = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    rank[by_rank] = np.arange(len(by_rank))

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tw.small_batches(batches, "ids"):
            raw, off = tw.text_bytes(batch.column("ids"))
            control, data, a, b = encode(rank[raw.view(narrow)], np.diff(off) // narrow.itemsize)
            control, data, a, b = control.tobytes(), data.tobytes(), a.tolist(), b.tolist()
            keys = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tie", "salt")), strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([bisect_right(edges, _key(*k)) for k in keys], pa.int32()), *(batch.column(c) for c in ("doc_id", "tie", "salt", "n")),
                 pa.array([control[i:j] for i, j in zip(a, a[1:], strict=False)], pa.binary()),
                 pa.array([data[i:j] for i, j in zip(b, b[1:], strict=False)], pa.binary())],
                ["file", "doc_id", "tie", "salt", "n", "control", "data"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, number, start, held, size = None, 0, 0, [], 0

        def block() -> pa.RecordBatch:
            packed = pack_block(*(list(x) for x in zip(*held, strict=True)))
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([number], pa.int32()), pa.array([start], pa.int64()),
                 pa.array([size], pa.int64()), pa.array([packed], pa.binary())], ["file", "block", "start", "n_ids", "bytes"])

        for batch in batches:
            for at, *row in zip(*(batch.column(c).to_pylist() for c in ("file", "doc_id", "n", "control", "data")), strict=True):
                if held and (at != file or size + row[1] > block_ids):
                    yield block()
                    number, start, held, size = number + 1, start + size, [], 0
                if at != file:
                    file, number, start = at, 0, 0
                held.append(row)
                size += row[1]
        if held:
            yield block()

    coded = tokens.select("doc_id", "tie", "salt", "n", "ids").mapInArrow(
        ranked, "file int, doc_id long, tie long, salt int, n long, control binary, data binary")
    dealt = coded.repartitionById(len(edges) + 1, F.col("file")).sortWithinPartitions("file", "doc_id", "tie", "salt")
    dealt.mapInArrow(blocks, "file int, block int, start long, n_ids long, bytes binary").write.option(
        "compression", "zstd").parquet(f"{folder}/blocks")
    spark.createDataFrame(list(enumerate(by_rank.tolist())), "rank int, id long").coalesce(1).write.parquet(f"{folder}/ranks")
    return folder


# --- reading -----------------------------------------------------------------------
def _read(spark: SparkSession, folder: str, schema: str, take) -> DataFrame:
    """``take([parts of ids] of each document)`` for each block; its rows
    get ``file`` and ``start``, the ids before the document in its file."""
    ranks = spark.read.schema("rank int, id long").parquet(f"{folder}/ranks").collect()
    by_rank = np.zeros(len(ranks), np.uint32)
    by_rank[[r["rank"] for r in ranks]] = [r["id"] for r in ranks]

    def documents(counts: np.ndarray, control: np.ndarray, data: np.ndarray) -> list:
        if len(counts) == 1:  # may be long
            return [(by_rank[x] for x in decoded_parts(control, data, int(counts[0])))]
        ids = by_rank[decode(control, data, counts)]
        return [[x] for x in np.split(ids, np.cumsum(counts)[:-1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start, block in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "bytes")), strict=True):
                doc_ids, counts, control, data = unpack_block(block)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file] * len(doc_ids), pa.int32()), pa.array(start + np.cumsum(counts) - counts),
                     pa.array(doc_ids, pa.int64()), pa.array(counts), take(documents(counts, control, data))],
                    ["file", "start", "doc_id", "n_tokens", "found"])

    rows = spark.read.schema("file int, block int, start long, n_ids long, bytes binary").parquet(f"{folder}/blocks")
    return rows.select("file", "start", "bytes").mapInArrow(run, f"file int, start long, doc_id long, n_tokens long, found {schema}")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, start, doc_id, n_tokens, found: the ids) of each document in a folder."""
    return _read(spark, folder, "array<long>", lambda docs: pa.array(
        [np.concatenate(list(parts)).astype(np.int64) for parts in docs], pa.list_(pa.int64())))


def _crc(parts: Iterator[np.ndarray]) -> int:
    crc = 0
    for x in parts:
        crc = zlib.crc32(x.astype("<u4").tobytes(), crc)
    return crc


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in a folder; ``start`` counts the
    ids of all documents before it in all files."""
    sizes = spark.read.schema("file int, n_ids long").parquet(f"{folder}/blocks").groupBy("file").agg(F.sum("n_ids").alias("n"))
    before, totals = 0, []
    for r in sorted(sizes.collect(), key=lambda r: r["file"]):  # one row for each file, MOST_FILES at most
        totals.append((r["file"], before))
        before += r["n"]
    files = spark.createDataFrame(totals, "file int, _before long")
    rows = _read(spark, folder, "long", lambda docs: pa.array([_crc(parts) for parts in docs], pa.int64()))
    return rows.join(F.broadcast(files), "file").select(
        "doc_id", (F.col("start") + F.col("_before")).alias("start"), "n_tokens", F.col("found").alias("ids_crc32"))
