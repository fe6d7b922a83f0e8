"""Operators against brute force: on sf0.001 and on a table of awkward rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import decontaminate, fingerprint, langid, linededup, neardup, packing, quality, sharding, substring, wordids
from ledgerlens.llm import license as licences
from ledgerlens.llm.queries import QUERIES, documents, table, tokenizer_path
from tests.llm import brute

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use for columns of their own.
CLASHING = ["score", "shard", "slot", "vector", "fingerprint", "n_lines", "n_removed", "text_key", "doc", "set", "key", "line", "n",
            "lang_pred", "rejected", "matches", "n_sentences", "size", "bands", "runs", "cuts", "piece", "length"]


def words(rng, n, vocabulary=400):
    return " ".join(f"w{int(vocabulary * rng.random() ** 2)}" for _ in range(n))


def awkward_rows():
    rng = random.Random(4)
    base = words(rng, 120)
    near = base.split()
    near[7] = near[60] = "changed"
    long_text = "\n".join(words(rng, 40, 4000) for _ in range(800))
    texts = [base, base, " ".join(near), "", None, " \t\n \x0b", "one", "one", "a b c d", "A B C D", "x " * 300, "x " * 500, long_text, long_text[:60000],
             "\n\n\n", "é ñ ü 日本語 🙂 ß", base + "\n" + base, "same line here now\nsame line here now\nother", "12345 !!! ???", "w1 w2 w3\n\nw1 w2 w3 w4 w5"]
    rows = [(i, t, "en" if i % 2 else None, "s", len(t or "")) for i, t in enumerate(texts)]
    return rows + [(40 + i, words(rng, rng.randrange(1, 80)), "de", None, None) for i in range(30)] + rows[:1] * 2  # repeated rows


@pytest.fixture(scope="module")
def awkward(llm_spark):
    return llm_spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def clashing(awkward):
    return awkward.select("*", *[F.lit("?").alias(c) for c in CLASHING])


@pytest.fixture(scope="module")
def with_nulls(llm_spark):
    return llm_spark.createDataFrame([(None, "some text of five words", None, None, None), (None, None, None, None, None), (1, None, None, None, None),
                                      (2, "some text of five words", None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def empty(llm_spark):
    return llm_spark.createDataFrame([], SCHEMA)


def pairs(df):
    """{(doc_id, text)} of the table, as the brute-force versions take them."""
    return sorted({(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()}, key=lambda r: r[0])


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def source(llm_spark, which, awkward):
    return documents(llm_spark, SF, "doc_id", "text", "lang", "source", "n_chars") if which == "sf" else awkward


both_tables = pytest.mark.parametrize("which", ["sf", "awkward"])


# --- 1 -----------------------------------------------------------------------
def test_sharding_query_law(llm_spark):
    rows = QUERIES["op1_sharding"](llm_spark, SF).collect()
    docs = dict(pairs(documents(llm_spark, SF)))
    assert len(rows) == len(docs) == len({r["doc_id"] for r in rows})
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    largest = max(r["size"] for r in rows)
    assert set(sizes) <= set(range(24)) and all(abs(s - sum(sizes.values()) / 24) <= largest for s in sizes.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_sharding_divides_a_hot_key(llm_spark):
    rows = llm_spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 31).alias("k"), F.lit(10).alias("bytes"))
    out = sharding.shard_rows(rows, F.col("k"), F.col("id"), F.col("bytes"), n_shards=10, parts=80)
    got = {r["shard"]: r for r in out.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("top"), F.countDistinct("slot").alias("d")).collect()}
    assert len(got) == 10 and all(abs(r["n"] - 900) <= 1 and r["top"] == r["n"] - 1 == r["d"] - 1 for r in got.values())


def test_sharding_awkward(clashing, with_nulls, empty):
    place = lambda df: sharding.shard_rows(df, F.xxhash64("text"), F.col("doc_id"), F.octet_length("text"), n_shards=4)
    out = place(clashing)
    assert out.count() == clashing.count() and Counter(out.columns) == Counter(clashing.columns)
    for df, n in ((with_nulls, 4), (empty, 0)):
        rows = place(df).collect()
        assert len(rows) == n
        for s in {r["shard"] for r in rows}:
            assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    flat = sharding.shard_rows(clashing, F.col("doc_id"), F.col("doc_id"), F.lit(0), n_shards=4).collect()  # no size at all
    assert max(Counter(r["shard"] for r in flat).values()) <= len(flat) // 4 + 1


# --- 2 -----------------------------------------------------------------------
@both_tables
@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_all_pairs(llm_spark, awkward, which, k):
    docs = source(llm_spark, which, awkward)
    got = by_id(neardup.near_duplicates(docs, k=k))
    for doc_id, n, component, kept in brute.components(pairs(docs), k=k):
        assert tuple(got[doc_id])[2:] == (n, component, kept), doc_id


def test_near_duplicates_in_a_large_group(llm_spark):
    """Copies of one text that each differ from it by a little, and from each other by more
    than the threshold allows: only the links through the original hold the group."""
    rng = random.Random(1)
    base = [f"b{i}" for i in range(200)]
    rows = [(i, " ".join(f"z{i}_{j}" if rng.random() < 0.045 else w for j, w in enumerate(base))) for i in range(60)]
    rows.append((1000, " ".join(base)))
    got = by_id(neardup.near_duplicates(llm_spark.createDataFrame(rows, "doc_id bigint, text string"), k=2))
    expected = brute.components(rows, k=2)
    assert [tuple(got[d])[2:] for d, *_ in expected] == [tuple(x) for _, *x in expected]
    assert 1 < len({c for _, _, c, _ in expected}) < 61


def test_near_duplicates_awkward(clashing, with_nulls, empty):
    assert neardup.near_duplicates(empty).count() == 0 and neardup.distinct_documents(empty).count() == 0
    rows = neardup.near_duplicates(with_nulls).collect()
    assert sorted((str(r["doc_id"]), r["component_id"], r["kept"]) for r in rows if r["n_shingles"]) == [("2", 2, True), ("None", 2, False)]
    left = neardup.distinct_documents(clashing)
    assert left.columns == clashing.columns
    assert {r["doc_id"] for r in left.collect()} == {d for d, _, _, kept in brute.components(pairs(clashing), k=5) if kept}


# --- 3 -----------------------------------------------------------------------
@both_tables
def test_substring_equals_all_windows(llm_spark, awkward, which, monkeypatch):
    docs = source(llm_spark, which, awkward)
    expected = {r[0]: r for r in brute.repeats(pairs(docs))}
    for hot in (100_000, 30):  # with 30, most anchors are divided into windows
        monkeypatch.setattr(substring, "HOT_WORDS", hot)
        rows = substring.without_repeats(docs).collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert tuple(r) == expected[r["doc_id"]], r["doc_id"]


def test_substring_awkward(with_nulls, empty, clashing):
    assert substring.without_repeats(empty).count() == 0
    assert Counter(r["n_words"] for r in substring.without_repeats(with_nulls).collect()) == {5: 2, 0: 2}
    assert substring.without_repeats(clashing).count() == clashing.count()


def test_fm_index_counts():
    import numpy as np

    from ledgerlens.llm.fmindex import FMIndex
    rng = np.random.default_rng(2)
    runs = [rng.integers(0, 5, n).astype(np.uint64) for n in (30, 1, 17, 60, 2)]
    index = FMIndex(runs)
    for _ in range(200):
        p = rng.integers(0, 6, rng.integers(1, 6)).astype(np.uint64)
        low, high = np.zeros(1, np.int64), np.full(1, len(index.text))
        code = index.code(p)
        for c in code[::-1]:
            if c < 0:
                high = low
                break
            low, high = index.extend(np.array([c]), low, high)
        there = sum(bool((r[i:i + len(p)] == p).all()) for r in runs for i in range(len(r) - len(p) + 1))
        assert max(0, int(high[0] - low[0])) == there


# --- 4 -----------------------------------------------------------------------
def test_quality_held_out(llm_spark):
    rows = QUERIES["op4_quality"](llm_spark, "/root/testdata/sf0.01").join(table(llm_spark, "/root/testdata/sf0.01", "labels"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.9 * len(held)
    good, bad = [r["score"] for r in held if r["quality"]], [r["score"] for r in held if not r["quality"]]
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad)) > 0.9


def test_quality_chunks_cover_everything_and_batches_do_not_matter():
    import numpy as np
    import pyarrow as pa
    texts = pa.array(["", None, "a" * 128, "b" * 129, "c" * 5000, "d"])
    from ledgerlens.llm.textwords import text_bytes
    raw, off = text_bytes(texts)
    chunks, n = quality.chunks_of(raw, off)
    assert n.tolist() == [1, 1, 1, 2, 52, 1]
    assert set(chunks[chunks > 0].tolist()) == {97, 98, 99, 100}
    net = quality.Network.start()
    one = np.concatenate([net.score(texts.slice(i, 1)) for i in range(len(texts))])
    assert np.allclose(net.score(texts), one, atol=1e-5) and ((one >= 0) & (one <= 1)).all()


def test_quality_awkward(llm_spark, clashing, with_nulls, empty):
    labels = llm_spark.createDataFrame([(0, 1, 0), (9, 0, 0), (None, 1, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")
    net = quality.fit(clashing, labels, F.lit(True))
    for df in (clashing, with_nulls, empty):
        out = quality.scored(df, net)
        assert out.count() == df.count() and Counter(out.columns) == Counter({*df.columns, "score"})
        assert all(0 <= r["score"] <= 1 for r in out.collect())
    nothing = quality.fit(empty, labels.limit(0), F.lit(True))
    assert {r["score"] for r in quality.scored(with_nulls, nothing).collect()} == {0.5}


# --- 5 -----------------------------------------------------------------------
def test_licenses_equal_plain_scan(llm_spark, clashing, with_nulls, empty):
    mit = [licences.SENTENCES[k] for k in ("mit-1", "mit-2", "mit-3", "mit-4")]
    bsd = [licences.SENTENCES[k] for k in ("bsd-1", "bsd-2", "bsd-3")]
    extra = ["\n".join(mit), "Copyright 2020 X. " + "\nFoo bar.\nbaz. ".join(mit), "\na\nb\nc\n".join(mit), bsd[0] + " 1. " + bsd[1] + " 2. " + bsd[2],
             "\n".join([*bsd, licences.SENTENCES["bsd-4"]]), "x.Released under the MIT License.", "Released under the MIT license", mit[0] + mit[1]]
    rows = llm_spark.createDataFrame([(1000 + i, t) for i, t in enumerate(extra)], "doc_id bigint, text string")
    docs = documents(llm_spark, SF).unionByName(rows).unionByName(clashing.select(F.col("doc_id") + 5000, "text").toDF("doc_id", "text"))
    n_found = 0
    for r in licences.license_scan(docs).collect():
        got = r["n_sentences"], [tuple(m) for m in r["matches"]]
        assert got == brute.license_scan(r["text"], licences.SENTENCES, licences.RULES, licences.GAP)
        n_found += len(got[1])
    assert n_found > 5
    assert licences.license_scan(empty).count() == 0 and licences.license_scan(clashing).count() == clashing.count()
    assert [r["n_sentences"] for r in licences.license_scan(with_nulls).orderBy("n_sentences").collect()] == [0, 0, 1, 1]


# --- 6 -----------------------------------------------------------------------
@both_tables
def test_packing_round_trip(llm_spark, awkward, which):
    from tokenizers import Tokenizer
    docs = source(llm_spark, which, awkward)
    coder = Tokenizer.from_file(tokenizer_path())
    rows = packing.packed_documents(docs, tokenizer_path()).collect()
    wanted = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = [*coder.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start:start + 4096]
            wanted[r["doc_id"], piece, start, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == wanted
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= -(-sum(r["length"] for r in rows) // 4096) * 1.03 + 1


def test_packing_search_beats_best_fit():
    import numpy as np
    rng = np.random.default_rng(3)
    better = 0
    for _ in range(20):
        lengths = rng.integers(20, 70, 60)
        packed = packing.pack_group(lengths, 100)
        assert sorted(i for b in packed for i in b) == list(range(60)) and all(lengths[b].sum() <= 100 for b in packed)
        plain = len(packing.best_fit(lengths, 100))
        assert len(packed) <= plain
        better += len(packed) < plain
    assert packing.pack_group(np.zeros(0, np.int64), 100) == []
    # 61 + 61 | 39 39 22: an exchange frees a bin that moves alone do not
    swaps = packing.Swaps([[0, 1], [2, 3], [4]], np.array([50, 30, 49, 31, 20]), 100)
    assert len(swaps.run()) == 2


def test_packing_of_equal_bins_and_special_tokens(llm_spark):
    """Bins of one make-up are tried once; equal rows are dealt to all groups; special tokens' strings as the plain call has them."""
    import numpy as np
    assert len(packing.pack_group(np.full(20_000, 1500), 4096)) == 10_000
    from tokenizers import Tokenizer
    text = "one <|endoftext|> two"
    docs = llm_spark.range(60).select(F.lit(None).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    pieces = packing.stored(packing.token_pieces(docs, tokenizer_path()), "pieces")
    ids = [*Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids, 1]
    assert 49407 in ids and {r["ids_crc32"] for r in pieces.collect()} == {zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))}
    placed = packing.pack(pieces, [F.col(c) for c in ("doc_id", "piece", "ids_crc32", "salt")], group_pieces=10)
    assert placed.count() == 60 and placed.select("sequence_id").distinct().count() <= 6
    assert pieces.select(F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "salt"), F.lit(6))).distinct().count() > 3


def test_packing_several_groups(llm_spark, empty, with_nulls):
    rng = random.Random(2)
    rows = llm_spark.createDataFrame([(i, int(rng.lognormvariate(4, 1)) % 900 + 1) for i in range(3000)], "id bigint, length bigint")
    out = packing.pack(rows, [F.col("id")], capacity=1000, group_pieces=200).collect()
    fill = Counter()
    for r in out:
        fill[r["sequence_id"]] += r["length"]
    assert len(out) == 3000 and max(fill.values()) <= 1000 and len(fill) <= sum(fill.values()) / 1000 * 1.02 + 2
    assert packing.packed_documents(empty, tokenizer_path()).count() == 0
    assert packing.packed_documents(with_nulls, tokenizer_path()).count() == 4


def test_word_ids_of_odd_words():
    import pyarrow as pa
    from tokenizers import Tokenizer
    odd = ["", "  ", "a\x01b \x01", "ΣΑΣ ς Σ", "İstanbul ﬁ Å Å", "x\x85y z　w ́q", "don't we'LL 'S '' 12345", "\x0bA\x0cB\x1cC", "日本語 テキスト🙂👍🏽", None,
           "Word, word. WORD!! wörd; " * 50, "z" * 3000]
    ids, off = wordids.WordIds(tokenizer_path()).of_texts(pa.array(odd))
    plain = Tokenizer.from_file(tokenizer_path())
    assert [ids[off[i]:off[i + 1]].tolist() for i in range(len(odd))] == [plain.encode(t or "", add_special_tokens=False).ids for t in odd]


# --- 7 -----------------------------------------------------------------------
def benchmark_rows(llm_spark):
    rows = [(r["item_id"], r["text"]) for r in table(llm_spark, SF, "benchmark").collect()]
    return rows + [(900, "A B c"), (901, ""), (902, None), (903, "a b c d e f g h i j k"), (None, "some text of five words"), (900, "x x x x x x x x x x x x")]


@both_tables
@pytest.mark.parametrize("block", [1 << 24, 4000])
def test_contamination_equals_plain_search(llm_spark, awkward, which, block):
    docs = source(llm_spark, which, awkward).select("doc_id", "text").unionAll(llm_spark.createDataFrame(
        [(7001, "say a B c, twice: a b c."), (7002, "a b c d e f g h i j k"), (7003, "x " * 30)], "doc_id bigint, text string"))
    tests = benchmark_rows(llm_spark)
    got = decontaminate.contamination(docs, llm_spark.createDataFrame(tests, "item_id bigint, text string"), block_bytes=block)
    rows = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in got.collect())
    assert sum(rows.values()) == docs.count()
    assert set(rows) == {(d, n, h, tuple(i)) for d, n, h, i in brute.contamination(pairs(docs), tests)}


@both_tables
@pytest.mark.parametrize("block", [1 << 24, 4000])
def test_proximity_matches_equal_plain_search(llm_spark, awkward, which, block):
    """Words put in, left out of a longer item, and moved about; words that stand too far apart do not match."""
    tests = benchmark_rows(llm_spark) + [(950, "one two three four five six seven eight nine ten")]
    docs = source(llm_spark, which, awkward).select("doc_id", "text").unionAll(llm_spark.createDataFrame(
        [(8001, "x ten nine y eight seven z six five four one two three end"), (8002, "one two three four five and so on, " + "w " * 9 + "six seven eight nine ten"),
         (8003, "k j i h g f e d c b a"), (8004, "one two three four five")], "doc_id bigint, text string"))
    got = decontaminate.contamination(docs, llm_spark.createDataFrame(tests, "item_id bigint, text string"), block_bytes=block)
    want = brute.nearby(pairs(docs), tests)
    assert {(r["doc_id"], tuple(r["near"])) for r in got.collect()} == {(d, tuple(x)) for d, x in want.items()}
    assert want[8001] == ["950"] and want[8002] == [] and want[8003] == ["903"]


def test_contamination_awkward(llm_spark, clashing, with_nulls, empty):
    tests = llm_spark.createDataFrame(benchmark_rows(llm_spark), "item_id bigint, text string")
    assert decontaminate.contamination(empty, tests).count() == 0
    assert decontaminate.clean_documents(with_nulls, tests).count() == 2
    assert decontaminate.clean_documents(with_nulls, tests.limit(0)).count() == 4
    clean = decontaminate.clean_documents(clashing, tests)
    assert clean.columns == clashing.columns and 8 not in {r["doc_id"] for r in clean.collect()}


def test_proximity():
    import numpy as np
    import pyarrow as pa
    text = "b x a y c z a b c q q q q c b a".split()
    h = {w: decontaminate.tw.words_of(pa.array([w]), decontaminate.tw.ALPHANUMERIC).hash[0] for w in set(text)}
    vocabulary = np.sort(np.array([h[w] for w in "abc"], np.uint64))
    s = decontaminate.build_segment(pa.array([1]), pa.array([1]), pa.array([" ".join(text)]), vocabulary, 10)
    lists = decontaminate.Postings(s["terms"], s["counts"], s["steps"])
    found = lists.proximity(np.array([h[w] for w in "abc"]), 5)
    held = [(i, j) for i in range(len(text)) for j in range(i + 1, min(i + 5, len(text)) + 1) if {"a", "b", "c"} <= set(text[i:j])]
    assert found == sorted((i, j) for i, j in held if not any((a, b) != (i, j) and i <= a and b <= j for a, b in held))


# --- 8 -----------------------------------------------------------------------
@both_tables
def test_line_dedup_equals_all_pairs(llm_spark, awkward, which, monkeypatch):
    docs = source(llm_spark, which, awkward)
    expected = {r[0]: r for r in brute.line_dedup(pairs(docs))}
    # with small limits, lists are divided and few candidates are tried at first
    for earliest, long_list in ((8, 20_000), (1, 5)):
        monkeypatch.setattr(linededup, "EARLIEST", earliest)
        monkeypatch.setattr(linededup, "LONG_LIST", long_list)
        monkeypatch.setattr(linededup, "PARTNERS", earliest + 2)
        rows = linededup.without_repeated_lines(docs).collect()
        assert len(rows) == docs.count()
        for r in rows:
            kept = hashlib.sha256((r["text"] or "").encode()).hexdigest()
            assert (r["doc_id"], r["n_lines"], r["n_removed"], kept) == expected[r["doc_id"]], r["doc_id"]


def test_line_dedup_in_any_file_order(llm_spark):
    """The first of some equal lines may come last in its file."""
    rng = random.Random(6)
    base = [words(rng, 25, 3000).split() for _ in range(12)]
    rows = []
    for i in range(240):
        w = list(rng.choice(base))
        if rng.random() < 0.5:
            w[rng.randrange(25)] = f"v{rng.randrange(4)}"
        rows.append((i, " ".join(w)))
    docs = llm_spark.createDataFrame(sorted(rows, reverse=True), "doc_id bigint, text string").coalesce(2)
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in linededup.without_repeated_lines(docs).collect()}
    assert got == {d: (n, gone) for d, n, gone, _ in brute.line_dedup(rows)} and 0 < sum(g for _, g in got.values()) < 240


def test_line_dedup_awkward(clashing, with_nulls, empty):
    assert linededup.without_repeated_lines(empty).count() == 0
    out = linededup.without_repeated_lines(clashing)
    assert Counter(out.columns) == Counter(clashing.columns)
    rows = linededup.without_repeated_lines(with_nulls).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in rows if r["n_lines"]) == [("2", "some text of five words"), ("None", "")]


# --- 9 -----------------------------------------------------------------------
def test_langid_held_out(llm_spark):
    rows = QUERIES["op9_langid"](llm_spark, "/root/testdata/sf0.01").join(documents(llm_spark, "/root/testdata/sf0.01", "doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)


def test_langid_awkward(clashing, with_nulls, empty):
    raw = langid.dictionaries(clashing, F.lit(True))
    assert set(raw) == {"en", "de"} and langid.dictionaries(empty, F.lit(True)) == {}
    out = langid.predicted(clashing, raw)
    assert Counter(out.columns) == Counter(clashing.columns)
    for r in out.collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] in raw) if letters else (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert {r["lang_pred"] for r in langid.predicted(with_nulls, {}).collect()} == {"und"}
    assert langid.predicted(empty, raw).count() == 0


# --- 10 ------------------------------------------------------------------------
@both_tables
def test_fingerprint_query_columns(llm_spark, awkward, which, tmp_path):
    sf = SF
    if which == "awkward":  # without the repeated rows: the next document is then another one
        sf = str(tmp_path)
        awkward.dropDuplicates(["doc_id"]).write.parquet(f"{sf}/documents.parquet")
    got = by_id(QUERIES["op10_fingerprint"](llm_spark, sf))
    rows = pairs(documents(llm_spark, sf))[::-1]
    seen = {}
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        k = len(text) // 3
        edited = text[:len(text) - k] + following[:k]
        r = got[doc_id]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert seen.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert (edited != text) or (r["near_edited"] == 1 and r["edited_fingerprint"] == r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if following == text:
            assert r["near_next"] == 1
    if which == "sf":
        assert len(set(seen.values())) == len(seen)
        assert sum(r["near_edited"] > r["near_next"] for r in got.values()) > 0.95 * len(got)


def test_fingerprint_is_homomorphic(llm_spark):
    v = fingerprint.vector
    df = llm_spark.createDataFrame([("a b c\nd e f g", "x y\nz " * 40, "d e f g\na b c")], "a string, b string, c string")
    r = df.select(v(F.col("a")).alias("a"), v(F.col("b")).alias("b"), v(F.col("c")).alias("c"), v(F.concat_ws("\n", "a", "b")).alias("ab"),
                  v(F.concat_ws("\n", "b", "a")).alias("ba"))
    a, b, ba = F.col("a"), F.col("b"), F.col("ba")
    r = r.select("*", fingerprint.insert(a, b).alias("added"), fingerprint.delete(ba, b).alias("removed")).first()
    assert r["ab"] == r["added"] == r["ba"] and r["removed"] == r["a"] == r["c"] != r["b"]


def test_fingerprint_awkward(clashing, with_nulls, empty):
    for df in (clashing, with_nulls, empty):
        out = fingerprint.with_next(fingerprint.fingerprints(df), "doc_id", F.xxhash64("text"), F.octet_length(F.coalesce("text", F.lit(""))) + 8, ["fingerprint"])
        assert out.count() == df.count()
    last = fingerprint.with_next(with_nulls, "doc_id", F.xxhash64("text"), F.lit(8), ["doc_id"]).where("doc_id = 2").first()
    assert last["next_doc_id"] == 1


def test_native_plans_have_no_python(llm_spark):
    for name in ("op1_sharding", "op10_fingerprint"):
        plan = QUERIES[name](llm_spark, SF)._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# --- 8: long texts and many texts without doc_id --------------------------------
def test_line_dedup_of_very_many_lines(llm_spark):
    """Lines beyond any narrow line number: the last two of 2**22 + 2 keep their words."""
    lines = [""] * ((1 << 22) + 2)
    lines[0], lines[1] = "first line has these six words", "second line is of other words"
    lines[-2], lines[-1] = "alpha beta gamma delta epsilon zeta", "first line has these six words"
    lines[70000] = "somewhere in the middle stands this line"
    docs = llm_spark.createDataFrame([(1, "\n".join(lines)), (2, "alpha beta gamma delta epsilon zeta\nsomewhere in the middle stands this line\nown"),
                                      (3, "second line is of other words")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in linededup.without_repeated_lines(docs).collect()}
    assert {d: (r["n_lines"], r["n_removed"]) for d, r in got.items()} == {1: ((1 << 22) + 2, 1), 2: (3, 2), 3: (1, 1)}
    assert got[2]["text"] == "own" and got[1]["text"].endswith("zeta") and got[1]["text"].startswith(lines[0])


def test_line_dedup_of_many_texts_without_doc_id(llm_spark):
    rng = random.Random(12)
    texts = [f"own line number {i} of this text {rng.random()}\n" + ("a line that all of these texts share here" if i % 2 else f"another one {i * 7919} alone {i} here") for i in range(3000)]
    docs = llm_spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    rows = linededup.without_repeated_lines(docs).collect()
    assert sum(r["n_removed"] for r in rows) == 1499 and all(r["n_removed"] == 0 for r in rows if "share" not in r["text"] and r["n_lines"] == 2 and "\n" in r["text"])


def test_line_sets_split_words_as_python_does(llm_spark):
    levels = linededup.rarity(documents(llm_spark, SF))
    import pyarrow as pa
    lines = ["a b a B", "", "  ", "é ñ\x0bx", "one two three four five six"]
    got = linededup.Lines(pa.array(lines, pa.large_string()), levels)
    assert got.size.tolist() == [2, 0, 0, 3, 6]
    assert len(set(got.set[[0, 3, 4]].tolist())) == 3


def test_very_many_boundaries(llm_spark):
    """65,536 boundaries are one literal: built and used in seconds."""
    import time
    bounds = [(i * 1000 - (1 << 62), i % 7 - 3) for i in range(65_536)]
    rows = llm_spark.range(2000).select((F.col("id") * 32_768 - (1 << 62)).alias("key"), F.lit(0).cast("long").alias("tie"))
    began = time.time()
    got = rows.select("key", sharding.range_of(bounds, F.col("key"), F.col("tie")).alias("r"), sharding.lookup(list(range(65_536)), F.lit(9)).alias("l")).collect()
    assert time.time() - began < 30
    from bisect import bisect_right
    assert all(r["r"] == bisect_right(bounds, (r["key"], 0)) and r["l"] == 9 for r in got)
