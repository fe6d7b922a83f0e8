"""Likeness of copies with a few words changed, and the lanes it rests on."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from ledgerlens.llm import fingerprint


def phrases(text):
    out = Counter()
    for p in text.split("\n"):
        w = [x for x in p.split(" ") if x]
        out.update(tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2) if w else 0))
    return out


def cosine(a, b):
    a, b = phrases(a), phrases(b)
    return sum(a[k] * b[k] for k in a) / (sum(x * x for x in a.values()) * sum(x * x for x in b.values())) ** 0.5


def test_a_word_put_in_early_leaves_texts_alike(llm_spark):
    text = " ".join(f"w{i}" for i in range(300))
    middle = text.split(" ")
    del middle[40]
    others = {"front": "new " + text, "third": text.replace("w2 ", "w2 new ", 1), "deleted": " ".join(middle), "other": " ".join(f"v{i}" for i in range(300)),
              "half": " ".join(f"w{i}" if i < 150 else f"v{i}" for i in range(300))}
    df = llm_spark.createDataFrame([(k, text, t) for k, t in others.items()], "k string, a string, b string")
    vectors = df.select("k", fingerprint.vector(F.col("a")).alias("a"), fingerprint.vector(F.col("b")).alias("b"))
    got = {r["k"]: r["l"] for r in vectors.select("k", fingerprint.likeness(F.col("a"), F.col("b")).alias("l")).collect()}
    assert all(got[k] > 0.95 for k in ("front", "third", "deleted"))
    assert all(abs(got[k] - cosine(text, t)) < 0.4 for k, t in others.items()) and got["other"] < 0.4 < got["front"] - got["half"] + 0.3


def test_lanes_count_every_phrase(llm_spark):
    texts = ["", " ", "one", "one two", "a b c", "a  b c d\n\ne", "x " * 5000, "\n".join(["p q r s"] * 40), " ".join(f"w{i}" for i in range(1000))]
    df = llm_spark.createDataFrame([(t, p) for t in texts for p in [[list(k) for k, n in phrases(t).items() for _ in range(n)]]], "text string, phrases array<array<string>>")
    word = lambda p, j: F.when(F.get(p, F.lit(j)).isNotNull(), F.xxhash64(F.get(p, F.lit(j))))
    df = df.select("text", fingerprint.vector(F.col("text"))["packed"].alias("v"), F.transform("phrases", lambda p: F.xxhash64(*[word(p, j) for j in range(3)])).alias("h"))
    for r in df.collect():
        hashes = [h & (1 << 64) - 1 for h in r["h"]]
        assert r["v"]["n"] == len(hashes)
        for q in range(4):
            for i in range(8):
                low, high = (sum(h >> (q + 4 * j) & 1 for h in hashes) for j in (i, i + 8))
                assert r["v"][f"p{8 * q + i}"] == low + ((high << 32) if i < 7 else 0), (r["text"][:20], q, i)
