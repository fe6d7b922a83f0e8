"""Language identification by compression.

Each language has a zstandard raw-content dictionary made of a bounded sample of
its texts.  A text, in lower case, is encoded, in blocks, once with each dictionary; the language
whose dictionary gives the fewest bytes is the prediction.  When the best two are
close, the prediction is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from ledgerlens.llm import textwords as tw

DICTIONARY_BYTES = 100 << 10
#: A dictionary is made of at most so many texts, and of so many bytes of each.
SAMPLE_TEXTS, SAMPLE_BYTES = 200, 2 << 10
#: Texts are encoded in blocks, so that the dictionary counts in long texts too.
BLOCK_BYTES = 8 << 10
LEVEL = 9
#: Below this share of bytes saved against the second-best, a prediction is rejected.
NARROW = 0.01
#: The share saved at which the score is about 0.63.
SCALE = 0.02
LETTER = regex.compile(r"\p{L}")
MAX_LANGUAGES = 500
UNKNOWN = "und"


def dictionaries(docs: DataFrame, training: Column) -> dict[str, bytes]:
    """{language: dictionary}, most frequent language first, from the rows where
    ``training`` (a condition on doc_id) holds and text and lang are not null: the first
    texts in the order of a hash."""
    known = docs.where(training & F.col("lang").isNotNull() & (F.length("text") > 0)).select(
        "lang", F.xxhash64("doc_id", F.lit(23)).alias("_h"), F.substring("text", 1, SAMPLE_BYTES).alias("text"))
    order = Window.partitionBy("lang").orderBy("_h", "text")
    rows = known.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= SAMPLE_TEXTS).orderBy("lang", "_n").limit(
        MAX_LANGUAGES * SAMPLE_TEXTS + 1).collect()  # bounded by its parameters
    if len({r["lang"] for r in rows}) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    out: dict[str, bytes] = {r["lang"]: b"" for r in counts}
    for r in rows:
        if len(out[r["lang"]]) < DICTIONARY_BYTES:
            out[r["lang"]] += r["text"].lower().encode()[:SAMPLE_BYTES] + b"\n"
    return out


class Coder:
    """Encoders of all languages in one worker."""

    def __init__(self, raw: dict[str, bytes]):
        import zstandard

        self.names = list(raw)
        self.encoders = []
        for name in self.names:
            d = zstandard.ZstdCompressionDict(raw[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.encoders.append(zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False))

    def sizes(self, text: bytes) -> np.ndarray:
        blocks = [text[i:i + BLOCK_BYTES] for i in range(0, len(text), BLOCK_BYTES)] or [b""]
        return np.array([sum(len(e.compress(b)) for b in blocks) for e in self.encoders], np.int64)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected); ties go to the more frequent language."""
        if text is None or not self.names or not LETTER.search(text):
            return UNKNOWN, 0.0, True
        if len(self.names) == 1:
            return self.names[0], 1.0, False
        sizes = self.sizes(text.lower().encode())
        best, second = np.partition(sizes, 1)[:2]
        saved = float(second - best) / float(second)
        return self.names[int(sizes.argmin())], 1.0 - float(np.exp(-saved / SCALE)), saved < NARROW


def predicted(docs: DataFrame, raw: dict[str, bytes], text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``rejected``.

    Null texts and texts without a letter are ``und`` with score 0; so is every text when
    nothing was learned.  Rows and other columns stay; columns of those names are replaced."""
    keep = docs.drop("lang_pred", "score", "rejected")
    sent = docs.sparkSession.sparkContext.broadcast(raw)
    schema = StructType([*keep.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                         StructField("rejected", BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(sent.value)
        for batch in tw.small_batches(batches, text):
            lang, score, rejected = zip(*map(coder.predict, batch.column(text).to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                [*batch.schema.names, "lang_pred", "score", "rejected"])

    return keep.mapInArrow(run, schema)
