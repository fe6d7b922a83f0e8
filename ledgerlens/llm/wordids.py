"""Token ids of whole texts, with every distinct word encoded once.

A tokenizer whose tokens never reach across ASCII white space gives a text the ids of
its words, one after the other.  ``WordIds`` checks that a tokenizer file is of that kind
(NFC, white space to one space, lower case; runs of letters, single digits and runs of
other characters as units; a suffix on the last token of a unit).  Any other tokenizer
encodes whole texts.  Special tokens in a text are what the plain call makes of them.
"""

from __future__ import annotations

import json
import os
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerlens.llm import textwords as tw

# one thread for each task: Spark shares out the cores
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Units whose ids a worker remembers.
REMEMBERED = 500_000
#: Units encoded in one piece of text.
JOINED = 64
#: A longer text (bytes) is encoded in parts, cut at white space.
PART = 16 << 20

#: Words of letters that lower case and NFC fold one by one, and what may follow them.
SIMPLE = r"\A(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<rest>[.,!?;:]*)\z"

# The normaliser and the pre-tokeniser that let words be encoded alone.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
UNITS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def suits(spec: dict) -> bool:
    """Whether words can be encoded one by one."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
    return ((spec.get("normalizer") or {}).get("normalizers") == NORMALIZERS and len(steps) == 2
            and steps[0].get("pattern") == {"Regex": UNITS} and steps[0].get("invert") is True
            and steps[0].get("behavior") == "Removed" and steps[1].get("type") == "ByteLevel"
            and not steps[1].get("use_regex") and not steps[1].get("add_prefix_space")
            and not spec.get("post_processor") and bool(spec["model"].get("end_of_word_suffix"))
            and not any(set(" \t\n\v\f\r") & set(x["content"]) or x.get("lstrip") or x.get("rstrip") or x.get("normalized")
                        for x in spec.get("added_tokens", [])))


WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True


class Table:
    """Ids of numbered units: unit ``n`` has ``flat[starts[n]:starts[n] + sizes[n]]``."""

    def __init__(self):
        self.names = pa.array([""], pa.large_string())
        self.flat, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def add(self, names: pa.Array, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.names = pa.concat_arrays([self.names, names.cast(pa.large_string())])
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, flat])


class WordIds:
    """``of_texts`` gives the ids of whole texts by the tokenizer in file ``path``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        self.tokenizer = Tokenizer.from_file(path)
        self.size = max(self.tokenizer.get_vocab().values()) + 1
        self.by_word = suits(spec)
        if self.by_word:
            suffix = spec["model"]["end_of_word_suffix"]
            self.ends = np.zeros(self.size, bool)
            self.ends[[n for token, n in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
            # for runs of small letters, on which the normaliser does nothing
            self.letters = Tokenizer.from_file(path)
            self.letters.normalizer = normalizers.Sequence([])
            self.letters.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.table = Table()

    def _each(self, texts: list[str], tokenizer=None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each text) by the plain call."""
        ids = [x.ids for x in (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes

    def _units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for runs of small letters, many in one text: a run ends with a token
        that carries the suffix."""
        words = units.to_pylist()
        flat, _ = self._each([" ".join(words[i:i + JOINED]) for i in range(0, len(words), JOINED)], self.letters)
        last = np.flatnonzero(self.ends[flat])
        if len(last) != len(words):
            return self._each(words)
        return flat, np.diff(np.concatenate([[-1], last]))

    def _numbers(self, names: pa.Array, encode) -> np.ndarray:
        """Number of each name in the table; ``encode`` gives those that it lacks."""
        coded = names.dictionary_encode()
        distinct = coded.dictionary
        at = pc.index_in(distinct, self.table.names)
        new = distinct.filter(pc.is_null(at))
        if len(new):
            known = len(self.table.names)
            self.table.add(new, *encode(new))
            fresh = at.is_null().to_numpy(zero_copy_only=False)
            at = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).astype(np.int64)
            at[fresh] = known + np.arange(len(new))
        else:
            at = at.to_numpy(zero_copy_only=False).astype(np.int64)
        return at[coded.indices.to_numpy()]

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets); null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.by_word:
            ids, sizes = self._each(texts.to_pylist())
            return ids, np.concatenate([[0], np.cumsum(sizes)])
        raw, offsets = tw.text_bytes(texts)
        if len(raw) <= PART:
            return self._of_part(texts)
        parts, owner = _parts(raw, offsets)
        done = [self._of_part(pa.array([raw[a:b].tobytes().decode()], pa.large_string()))[0] for a, b in parts]
        sizes = np.zeros(len(texts), np.int64)
        np.add.at(sizes, owner, [len(x) for x in done])
        return np.concatenate(done), np.concatenate([[0], np.cumsum(sizes)])

    def _of_part(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.table.names) > REMEMBERED:
            self.table = Table()
        split = pc.ascii_split_whitespace(texts)
        word_off = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary
        found = pc.extract_regex(words, SIMPLE)
        simple = found.is_valid().to_numpy(zero_copy_only=False)
        # a simple word is its letters and what follows; any other is one part
        parts = np.zeros((len(words), 2), np.int64)
        if simple.any():
            some = found.filter(pa.array(simple))
            parts[simple, 0] = self._numbers(pc.utf8_lower(some.field("letters")), self._units)
            parts[simple, 1] = self._numbers(some.field("rest"), lambda x: self._each(x.to_pylist()))
        if not simple.all():
            # equal names of both kinds have equal ids
            parts[~simple, 0] = self._numbers(words.filter(pa.array(~simple)), lambda x: self._each(x.to_pylist()))
        sizes = self.table.sizes[parts]
        flat = self.table.flat[tw.ranges(self.table.starts[parts].ravel(), sizes.ravel())]
        sizes = sizes.sum(axis=1)
        starts = np.cumsum(sizes) - sizes
        which = coded.indices.to_numpy()
        ids = flat[tw.ranges(starts[which], sizes[which])]
        at = np.concatenate([[0], np.cumsum(sizes[which])])
        return ids, at[word_off - word_off[0]]


def _parts(raw: np.ndarray, offsets: np.ndarray) -> tuple[list[tuple[int, int]], list[int]]:
    """Byte ranges of at most some ``PART`` bytes, cut before white space, and their texts."""
    ranges, owner = [], []
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        while True:
            end = b
            if b - a > PART:
                spaces = np.flatnonzero(WHITE[raw[a + PART // 2:a + PART]])
                if not len(spaces):  # one long word: up to the next white space
                    spaces = np.flatnonzero(WHITE[raw[a + PART:b]])[:1] + PART // 2
                end = a + PART // 2 + int(spaces[-1]) if len(spaces) else b
            ranges.append((a, end))
            owner.append(i)
            if end == b:
                break
            a = end
    return ranges, owner


_KNOWN: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's ``WordIds`` for a file, kept between tasks."""
    if path not in _KNOWN:
        _KNOWN[path] = WordIds(path)
    return _KNOWN[path]
