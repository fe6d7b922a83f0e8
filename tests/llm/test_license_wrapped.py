"""Licence texts as they stand in files: wrapped lines and comment markers."""

from __future__ import annotations

import textwrap

import pyarrow as pa
import pytest

from ledgerlens.llm import license as licences

WHOLE = {rule: [licences.SENTENCES[n] for n in wanted] for rule, _, wanted in licences.RULES}


def in_file(sentences, marker, end="\n"):
    lines = [line for s in sentences for line in textwrap.wrap(s, 72 - len(marker))]
    return "".join(marker + line + end for line in lines)


@pytest.mark.parametrize("marker", ["", "# ", " * ", "// ", "; "])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_wrapped_licences_are_found(marker, end):
    texts = ["Some words before.\n\n" + in_file(s, marker, end) + "\nand after\n" for s in WHOLE.values()]
    _, found = licences.Scanner().scan(pa.array(texts))
    assert [[(rule, name) for rule, name, _, _ in f] for f in found] == [[(rule, name)] for rule, name, _ in licences.RULES]


def test_one_paragraph_and_numbers_of_its_lines():
    mit = " ".join(WHOLE["mit-text"])
    count, found = licences.Scanner().scan(pa.array([textwrap.fill(mit, 72)]))
    assert found == [[("mit-text", "MIT", 0, count[0] - 1)]] and count[0] > 10


def test_blank_lines_and_punctuation_end_a_run():
    notice = "Released under the\n{}MIT License."
    texts = [notice.format(x) for x in ("", "# ", "\n", "#\n# ", "word\n", "text. ")] + ["Released under the; \nMIT License."]
    _, found = licences.Scanner().scan(pa.array(texts))
    assert [len(f) for f in found] == [1, 1, 0, 0, 0, 0, 0]


def test_texts_do_not_run_into_each_other():
    count, found = licences.Scanner().scan(pa.array(["Released under the\n", "MIT License.", None, "", "\n"]))
    assert count.tolist() == [1, 1, 0, 0, 0] and not any(found)


def test_spdx_lines():
    texts = ["// SPDX-License-Identifier: MIT\nint x;", "/* SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR Apache-2.0 */", "SPDX-License-Identifier", "spdx"]
    _, found = licences.Scanner().scan(pa.array(texts))
    assert [[m[:2] for m in f] for f in found] == [[("spdx", "MIT")], [("spdx", "GPL-2.0-only"), ("spdx", "Apache-2.0")], [], []]


def test_common_licences_have_rules():
    names = {name for _, name, _ in licences.RULES}
    assert names >= {"LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later", "MPL-2.0", "EPL-2.0", "ISC", "Zlib", "BSL-1.0", "Unlicense", "CC0-1.0"}
    # a sentence that the splitter divides could never be found
    assert {n: c for n, c in zip(licences.SENTENCES, licences.Sentences(pa.array(list(licences.SENTENCES.values()))).count.tolist(), strict=True) if c != 1} == {}
