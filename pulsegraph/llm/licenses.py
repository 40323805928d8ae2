"""License scans by conditional compression.

Candidate blocks are the sentences and lines of a text that hold licensing
vocabulary.  Each block is compressed with every template as zstandard raw
dictionary; templates are ranked by how many bytes they save against no
dictionary at all.  The best few are confirmed by wording: block and template
are aligned word by word, the longest chains of equal words give the matched
part, and the words in between are the differences.  A block is reported for
the confirmed template with the fewest differences, then the largest saving.
Differences that hold a word of ``TELLING`` refute a template.

Templates are notices and grants that anyone meets in public sources; callers
may pass their own.  Texts are scanned whole, as a map over Arrow batches with
nothing shuffled; blocks longer than ``BLOCK_CHARS`` are cut at spaces.

Defined results: null and empty texts have no notices; rows that repeat get a
row each; an empty table gives no rows; a template may be reported many times
in a text; extra columns are ignored, whatever they are called.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegraph.llm.common import fresh

#: fixed wording of public licenses and of the notices that name them
TEMPLATES: dict[str, str] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License. This work is released under the Apache License, Version 2.0."),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. Neither the name of the copyright "
        "holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission. Released under the BSD 3-Clause License. "
        "Licensed under the BSD license."),
    "CC-BY-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License. "
        "Licensed under CC BY 4.0. http://creativecommons.org/licenses/by/4.0/"),
    "CC-BY-NC-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License. "
        "Licensed under CC BY-NC 4.0. http://creativecommons.org/licenses/by-nc/4.0/"),
    "CC-BY-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License. "
        "Licensed under CC BY-SA 4.0. http://creativecommons.org/licenses/by-sa/4.0/"),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
        "to this work. Released under CC0 1.0 Universal. This work is dedicated to the public domain."),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, "
        "or (at your option) any later version. This work is licensed under the GNU General Public License, version 2."),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version. This program is distributed in the hope that it will be useful, "
        "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details. "
        "This work is licensed under the GNU General Public License, version 3."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "Released under the ISC License."),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
        "ANY KIND, EXPRESS OR IMPLIED. Released under the MIT License. Licensed under the MIT License."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/. "
        "Licensed under the Mozilla Public License, version 2.0."),
}

MARKER = re.compile(r"(?i)licen[sc]|copyright|permission|redistribut|warrant|public domain|creative commons|\bCC[ -](?:BY|0)")
#: a block ends at a line end, or after a full stop that white space follows
_BLOCK = re.compile(r"[^\n]+?(?:(?<=[.!?])(?=\s)|(?=\n)|\Z)")
_WORD = re.compile(r"[^\W_]+(?:[.'-][^\W_]+)*")
BLOCK_CHARS = 2000
#: fixed wording that tells licenses of one family apart: where it differs, it is another license
TELLING = re.compile(r"affero|lesser|non-?commercial|share-?alike|noderiv")
LEVEL = 9


@dataclass(frozen=True)
class Limits:
    """When a template is a winner."""

    ranked: int = 4  # templates that are aligned, best savings first
    least_saving: float = 0.3  # share of the block's compressed length
    least_words: int = 3  # words that are equal
    most_differences: float = 0.2  # of the block's words


class Scanner:
    def __init__(self, templates: dict[str, str], limits: Limits = Limits()):
        self.limits = limits
        self.words = {name: _WORD.findall(text.lower()) for name, text in templates.items()}
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False).compress
        self.given = {name: self._with(text) for name, text in templates.items()}

    @staticmethod
    def _with(text: str):
        data = zstandard.ZstdCompressionDict(_padded(text), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False).compress

    def savings(self, block: str) -> list[tuple[float, str]]:
        """Share of the block's compressed length that each template saves, best first."""
        data = _padded(block)
        alone = len(self.plain(data))
        return sorted(((1 - len(f(data)) / alone, name) for name, f in self.given.items()),
                      key=lambda x: (-x[0], x[1]))

    def differences(self, words: list[str], name: str) -> tuple[int, int, str]:
        """Equal words, differing words within the block, and what differs (-template +block)."""
        template = self.words[name]
        equal, diff, out = 0, 0, []
        match = difflib.SequenceMatcher(None, template, words, autojunk=False)
        codes = match.get_opcodes()
        for i, (op, a, b, c, d) in enumerate(codes):
            if op == "equal":
                equal += d - c
                continue
            ends = i in (0, len(codes) - 1)  # the rest of the template is no difference
            left_out = [] if ends or b - a > len(words) else template[a:b]
            diff += max(len(left_out), d - c)
            out += [f"-{w}" for w in left_out] + [f"+{w}" for w in words[c:d]]
        return equal, diff, " ".join(out)

    def best(self, block: str) -> tuple[str, float, int, str] | None:
        words, limits = _WORD.findall(block.lower()), self.limits
        if len(words) < limits.least_words:
            return None
        found = []
        for saving, name in self.savings(block)[:limits.ranked]:
            if saving >= limits.least_saving:
                equal, diff, text = self.differences(words, name)
                if equal >= limits.least_words and not TELLING.search(text) and diff <= limits.most_differences * len(words):
                    found.append((diff, -saving, name, text))
        if not found:
            return None
        diff, saving, name, text = min(found)
        return name, -saving, diff, text

    def scan(self, text: str) -> list[tuple[int, int, str, float, int, str]]:
        """(start, end, license, saving, differing words, differences) of each notice."""
        out = []
        for start, end in blocks(text):
            if won := self.best(text[start:end]):
                out.append((start, end, *won))
        return out


def _padded(text: str) -> bytes:
    # zstandard starts no match in the last eight bytes of its input
    return " ".join(text.split()).encode("utf-8", "replace") + b" " * 8


def blocks(text: str) -> Iterator[tuple[int, int]]:
    """Sentences and lines with licensing vocabulary, without outer white space."""
    done = 0
    for m in MARKER.finditer(text):
        if m.start() < done:
            continue
        line = text.rfind("\n", 0, m.start()) + 1
        stop = text.find("\n", m.start())
        stop = len(text) if stop < 0 else stop
        for s in _BLOCK.finditer(text, max(line, done), stop):
            if s.end() > m.start():
                break
        start, end = s.span()
        done = end
        if end - start > BLOCK_CHARS:  # a long run of words: what stands around the marker
            start = max(start, text.rfind(" ", start, max(start, m.start() - BLOCK_CHARS // 2)) + 1)
            end = min(end, start + BLOCK_CHARS)
            done = max(end, m.end())
        while start < end and text[start].isspace():
            start += 1
        yield start, end


def scan(docs: DataFrame, templates: dict[str, str] | None = None, limits: Limits = Limits(),
         text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``notices``: an array of (start, end, license, saving, n_differences, differences)."""
    n, used = len(keep), TEMPLATES if templates is None else templates
    notice = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("license", pa.string()), ("saving", pa.float64()),
                        ("n_differences", pa.int64()), ("differences", pa.string())])

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(used, limits)
        for batch in stream:
            found = [[dict(zip(("start", "end", "license", "saving", "n_differences", "differences"), x))
                      for x in scanner.scan(t or "")] for t in batch.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n)), pa.array(found, pa.list_(notice))],
                                             names=[*keep, "notices"])

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*[docs[c] for c in keep], docs[text_col].cast("string").alias(fresh(docs, "__text"))).mapInArrow(
        batches, f"{kept}, notices array<struct<start: bigint, end: bigint, license: string, saving: double, "
                 "n_differences: bigint, differences: string>>")


def scan_digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_notices, licenses, spans, differences``: one row per input row."""
    return scan(docs).select(
        "doc_id", F.size("notices").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct("notices.license")), ",").alias("licenses"),
        F.array_join(F.transform("notices", lambda x: F.concat_ws(":", x["license"], x["start"], x["end"])), ",").alias("spans"),
        F.array_join("notices.differences", "|").alias("differences"))
