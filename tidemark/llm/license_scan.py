"""License notices in texts, found by conditional compression.

A block of lines that speaks of licenses is compressed by itself and with each known notice
as a raw dictionary; notices are ranked by the share that they save. Those that save something
are then sought word by word. The place where a notice agrees best is compared with it, and the
notice is confirmed if its wording agrees there, if all its numbers and telling words are there,
and no word that tells another license or none that is known. Every confirmed notice of a block
is returned; of two that claim the same words the one that explains more of them is.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import pick

# SPDX identifiers and the wording of public license notices.
_BSD_OPENING = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met: 1. Redistributions of source code "
    "must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. "
)
_BSD_ENDORSEMENT = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written "
    "permission. "
)
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS "
    "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND "
    "ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED "
    "OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": ("Licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("Licensed under the GNU Affero General Public License, version 3.",),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
        "a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        _BSD_OPENING + _BSD_ENDORSEMENT + _BSD_DISCLAIMER,
    ),
    "BSD-2-Clause": (
        "Licensed under the BSD 2-Clause License.",
        _BSD_OPENING + _BSD_DISCLAIMER,
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.",),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.",),
    "CC0-1.0": ("Dedicated to the public domain under CC0 1.0.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}
#: Lower-case words, one of which a block must contain.
TRIGGERS = ("licen", "copyright", "redistribut", "permission is", "permission to", "public domain")

#: Words of short notices that tell no license.
GENERIC = frozenset(
    "a all an and are code conditions dedicated distributed file following in is it its library "
    "licence licenced license licensed licenses made of on open program project released software "
    "source subject terms the these this to under v version with work you".split()
)
#: Notices of up to so many words name their license; in them every telling word counts.
SHORT = 16
#: Share of the compressed size from which a notice is looked for.
SAVES = 0.01
#: Share of a line's words that notices use, from which it continues a block.
CONTINUES = 0.7
#: Agreement of wording (2 x common words / all words) from which a notice is confirmed.
CONFIRMED = 0.8
LEVEL = 19

SCHEMA = (
    "first_line int, last_line int, license string, best_guess string, reduction double, "
    "agreement double, exact boolean, missing string, added string"
)


def words_of(text: str) -> list[str]:
    """Words and numbers, lower-cased; a version such as 2.0 is one word."""
    return re.findall(r"[^\W_]+(?:\.[0-9]+)*", text.lower())


class Notice:
    """A template as words and as a dictionary."""

    def __init__(self, license: str, text: str):
        import zstandard

        raw = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.license, self.words = license, words_of(text)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=raw)
        self.short = len(self.words) <= SHORT
        self.telling = {word for word in self.words if word not in GENERIC} if self.short else set()


class Match:
    """Where a notice agrees best with words, and how they differ."""

    def __init__(self, notice: Notice, words: list[str | None]):
        self.notice = notice
        wanted, size = notice.words, len(notice.words)
        most = SequenceMatcher(None, wanted, words, autojunk=False).find_longest_match()
        slack = max(3, size // 4)
        low = max(0, most.b - most.a - slack)
        high = most.b - most.a + size + slack
        window = words[low:high]
        blocks = [
            block for block in SequenceMatcher(None, wanted, window, autojunk=False).get_matching_blocks() if block.size
        ]
        # A lone word far from the rest belongs to the text around.
        while len(blocks) > 1 and blocks[0].size == 1 and blocks[1].b - blocks[0].b > 2 + blocks[1].a - blocks[0].a:
            blocks.pop(0)
        while len(blocks) > 1 and blocks[-1].size == 1 and (
            blocks[-1].b - blocks[-2].b > 2 + blocks[-1].a - blocks[-2].a
        ):
            blocks.pop()
        self.matched = sum(block.size for block in blocks)
        self.start = low + blocks[0].b if blocks else 0
        self.stop = low + blocks[-1].b + blocks[-1].size if blocks else 0
        in_notice = {place for block in blocks for place in range(block.a, block.a + block.size)}
        in_words = {low + place for block in blocks for place in range(block.b, block.b + block.size)}
        self.missing = [word for place, word in enumerate(wanted) if place not in in_notice]
        self.added = [words[place] or "" for place in range(self.start, self.stop) if place not in in_words]
        lost = size - blocks[-1].a - blocks[-1].size if blocks else 0
        self.instead = [word or "" for word in words[self.stop : self.stop + lost]]
        self.agreement = 2 * self.matched / (size + self.stop - self.start) if blocks else 0.0

    @property
    def exact(self) -> bool:
        return not self.missing and not self.added

    def confirmed(self) -> bool:
        if self.agreement < CONFIRMED or any(word[0].isdigit() for word in self.missing):
            return False
        if not self.notice.short:
            return "" not in self.added
        return not self.notice.telling.intersection(self.missing) and all(word in GENERIC for word in self.added)

    def differences(self) -> tuple:
        return self.agreement, self.exact, " ".join(self.missing), " ".join(self.added)

    def guessed_differences(self) -> tuple:
        """With the words that stand where the notice's last ones are missing."""
        return self.agreement, self.exact, " ".join(self.missing), " ".join([*self.added, *self.instead])


class Notices:
    """The templates as dictionaries and words."""

    def __init__(self, templates: Mapping[str, Iterable[str]]):
        import zstandard

        self.plain = zstandard.ZstdCompressor(level=LEVEL)
        self.entries = [
            Notice(license, text) for license, texts in sorted(templates.items()) for text in texts
        ]
        self.vocabulary = {word for notice in self.entries for word in notice.words}

    def blocks(self, text: str) -> Iterator[tuple[int, int, str]]:
        """First and last line (from 0) and text of the runs of lines in the notices' words
        that hold a trigger."""
        lines = text.split("\n")
        run: list[int] = []
        for number, line in enumerate([*lines, ""]):
            lower = line.lower()
            starts = any(trigger in lower for trigger in TRIGGERS)
            words = words_of(line)
            known = sum(word in self.vocabulary for word in words)
            # A line of a word or two only goes on with a block.
            enough = 1 if run else 3
            if starts or (len(words) >= enough and known >= CONTINUES * len(words)):
                run.append(number)
                continue
            block = "\n".join(lines[run[0] : run[-1] + 1]) if run else ""
            if run and any(trigger in block.lower() for trigger in TRIGGERS):
                yield run[0], run[-1], block
            run = []

    def ranked(self, block: str) -> list[tuple[float, Notice]]:
        """The share of its compressed size that each notice saves a block, the most first."""
        raw = block.encode("utf-8", "surrogatepass")
        alone = len(self.plain.compress(raw))
        saved = [
            ((alone - len(notice.compressor.compress(raw))) / alone, notice) for notice in self.entries
        ]
        return sorted(saved, key=lambda entry: -entry[0])

    def findings(self, block: str) -> list[tuple]:
        """``first line, last line`` within the block and ``judge``'s values, for every confirmed
        notice in order, or else for the block with the best guess."""
        lines = [words_of(line) for line in block.split("\n")]
        line_of = [number for number, own in enumerate(lines) for _ in own]
        words: list[str | None] = [word for own in lines for word in own]
        ranked = self.ranked(block)
        found: list[tuple] = []
        while True:
            matches = [
                (saved, match)
                for saved, notice in ranked
                if saved >= SAVES and (match := Match(notice, words)).confirmed()
            ]
            if not matches:
                break
            # What explains most words, less those that differ; of equals the higher rank.
            saved, best = max(
                matches,
                key=lambda entry: entry[1].matched - len(entry[1].missing) - len(entry[1].added),
            )
            license = best.notice.license
            found.append(
                (line_of[best.start], line_of[best.stop - 1], license, ranked[0][1].license, saved, *best.differences())
            )
            words[best.start : best.stop] = [None] * (best.stop - best.start)
        if found:
            return sorted(found, key=lambda one: one[:2])
        saved, guess = ranked[0]
        return [(0, len(lines) - 1, None, guess.license, saved, *Match(guess, words).guessed_differences())]

    def judge(self, block: str) -> tuple:
        """License (None if no wording agrees), best guess by compression, the reduction, and
        agreement and differences of the confirmed or else the guessed notice."""
        return self.findings(block)[0][2:]


def _scanning(templates: Mapping[str, tuple[str, ...]]):
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        notices = Notices(templates)
        known: dict[str, list[tuple]] = {}
        for batch in batches:
            rows = []
            for place, text in enumerate(batch.column("text")):
                for first, _, block in notices.blocks(text.as_py()):
                    if block not in known:
                        if len(known) > 10_000:
                            known.clear()
                        known[block] = notices.findings(block)
                    for begin, end, *judged in known[block]:
                        rows.append((place, first + begin, first + end, *judged))
            if rows:
                place, *columns = zip(*rows)
                kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.float64(),
                         pa.float64(), pa.bool_(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(place)),
                     *[pa.array(values, kind) for values, kind in zip(columns, kinds)]],
                    ["doc_id", *[part.split()[0] for part in SCHEMA.split(", ")]],
                )

    return scan


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, tuple[str, ...]] = TEMPLATES,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """A row per confirmed notice, or per block without one: ``doc_id, first_line, last_line,
    license, best_guess, reduction, agreement, exact, missing, added``.

    A block is a run of lines in the notices' words that holds a trigger word. Notices are
    sought in it if their dictionary saves some of its compressed size. ``license`` is one whose
    wording agrees: 0.8 of the words, every number, and in a short notice every word that tells
    its license, with nothing added but words that tell none. ``best_guess`` saves most of all.
    Without a confirmed notice ``license`` is null, and the lines are the block's and the
    differences the guess's. Null, empty and other texts without a trigger word have no rows;
    repeated rows have repeated results; an empty table gives an empty one. A very long text
    is read line by line, so that its blocks alone are compared. Further columns are ignored,
    whatever they are called. Nothing is shuffled.
    """
    rows = pick(docs, id_column, text_column).toDF("doc_id", "text")
    lower = F.lower("text")
    some = lower.contains(TRIGGERS[0])
    for trigger in TRIGGERS[1:]:
        some = some | lower.contains(trigger)
    kind = dict(rows.dtypes)["doc_id"]
    return rows.filter(some).mapInArrow(_scanning(templates), f"doc_id {kind}, {SCHEMA}")
