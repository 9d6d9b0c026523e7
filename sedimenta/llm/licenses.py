"""License scans by conditional compression.

Each license cue opens a block, which holds as many words around the cue as a match could span, on its own line and others.
The block is compressed with zstandard alone and with each template as raw dictionary, and templates rank by the bytes
that they save. In this order each is compared with the block word by word, and the first match wins: it
covers the cue, has all numbers, and misses or puts in at most DIFFERENCES of the words. The ranking is never cut: it ends at a
match or with the last template that could still match, which leaves out only those of whose words the block lacks
more than DIFFERENCES, since they cannot. The search goes on right behind a match.

Defined results: a null text is empty and has no license. Null ids pass through, repeated rows give
one row each. Templates that save equally much rank in the order listed. Empty tables give empty results.
Other columns are ignored. Whole texts are scanned; work per cue has a fixed bound.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Callable
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.batches import Made, Texts, map_texts

#: Share of a template's words that may be missing or put in between.
DIFFERENCES = 0.1

# Words that open a candidate block, in lower case.
CUES = (
    "licens", "licenc", "copyright", "rights reserved", "permission is hereby", "permission to use", "redistribution",
    "public domain", "creative commons", "spdx-", "warranty",
)

# License identifiers and public license notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("all-rights-reserved", "All rights reserved."),
    ("MIT", "The MIT License (MIT)"),
    ("Apache-2.0", "Licensed under the Apache License 2.0"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version.",
    ),
    (
        "AGPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
    ),
)
# Identifiers of the public license list that are written on a line of their own.
IDENTIFIERS = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0",
    "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC",
    "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib",
)
TEMPLATES += tuple((name, f"SPDX-License-Identifier: {name}") for name in IDENTIFIERS)

_WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")
_CUE = re.compile("|".join(re.escape(c).replace(r"\ ", "[^a-z0-9]+") for c in CUES))  # a line may end inside a cue


def _worded(text: str) -> list[tuple[str, int, int]]:
    return [(m[0], m.start(), m.end()) for m in _WORD.finditer(text.lower())]


@dataclass(frozen=True)
class Match:
    license: str
    start: int
    end: int
    reduction: float
    differences: int


class _Scanner:
    def __init__(self, templates: tuple[tuple[str, str], ...]) -> None:
        settings = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.templates = [(name, text, [w for w, _, _ in _worded(text)]) for name, text in templates]
        self.alone = zstandard.ZstdCompressor(level=3, **settings)
        self.given = [
            zstandard.ZstdCompressor(
                level=3,
                dict_data=zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                **settings,
            )
            for _, text in templates
        ]
        #: words a match may span
        self.spans = [math.floor(len(wanted) * (1 + DIFFERENCES)) for _, _, wanted in self.templates]

    def matches(self, text: str | None) -> tuple[int, list[Match]]:
        """Cues seen outside of earlier matches, and confirmed matches that do not overlap, from the start."""
        if not text:
            return 0, []
        small = text.lower()
        if len(small) != len(text):  # a letter whose lower case is longer would shift places
            small = "".join(c if len(x := c.lower()) != 1 else x for c in text)
        cues = [m.start() for m in _CUE.finditer(small)]
        if not cues:
            return 0, []
        there = [(m[0], m.start(), m.end()) for m in _WORD.finditer(small)]
        words, ends = [w for w, _, _ in there], [e for _, _, e in there]
        seen, free, last, found = 0, 0, -1, []
        for place in cues:
            cue = bisect_right(ends, place)  # the word that the cue stands in
            if cue < free or cue == last:
                continue
            seen, last = seen + 1, cue
            best = self._best(words, free, cue)
            if best is not None:
                i, start, end, differences = best
                begin, free = there[start][1], end
                wording = small[begin : ends[end - 1]]
                found.append(Match(self.templates[i][0], begin, ends[end - 1], self._reduction(i, wording), differences))
        return seen, found

    def _reduction(self, i: int, wording: str) -> float:
        data = wording.encode("utf-8", "replace")
        return 1 - len(self.given[i].compress(data)) / len(self.alone.compress(data))

    def _best(self, words: list[str], least: int, cue: int) -> tuple[int, int, int, int] | None:
        """Template, first and last word and differences of the match that covers a cue, by the most compressing template."""
        widest = max(self.spans)
        near = set(words[max(least, cue - widest) : cue + widest])
        possible = [
            i for i, (_, _, wanted) in enumerate(self.templates) if sum(w not in near for w in wanted) <= DIFFERENCES * len(wanted)
        ]
        for i in self._ranked(possible, words, least, cue):
            wanted, span = self.templates[i][2], self.spans[i]
            low = max(least, cue - span)
            match = self._confirm(i, words[low : cue + span], cue - low)
            if match is None:  # another copy close by may draw the comparison away
                for low in range(low, cue + 1):
                    if words[low] in wanted and (match := self._confirm(i, words[low : low + span], cue - low)) is not None:
                        break
            if match is not None:
                start, end, differences = match
                return i, low + start, low + end, differences
        return None

    def _ranked(self, templates: list[int], words: list[str], least: int, cue: int) -> list[int]:
        """Templates by the bytes that they save on the block around a cue, the most first."""
        if len(templates) < 2:
            return templates
        reach = max(self.spans[i] for i in templates)
        block = " ".join(words[max(least, cue - reach) : cue + reach]).encode("utf-8", "replace")
        return sorted(templates, key=lambda i: (len(self.given[i].compress(block)), i))

    def _confirm(self, i: int, block: list[str], cue: int) -> tuple[int, int, int] | None:
        """Exact wording: what a stretch of the block leaves out of the template, and what it puts in between."""
        wanted = self.templates[i][2]
        numbers = [w for w in wanted if w[0].isdigit()]
        common = SequenceMatcher(None, wanted, block, autojunk=False).get_matching_blocks()[:-1]
        best = None
        # a word beyond the notice may be common by chance, so any stretch of the common parts may be the notice
        for lo in range(len(common)):
            matched: list[str] = []
            for part in common[lo:]:
                matched += wanted[part.a : part.a + part.size]
                first, last = common[lo].b, part.b + part.size
                missing, added = len(wanted) - len(matched), last - first - len(matched)
                if max(missing, added) > DIFFERENCES * len(wanted) or not first <= cue < last:
                    continue
                if [w for w in matched if w[0].isdigit()] == numbers and (best is None or missing + added < best[2]):
                    best = (first, last, missing + added)
        return best


@lru_cache(maxsize=2)
def scanner(templates: tuple[tuple[str, str], ...] = TEMPLATES) -> _Scanner:
    return _Scanner(templates)


_MATCHES = pa.list_(
    pa.struct(
        [("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("reduction", pa.float64()), ("differences", pa.int32())]
    )
)


def find_licenses(
    docs: DataFrame, key: str = "doc_id", text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES
) -> DataFrame:
    """Per document: ``n_candidates`` and ``matches`` (license, start, end, reduction, differences)."""

    def prepare() -> Callable[[Texts], Made]:
        matches_of = scanner(templates).matches

        def work(texts: Texts) -> Made:
            seen, found = zip(*map(matches_of, texts)) if texts else ((), ())
            return None, [pa.array(seen, pa.int64()), pa.array([[vars(m) for m in ms] for ms in found], _MATCHES)]

        return work

    columns = "n_candidates long, matches array<struct<license:string,start:int,end:int,reduction:double,differences:int>>"
    return map_texts(docs, columns, prepare, key, text)


def license_report(docs: DataFrame) -> DataFrame:
    """Per document: candidates, matches, its licenses, and all matches as one string."""
    found = find_licenses(docs)
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    spans = F.transform(
        "matches",
        lambda m: F.concat_ws(":", m["license"], m["start"].cast("string"), m["end"].cast("string"), m["differences"].cast("string")),
    )
    return found.select(
        "doc_id",
        "n_candidates",
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(names, ",").alias("licenses"),
        F.array_join(spans, ",").alias("spans"),
    )
