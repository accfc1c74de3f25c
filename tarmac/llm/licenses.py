"""Licenses in texts by conditional compression.

Blocks of a text that speak of licences or rights are the candidates. Each is
compressed by zstandard alone and with each template as raw dictionary; templates are
ranked by how much smaller the block gets. The best ones are confirmed by the exact
differences in wording between the block and the stretch of the template next to it.

A block is a paragraph: lines up to an empty one. A paragraph of several lines is
looked at line by line as well, as notices often stand in other text. Where a block as
a whole bears none, windows of about a template's size around its cues are looked at,
across line ends: of each, the stretch that aligns best with a template is the candidate.

Defined results: a null or empty text has no blocks. Repeated rows are scanned one by
one. Equal reductions go to the template with fewer differences, then by name; equal
stretches to the template that saves more bytes, then by name. Texts are scanned whole. An
empty table gives none; further columns of whatever name are not read.
"""

from __future__ import annotations

import bisect
import difflib
import functools
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The wording of licence notices, and the openings of licence texts.
TEMPLATES = {
    "MIT": """Released under the MIT License. Licensed under the MIT License. This project is licensed under the terms of the MIT license.
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software. SPDX-License-Identifier: MIT""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0. Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the
License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
the specific language governing permissions and limitations under the License. SPDX-License-Identifier: Apache-2.0""",
    "GPL-3.0": """This work is licensed under the GNU General Public License, version 3. Licensed under the GNU General Public License v3.0.
This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published
by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in
the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
PARTICULAR PURPOSE. See the GNU General Public License for more details. SPDX-License-Identifier: GPL-3.0-or-later""",
    "CC-BY-NC-4.0": """Licensed under CC BY-NC 4.0. This work is licensed under the Creative Commons Attribution-NonCommercial 4.0
International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/
SPDX-License-Identifier: CC-BY-NC-4.0""",
    "CC-BY-4.0": """Licensed under CC BY 4.0. This work is licensed under the Creative Commons Attribution 4.0 International License.
To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/ SPDX-License-Identifier: CC-BY-4.0""",
    "CC-BY-SA-4.0": """Licensed under CC BY-SA 4.0. This work is licensed under the Creative Commons Attribution-ShareAlike 4.0
International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/
SPDX-License-Identifier: CC-BY-SA-4.0""",
    "BSD-3-Clause": """Licensed under the BSD 3-Clause License. Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above
copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission. SPDX-License-Identifier: BSD-3-Clause""",
    "AGPL-3.0": """Licensed under the GNU Affero General Public License v3.0. This program is free software: you can redistribute it
and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3
of the License, or (at your option) any later version. SPDX-License-Identifier: AGPL-3.0-or-later""",
    "LGPL-3.0": """Licensed under the GNU Lesser General Public License v3.0. This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the
License, or (at your option) any later version. SPDX-License-Identifier: LGPL-3.0-or-later""",
    "MPL-2.0": """Licensed under the Mozilla Public License 2.0. This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.
SPDX-License-Identifier: MPL-2.0""",
    "ISC": """Released under the ISC License. Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
SPDX-License-Identifier: ISC""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means. SPDX-License-Identifier: Unlicense""",
    "all-rights-reserved": """All rights reserved. Copyright (c) All rights reserved. No part of this publication may be reproduced,
distributed, or transmitted in any form or by any means without the prior written permission of the publisher.""",
}

CUES = r"(?i)licen[cs]|copyright|rights\s+reserved|redistribut|warrant|permission\s+is|creative\s+commons|public\s+domain|SPDX"
#: A template competes from this reduction of the compressed size on.
LEAST_REDUCTION = 0.3
#: A block bears a licence if so much of its wording stands in the template, in order.
LEAST_SAME = 0.7
#: Longer paragraphs and lines are only looked at by windows. A window has at most so many words; the next begins half of it on.
BLOCK_WORDS = 400
#: Words around a cue that its window holds, the length of the longest templates.
REACH = 100
#: A notice has so many words of the template, or is one of its sentences.
LEAST_STRETCH = 5

_CUE = re.compile(CUES)
_WORD = re.compile(r"[\w+/.-]*\w")


Span = tuple[int, int]


def paragraphs(text: str | None) -> Iterator[tuple[Span, list[Span]]]:
    """Place of each paragraph with a cue, and the places of the blocks to judge as a whole."""
    for paragraph in re.finditer(r"[^\n]+(?:\n[^\n]+)*", text or ""):
        if _CUE.search(paragraph[0]):
            at = paragraph.start()
            lines = [(at + m.start(), at + m.end()) for m in re.finditer(r"[^\n]+", paragraph[0])]
            whole = [paragraph.span(), *lines] if len(lines) > 1 else lines
            spans = [(a, b) for a, b in whole if _CUE.search(text, a, b) and len(text[a:b].split()) <= BLOCK_WORDS]
            yield paragraph.span(), spans


def windows(text: str, span: Span, done: list[Span]) -> Iterator[list[Span]]:
    """The places of the words of each window around the cues that lie in no place of ``done``."""
    words = [m.span() for m in _WORD.finditer(text, *span)]
    starts = [a for a, _ in words]
    reaches: list[list[int]] = []
    for cue in _CUE.finditer(text, *span):
        if any(a <= cue.start() < b for a, b in done):
            continue
        k = bisect.bisect_right(starts, cue.start()) - 1
        lo, hi = max(k - REACH, 0), min(k + REACH, len(words))
        if reaches and lo <= reaches[-1][1]:
            reaches[-1][1] = hi
        else:
            reaches.append([lo, hi])
    for lo, hi in reaches:
        for k in range(lo, max(hi - BLOCK_WORDS // 2, lo + 1), BLOCK_WORDS // 2):
            yield words[k : min(k + BLOCK_WORDS, hi)]


def in_one_line(text: str) -> bytes:
    """What is compressed: line ends do not keep a notice from its template."""
    return " ".join(text.split()).encode("utf-8", "replace")


@functools.lru_cache(maxsize=4)
def compressors(templates: tuple[tuple[str, str], ...]) -> tuple:
    """A compressor without dictionary, and one per template."""
    make = lambda **k: zstandard.ZstdCompressor(level=9, write_content_size=False, **k)
    raw = lambda t: zstandard.ZstdCompressionDict(in_one_line(t), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return make(), [(name, _WORD.findall(t.lower()), make(dict_data=raw(t))) for name, t in templates]


def differences(block: list[str], template: list[str]) -> tuple[float, list[str]]:
    """The share of a block's words found in the template in order, and the words left out (-) and put in (+) between them."""
    matcher = difflib.SequenceMatcher(None, template, block, autojunk=False)
    runs = [m for m in matcher.get_matching_blocks() if m.size]
    if not runs:
        return 0.0, [f"+{w}" for w in block]
    lo, hi = runs[0].a, runs[-1].a + runs[-1].size
    out: list[str] = []
    for kind, a, b, c, d in difflib.SequenceMatcher(None, template[lo:hi], block, autojunk=False).get_opcodes():
        if kind != "equal":
            out += [f"-{w}" for w in template[lo + a : lo + b]] + [f"+{w}" for w in block[c:d]]
    return sum(m.size for m in runs) / len(block), out


@functools.lru_cache(maxsize=64)
def sentences(template: str) -> frozenset[tuple[str, ...]]:
    return frozenset(tuple(_WORD.findall(x)) for x in re.split(r"[.:]\s+", template.lower()))


def enough(words: list[str], same: float, template: str) -> bool:
    """Whether so much wording stands for a notice and not for a phrase that notices share."""
    return same >= LEAST_SAME and (same * len(words) >= LEAST_STRETCH - 1e-9 or tuple(words) in sentences(template))


def best_template(block: str, templates: tuple[tuple[str, str], ...]) -> tuple[str, float, float, list[str]] | None:
    """Template, reduction, share of equal wording and differences of the licence a block bears, if any."""
    plain, with_template = compressors(templates)
    data, words = in_one_line(block), _WORD.findall(block.lower())
    if not words:
        return None
    size, wording = len(plain.compress(data)), dict(templates)
    ranked = sorted(((1 - len(c.compress(data)) / size, name, t) for name, t, c in with_template), key=lambda x: (-x[0], x[1]))
    confirmed = []
    for reduction, name, template in ranked:
        if reduction >= LEAST_REDUCTION:
            same, changed = differences(words, template)
            if enough(words, same, wording[name]):
                confirmed.append((-round(reduction, 9), len(changed), name, same, changed))
    if not confirmed:
        return None
    reduction, _, name, same, changed = min(confirmed)
    return name, -reduction, same, changed


def aligned(words: list[str], template: list[str]) -> Span | None:
    """The stretch of ``words`` with the best score: words found in the template in order count for it, others against it."""
    found = [False] * len(words)
    for m in difflib.SequenceMatcher(None, template, words, autojunk=False).get_matching_blocks():
        found[m.b : m.b + m.size] = [True] * m.size
    best, place, score, start = 0.0, None, 0.0, 0
    for k, same in enumerate(found):
        if score <= 0:
            score, start = 0.0, k
        score += 1 - LEAST_SAME if same else -LEAST_SAME
        if score > best + 1e-9:
            best, place = score, (start, k + 1)
    return place


def best_stretches(text: str, places: list[Span], templates: tuple[tuple[str, str], ...]) -> Iterator[tuple]:
    """Place, template, reduction, share and differences of the licences that stretches of a window bear."""
    if not places or not _CUE.search(text, places[0][0], places[-1][1]):
        return
    plain, with_template = compressors(templates)
    words = [text[a:b].lower() for a, b in places]
    wording = dict(templates)
    window = in_one_line(text[places[0][0] : places[-1][1]])
    size = len(plain.compress(window))
    candidates = []
    for name, template, c in with_template:
        if len(c.compress(window)) >= size or not (stretch := aligned(words, template)):
            continue
        lo, hi = stretch
        a, b = places[lo][0], places[hi - 1][1]
        part = in_one_line(text[a:b])
        alone = len(plain.compress(part))
        saved = alone - len(c.compress(part))
        if saved < LEAST_REDUCTION * alone or not _CUE.search(text, a, b):
            continue
        same, changed = differences(words[lo:hi], template)
        if enough(words[lo:hi], same, wording[name]):
            candidates.append((-saved, len(changed), name, saved / alone, same, changed, lo, hi))
    if candidates:
        _, _, name, reduction, same, changed, lo, hi = min(candidates)
        yield from best_stretches(text, places[:lo], templates)
        yield places[lo][0], places[hi - 1][1], name, reduction, same, changed
        yield from best_stretches(text, places[hi:], templates)


def notices(text: str | None, templates: tuple[tuple[str, str], ...]) -> Iterator[tuple]:
    """Place, template, reduction, share of equal wording and differences of each licence in a text."""
    for span, whole in paragraphs(text):
        blocks = [(a, b, *found) for a, b in whole if (found := best_template(text[a:b], templates))]
        stretches: list[tuple] = []
        for places in windows(text, span, [x[:2] for x in blocks if x[:2] == span]):
            for x in best_stretches(text, places, templates):
                covered = [y for y in blocks if y[0] < x[1] and x[0] < y[1]]
                # Of a notice over several lines, a line alone may already look like one.
                if 2 * sum(b - a for a, b, *_ in covered) >= x[1] - x[0] or any(y[0] < x[1] and x[0] < y[1] for y in stretches):
                    continue
                blocks = [y for y in blocks if y not in covered]
                stretches.append(x)
        yield from sorted(blocks + stretches)


def licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row for each block that bears a licence: its place, template, size reduction and differences."""
    fixed = tuple(sorted(templates.items()))
    names = ["doc_id", "start", "end", "template", "reduction", "same_wording", "n_differences", "differences"]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.string())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for a, b, name, reduction, same, changed in notices(t, fixed):
                    out.append((i, a, b, name, reduction, same, len(changed), " ".join(changed)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(types)], names)

    schema = (
        "doc_id bigint, start bigint, end bigint, template string, reduction double, same_wording double, "
        "n_differences bigint, differences string"
    )
    hinted = docs.filter(F.col("text").rlike(CUES)).select(F.col("doc_id").cast("bigint"), "text")
    return hinted.mapInArrow(scan, schema)
