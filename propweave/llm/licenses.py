"""Licence scans by conditional compression (operator 10).

Blocks are runs of lines around a line with a word of licensing.  Each block is compressed by
zstandard alone and with each licence template as a raw dictionary; the templates are ranked by how much
smaller that makes the block, its lines with triggers, or the surroundings of a trigger: in a long line a
notice saves little of the whole.  They are confirmed by the exact differences in wording: the words of the
template, aligned with the block's, must be there but for a few, and the words that tell versions apart must
all be there.  Words put in between may not name another licence or deny it, nor may the words before in the
sentence deny it.  Where templates of several licences are confirmed on the same words, the one with the most words
counts, then the one that saves most.  Only templates without their telling words are left out before.

Defined results: one row for each licence confirmed in a document, with its best block; null and empty
texts, and blocks that no template fits, give none; very long lines and texts are searched whole, in pieces; equal
ranks go by the licence's name, then the first place; repeated rows give repeated findings; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import difflib
import functools
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propweave.llm import common

#: Wordings of public licences as their publishers (OSI, SPDX, FSF, Apache, Mozilla, Creative Commons)
#: give them: (licence, text, words that must match).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache 2.0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0', "apache 2.0"),
    ("MIT", "Released under the MIT License.", "mit"),
    ("MIT", "Licensed under the MIT License.", "mit"),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction', "permission granted free charge"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", "gnu general public 3"),
    ("GPL-3.0", "Licensed under the GNU General Public License v3.0.", "gnu general public v3.0"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gnu general public 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", "gnu general public 2"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "gnu general public 2"),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1.", "gnu lesser 2.1"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3.", "gnu affero 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla 2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "redistribution source binary conditions"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License.", "bsd 3-clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0.", "cc by 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "creative commons attribution 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", "cc by-sa 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", "cc by-nc 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "creative commons attribution-noncommercial 4.0"),
    ("CC0-1.0", "Released into the public domain under CC0 1.0.", "cc0 1.0"),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.', "permission granted free charge sublicense"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.', "apache 2.0"),
    ("Apache-2.0", "Distributed under the terms of the Apache License, Version 2.0.", "apache 2.0"),
    ("MIT", "Distributed under the terms of the MIT License.", "mit"),
    ("MPL-2.0", "Distributed under the terms of the Mozilla Public License, version 2.0.", "mozilla 2.0"),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0.", "mozilla 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", "mozilla 2.0"),
    ("GPL-3.0", "Distributed under the terms of the GNU General Public License, version 3.", "gnu general public 3"),
    ("GPL-2.0", "Distributed under the terms of the GNU General Public License, version 2.", "gnu general public 2"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.", "gnu general public 3"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3.", "gnu lesser 3"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "gnu lesser 2.1"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3.", "gnu affero 3"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gnu affero 3"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.", "redistribution source binary conditions reproduce"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", "redistribution source binary conditions neither endorse"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License.", "bsd 2-clause"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "creative commons attribution-sharealike 4.0"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "permission fee granted appear"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "permission fee granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", "unencumbered public domain"),
)
TRIGGER = r"(?i)licen[cs]|copyright|spdx|public domain|permission to use|hereby granted|redistribution and use|\bcc[ -]by|\bcc0"
#: A block's lines around a trigger, and the characters of a block that are compressed at once.
AROUND, PIECE, OVERLAP = 1, 3000, 1300
#: The share of a template's words that must be there.
LEAST_WORDS = 0.85
#: Words that name a licence or a kind of it, besides those that templates must have.
NAMES = frozenset("affero lesser library agpl lgpl gpl apache mit bsd mozilla mpl isc cc0 gnu eclipse epl artistic boost zlib creative commons noncommercial noderivatives noderivs sharealike by-nc by-sa by-nd by-nc-sa by-nc-nd attribution-noncommercial attribution-sharealike attribution-noderivatives 2-clause 3-clause 4-clause".split())
#: Words that deny, and how many words before a notice they reach.
DENIALS, REACH = frozenset("not never neither without cannot isn't aren't wasn't don't unlicensed".split()), 4


EDGES = ".,;:()\"'!?|<>*#$%&[]"


def words(text: str) -> list[str]:
    return [w for w in (x.strip(EDGES).lower() for x in text.split()) if w]


def denied(before: str) -> bool:
    """Whether the last words of a sentence that goes on deny what follows."""
    for x in reversed(before.split()[-REACH:]):
        if x[-1] in ".!?":
            return False
        if x.strip(EDGES).lower() in DENIALS:
            return True
    return False


#: All words that tell licences apart.
TELLING = NAMES.union(*(words(must) for _, _, must in TEMPLATES)) - frozenset("permission granted free charge conditions source binary public fee general 2.0 3 2 4.0 2.1 1.0 v3.0 neither appear reproduce redistribution endorse sublicense domain".split())


@functools.lru_cache(1)
def compressors() -> tuple:
    plain = zstandard.ZstdCompressor(level=3)
    own = []
    for name, text, must in TEMPLATES:
        raw = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        own.append((name, len(text), words(text), set(words(must)), zstandard.ZstdCompressor(level=3, dict_data=raw)))
    return plain, own


def blocks(text: str) -> Iterator[tuple[int, str]]:
    """(first line, piece) of the runs of lines around triggers; long runs in overlapping pieces."""
    lines = text.split("\n")
    hit = [i for i, x in enumerate(lines) if re.search(TRIGGER, x)]
    runs: list[list[int]] = []
    for i in hit:
        low, high = max(0, i - AROUND), min(len(lines), i + AROUND + 1)
        if runs and low <= runs[-1][1]:
            runs[-1][1] = high
        else:
            runs.append([low, high])
    for low, high in runs:
        # of a very long line only the surroundings of its triggers can matter: pieces without one are left out
        whole = "\n".join(lines[low:high])
        for s in range(0, max(1, len(whole) - OVERLAP), PIECE - OVERLAP):
            piece = whole[s : s + PIECE]
            if re.search(TRIGGER, piece):
                yield low, piece


def differences(template: list[str], block: list[str]) -> tuple[float, list[str], list[str], int, int]:
    """The share of the template's words found in order, the words missing, those put in between, and where the first
    and after the last of them are."""
    match = [m for m in difflib.SequenceMatcher(None, template, block, autojunk=False).get_matching_blocks() if m.size]
    if not match:
        return 0.0, template, [], 0, 0
    found = {k for m in match for k in range(m.a, m.a + m.size)}
    extra = [w for m, n in zip(match, match[1:]) for w in block[m.b + m.size : n.b]]
    return len(found) / len(template), [w for k, w in enumerate(template) if k not in found], extra, match[0].b, match[-1].b + match[-1].size


def around(piece: str, spots: list[tuple[int, int]], reach: int) -> Iterator[tuple[int, int]]:
    """Where the whole words within `reach` characters of each spot are; near spots share one part."""
    runs: list[list[int]] = []
    for low, high in spots:
        if runs and high - runs[-1][0] <= reach:
            runs[-1][1] = high
        else:
            runs.append([low, high])
    for low, high in runs:
        low, high = max(0, low - reach), min(len(piece), high + reach)
        while low and not piece[low - 1].isspace():
            low -= 1
        while high < len(piece) and not piece[high].isspace():
            high += 1
        yield low, high


def _lines(piece: str) -> Iterator[tuple[int, int]]:
    """Where the lines with a trigger are."""
    low = 0
    for x in piece.split("\n"):
        if re.search(TRIGGER, x) and len(x) < len(piece):
            yield low, low + len(x)
        low += len(x) + 1


def confirmed(piece: str) -> list[tuple]:
    """(licence, saving, share, missing, added) of the licences that a piece holds: of those on the same words, the best."""
    plain, own = compressors()
    whole, spots = set(words(piece)), [m.span() for m in re.finditer(TRIGGER, piece)]
    if not any(must <= whole for _, _, _, must, _ in own):
        return []
    # a template's own words decide a piece's size: hold it against the parts that hold the trigger too
    parts = [(0, len(piece)), *_lines(piece)]
    ranked, sizes = [], {}
    for name, size, template, must, c in own:
        if not must <= whole:
            continue
        for low, high in dict.fromkeys([*parts, *around(piece, spots, 2 * size)]):
            part = piece[low:high]
            tokens, raw = words(part), part.encode()
            if must <= set(tokens):
                if (low, high) not in sizes:
                    sizes[low, high] = len(plain.compress(raw))
                ranked.append((1 - len(c.compress(raw)) / sizes[low, high], name, template, must, tokens, low, high))
    hits = []
    for saving, name, template, must, tokens, low, high in sorted(ranked, key=lambda x: (-x[0], x[1])):
        share, missing, added, i, j = differences(template, tokens)
        if share < LEAST_WORDS or must & set(missing) or len(added) > len(template) // 4:
            continue
        if any(w in TELLING and w not in template or w in DENIALS for w in added):
            continue
        first = len(words(piece[:low]))
        # the text before the first matched word, with its marks
        seen = [m.start() for m in re.finditer(r"\S+", piece) if m[0].strip(EDGES)]
        if not denied(piece[: seen[first + i]]):
            hits.append((round(share * len(template)), saving, name, share, missing, added, first + i, first + j))
    out, taken = {}, []
    for n, saving, name, share, missing, added, i, j in sorted(hits, key=lambda x: (-x[0], -x[1], x[2], x[6])):
        if any(i < b and a < j and other != name for other, a, b in taken):
            continue
        taken.append((name, i, j))
        if name not in out or (share, saving) > (out[name][2], out[name][1]):
            out[name] = (name, saving, share, missing, added)
    return list(out.values())


def findings(text: str | None) -> list[tuple]:
    """(licence, line, saving, share, missing, added), the best for each licence."""
    best: dict[str, tuple] = {}
    for line, piece in blocks(text or ""):
        for name, saving, share, missing, added in confirmed(piece):
            if name not in best or (share, saving) > (best[name][3], best[name][2]):
                best[name] = (name, line, round(saving, 6), round(share, 6), " ".join(missing), " ".join(added))
    return [best[k] for k in sorted(best)]


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, licence, line, saving, share, missing, added) for docs (doc_id, text)."""
    common.small_batches(docs.sparkSession)
    hits = docs.select("doc_id", "text").where(F.col("text").rlike(TRIGGER))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "licence", "line", "saving", "share", "missing", "added"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.string(), pa.string()]
        for batch in batches:
            rows = [(i, *x) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for x in findings(t)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return hits.mapInArrow(run, "doc_id long, licence string, line long, saving double, share double, missing string, added string")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.table(spark, sf_dir, "documents"))
