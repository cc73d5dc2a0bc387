"""License scans: normalised text compared with license templates by the Dice coefficient over word bigrams.

A text is normalised to its lower-case words, and every window of words, within a line or over many, is compared with
every template. A window that is reported begins and ends with bigrams of the template that it has once: any other can be
cut shorter without a loss in its coefficient. So only such windows are made: from each bigram of the template to the
right, counts kept as the window grows, until the bigram comes again or more words are foreign than the threshold allows.
Of overlapping windows the one with the best coefficient is reported.

Scale: each text is scanned within its row; the templates are part of the code. A template is tried only if the text has
as many of its bigrams as the threshold needs; windows that begin with the same bigram do not overlap, so a template's
scan takes at most the words of the text times the template's bigrams.

Edge cases: null, empty and wordless texts have no match; ties go to the larger template (a licence that contains another's
whole text), then to the first by name, to the shorter and to the earlier window; repeated rows are reported each; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

THRESHOLD = 0.8

# Public license texts and notices, by name.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "BSD-2-Clause": [
        "Released under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Released under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "All-Rights-Reserved": ["All rights reserved."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}

_WORD = re.compile(r"[^\W_]+")

Bigrams = set[tuple[str, str]]
Match = tuple[int, int, str, float]


def bigrams(words: list[str]) -> Bigrams:
    return set(zip(words, words[1:]))


def normalised(text: str) -> list[str]:
    """Lower-case words of letters and digits."""
    return _WORD.findall(text.lower())


def dice(a: Bigrams, b: Bigrams) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


class Templates:
    """Templates with their bigrams and sizes."""

    def __init__(self, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD):
        self.threshold = threshold
        self.all = [(name, bigrams(normalised(text))) for name in sorted(templates) for text in templates[name]]
        self.known: dict[tuple[str, str], list[int]] = {}
        for k, (_, grams) in enumerate(self.all):
            for g in grams:
                self.known.setdefault(g, []).append(k)
        # a window needs so many of the template's bigrams, even if it has no others
        self.least = [next((c for c in range(1, len(grams) + 1) if 2 * c / (c + len(grams)) >= threshold), len(grams) + 1) for _, grams in self.all]

    def windows(self, words: list[str], starts: list[int], k: int) -> Iterator[tuple[int, int, float]]:
        """(first word, last word, coefficient) of the windows near template k that cannot be cut shorter."""
        grams, size, end = self.all[k][1], len(self.all[k][1]), starts[-1]
        for i in starts:
            first, ours, foreign = (words[i], words[i + 1]), set(), set()
            for j in range(i, end + 1):
                g = words[j], words[j + 1]
                if g in grams:
                    if g not in ours:
                        ours.add(g)
                        if (d := 2 * len(ours) / (len(ours) + len(foreign) + size)) >= self.threshold:
                            yield i, j + 1, d
                    elif g == first:
                        break
                elif g not in foreign:
                    foreign.add(g)
                    if 2 * size / (2 * size + len(foreign)) < self.threshold:
                        break

    def scan(self, text: str) -> list[Match]:
        """(first line, last line, license, coefficient) of the matches, lines counted from 0."""
        words = normalised(text)
        near = [(i, g) for i, g in enumerate(zip(words, words[1:])) if g in self.known]
        shared = Counter(k for g in {g for _, g in near} for k in self.known[g])
        found = []
        for k in sorted(k for k, n in shared.items() if n >= self.least[k]):
            name, grams = self.all[k]
            found += [(-d, -len(grams), name, j - i, i) for i, j, d in self.windows(words, [i for i, g in near if g in grams], k)]
        if not found:
            return []
        taken, chosen = bytearray(len(words)), []
        for d, _, name, more, i in sorted(found):
            if taken.find(1, i, i + more + 1) < 0:
                taken[i: i + more + 1] = b"\1" * (more + 1)
                chosen.append((i, i + more, name, -d))
        ends = list(accumulate(len(normalised(line)) for line in text.split("\n")))  # words up to each line's end
        return [(bisect_right(ends, i), bisect_right(ends, j), name, d) for i, j, name, d in sorted(chosen)]


def scan_licenses(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, *, threshold: float = THRESHOLD,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, first_line, last_line, license, dice) of every license text or notice in the texts."""
    ready = Templates(templates, threshold)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for k, text in enumerate(batch.column("text")):
                got = ready.scan(text.as_py() or "")
                at += [k] * len(got)
                rows += got
            columns = list(zip(*rows)) if rows else [(), (), (), ()]
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at, pa.int32())), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                                             names=["id", "first_line", "last_line", "license", "dice"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return source.mapInArrow(scan, f"id {kind}, first_line int, last_line int, license string, dice double").withColumnRenamed("id", id_col)
