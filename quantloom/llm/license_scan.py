"""License scans by MinHash bands over overlapping text windows.

Each template is a set of five-word shingles (the whole sequence, if shorter). A text is covered by
windows as long as the templates, each an eighth of its length after the one before; a window's MinHash
bands retrieve templates, and exact shingle containment around the window verifies them. A window that
holds no shingle of any template has nothing in common with one and needs no signature.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .wordcodes import SHINGLE_WORDS, mix, shingle_codes, text_blocks, words_of

MIN_CONTAINMENT = 0.75
BANDS, BAND_ROWS = 24, 2  # a window whose similarity to a template is 0.5 is retrieved with probability 1 - 0.75 ** 24 = 0.999

# fixed values: short notices and the openings of well-known license texts
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "all-rights-reserved": "All rights reserved.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}

_NOT_WORD = np.ones(256, dtype=bool)
_NOT_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = False
_SEEDS = np.random.default_rng(0x11CE).integers(1, 2**63, BANDS * BAND_ROWS, dtype=np.uint64)


def _bands(shingles: np.ndarray) -> list[tuple[int, int]]:
    least = mix(shingles[None, :] ^ _SEEDS[:, None]).min(axis=1).reshape(BANDS, BAND_ROWS)
    code = mix(least[:, 0] + least[:, 1] * np.uint64(3))
    return list(enumerate(code.tolist()))


class Templates:
    """Shingle sets of the templates and their bands; as large as the templates are, whatever the corpus."""

    def __init__(self, texts: Mapping[str, str]):
        self.names, self.sets, self.sizes, self.widths = [], [], [], []
        for name, text in sorted(texts.items()):
            data = np.frombuffer(text.encode(), np.uint8)
            codes = words_of(data, np.array([0, len(data)]), _NOT_WORD).codes
            if len(codes):
                self.names.append(name)
                self.sizes.append(len(codes))
                self.widths.append(min(SHINGLE_WORDS, len(codes)))
                self.sets.append(np.unique(shingle_codes(codes)))
        self.bands: dict[int, dict[tuple[int, int], list[int]]] = {}
        for t, shingles in enumerate(self.sets):
            for band in _bands(shingles):
                self.bands.setdefault(self.widths[t], {}).setdefault(band, []).append(t)
        self.all = {w: np.unique(np.concatenate([s for s, x in zip(self.sets, self.widths) if x == w])) for w in set(self.widths)}

    def find(self, codes: np.ndarray) -> dict[int, tuple[float, int]]:
        """{template: (containment, first word)} for the words of one text."""
        found: dict[int, tuple[float, int]] = {}
        for width, known in self.all.items():
            if len(codes) < width:
                continue
            shingles = shingle_codes(codes, width)
            hits = np.flatnonzero(np.isin(shingles, known))
            if not len(hits):
                continue
            for size in sorted({s for s, w in zip(self.sizes, self.widths) if w == width}):
                step, span = max(1, size // 8), size - width + 1
                firsts = np.unique(np.concatenate([np.arange(max(0, (h - span + step) // step * step), h + 1, step) for h in hits.tolist()]))
                for first in firsts.tolist():
                    own = np.unique(shingles[first : first + span])
                    near = {t for band in _bands(own) for t in self.bands[width].get(band, ())}
                    for t in near:
                        # windows start every few words, so look a step further on both sides
                        a = max(0, first - step)
                        around = shingles[a : first + self.sizes[t] - width + 1 + step]
                        in_set = np.isin(around, self.sets[t])
                        share = len(np.unique(around[in_set])) / len(self.sets[t])
                        if share >= MIN_CONTAINMENT and share > found.get(t, (0.0, 0))[0]:
                            found[t] = (share, a + int(np.argmax(in_set)))
        return found


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """(doc_id, license, containment, first_word) for each row of ``docs(doc_id, text)`` and template it holds.

    Words are runs of letters and digits with A-Z lowered; containment is the share of the template's
    shingles around the best window, MIN_CONTAINMENT at least. Null, empty and short texts hold nothing
    and give no row; repeated rows give repeated rows; an empty table gives none; other columns are
    ignored. Texts are scanned whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Templates(templates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids, rows = batch.column("doc_id").to_pylist(), []
            for row, data, bounds in text_blocks(batch.column("text")):
                words = words_of(data, bounds, _NOT_WORD)
                # one pass over the block tells which rows hold a shingle of any template
                some = np.zeros(len(bounds) - 1, bool)
                for width, codes in known.all.items():
                    if len(words.codes) >= width:
                        at = np.flatnonzero(np.isin(shingle_codes(words.codes, width), codes, kind="sort"))
                        some[np.searchsorted(words.offsets, at, "right") - 1] = True
                for i in np.flatnonzero(some).tolist():
                    for t, (share, first) in sorted(known.find(words.codes[words.offsets[i] : words.offsets[i + 1]]).items()):
                        rows.append((ids[row + i], known.names[t], share, first))
            if rows:
                kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], ["doc_id", "license", "containment", "first_word"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, license string, containment double, first_word long")
