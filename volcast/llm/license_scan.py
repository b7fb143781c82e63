"""License scans: MinHash bands over overlapping windows retrieve templates, shingle containment verifies.

A text's word shingles are cut into blocks, and every two neighbouring blocks are a window; a
template is looked for in windows whose blocks are at least as long as the template (and less than
twice as long), so an occurrence lies whole in some window.  Each hash function is a band of one
row: a window retrieves a template if they agree in any band.  A window that holds
the share ``c`` of a template has a Jaccard similarity of at least ``c / (4 + (1 - c))``, which for
c = 0.8 is 0.19; with 64 bands it is missed with a chance below 0.81 ** 64 = 1.4e-6.

A retrieved pair is a match if the window really holds the share ``min_share`` of the template's
shingles.  Windows of one template that overlap are one match, with the best share.

Each text is scanned by itself (no shuffle); the templates are a bounded parameter.

Defined cases: null and empty texts and those without a full shingle have no match; templates with
fewer words than a shingle are refused; repeated rows give repeated matches; a null id stays null;
an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from volcast.llm.common import Words, bounded_slices, id_text, mix64, text_bytes, window_hash

WORDS, BANDS = 5, 64
SCHEMA = "doc_id long, license string, start_word long, n_words long, share double"
#: Letters and digits in lower case, everything else ASCII a blank; other bytes stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

#: Notices of well-known licences (fixed values).
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0 line", "Licensed under the Apache License, Version 2.0."),
    ("MIT line", "Released under the MIT License."),
    ("CC-BY-NC-4.0 line", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0 line", "This work is licensed under the GNU General Public License, version 3."),
    ("Apache-2.0 notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
     "in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
     "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
     "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
     "specific language governing permissions and limitations under the License."),
    ("MIT permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
     "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
     "the Software."),
    ("GPL-3.0 notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version."),
    ("BSD conditions", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met: Redistributions of source code must retain the above copyright "
     "notice, this list of conditions and the following disclaimer."),
    ("MPL-2.0 notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
     "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
)


def _family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240608)
    return (rng.integers(0, 1 << 31, BANDS, dtype=np.uint32) * np.uint32(2) + np.uint32(1),
            rng.integers(0, 1 << 32, BANDS, dtype=np.uint32))


class Templates:
    def __init__(self, templates):
        self.names = [n for n, _ in templates]
        self.sets = []
        for name, text in templates:
            s = np.unique(window_hash(Words([text.encode().translate(_FOLD)]).hash, WORDS))
            if not len(s):
                raise ValueError(f"the template {name!r} has fewer than {WORDS} words")
            self.sets.append(s)
        self.family = _family()
        bands = [self.bands(s) for s in self.sets]
        self.signs = [m.min(0) for m in bands]
        self.width = [1 << (len(s) - 1).bit_length() for s in self.sets]      # block length: len <= width < 2 * len
        # A band of a window can only agree with a template's if the window holds the template's shingle of
        # that band's minimum, so bands are worked out for the windows around those shingles alone.
        self.of_shingle: dict[int, set[int]] = {}
        for t, m in enumerate(bands):
            for shingle in np.unique(self.sets[t][m.argmin(0)]).tolist():
                self.of_shingle.setdefault(shingle, set()).add(t)
        self.keys = np.array(sorted(self.of_shingle), dtype=np.uint64)
        self.low_bits = np.zeros(1 << 16, dtype=bool)
        self.low_bits[(self.keys & np.uint64(0xFFFF)).astype(np.int64)] = True

    def bands(self, shingles: np.ndarray) -> np.ndarray:
        factor, summand = self.family
        return (mix64(shingles) >> np.uint64(32)).astype(np.uint32)[:, None] * factor + summand

    def _retrieved(self, shingles: np.ndarray, begin: np.ndarray):
        """(template, text, block) of the windows that agree with a template in some band."""
        at = np.flatnonzero(self.low_bits[(shingles & np.uint64(0xFFFF)).astype(np.int64)])
        at = at[np.isin(shingles[at], self.keys)]
        owner = np.searchsorted(begin, at, side="right") - 1
        near = {(t, d, b) for i, d in zip(at.tolist(), owner.tolist()) for t in self.of_shingle[int(shingles[i])]
                for b in ((i - begin[d]) // self.width[t] - 1, (i - begin[d]) // self.width[t]) if b >= 0}
        for t, d, b in near:
            lo, hi = self._window(begin, t, d, b)
            if (self.bands(shingles[lo:hi]).min(0) == self.signs[t]).any():
                yield t, d, b

    def _window(self, begin: np.ndarray, t: int, d: int, b: int) -> tuple[int, int]:
        """Window ``b`` of text ``d``: the blocks ``b`` and ``b + 1`` of the template's block length."""
        lo = int(begin[d]) + int(b) * self.width[t]
        return lo, min(lo + 2 * self.width[t], int(begin[d + 1]))

    def scan(self, texts: list[bytes], min_share: float, retrieve: bool = True):
        """(text, template, first word, number of words, share) of the matches; ``retrieve=False`` verifies all windows."""
        w = Words([t.translate(_FOLD) for t in texts])
        grams = window_hash(w.hash, WORDS)
        count = np.maximum(w.last - w.first - WORDS + 1, 0)          # shingles of each text
        have = np.flatnonzero(count)
        if not len(have):
            return []
        first, n = w.first[have], count[have]
        shingles = grams[np.repeat(first - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())]
        begin = np.append(0, np.cumsum(n))                             # of each text, in ``shingles``
        windows = self._retrieved(shingles, begin) if retrieve else (
            (t, d, b) for t in range(len(self.names)) for d in range(len(n)) for b in range(-(-int(n[d]) // self.width[t])))
        hits: dict[tuple[int, int], list[tuple[int, int, float]]] = {}
        for t, d, b in windows:
            lo, hi = self._window(begin, t, d, b)
            inside = np.isin(shingles[lo:hi], self.sets[t])
            share = len(np.unique(shingles[lo:hi][inside])) / len(self.sets[t])
            if share >= min_share:
                places = np.flatnonzero(inside)
                hits.setdefault((d, t), []).append((lo + places[0], lo + places[-1], share))
        out = []
        for (d, t), spans in sorted(hits.items()):
            spans.sort()
            merged = [list(spans[0])]
            for lo, hi, share in spans[1:]:
                if lo <= merged[-1][1] + 1:
                    merged[-1][1:] = [max(hi, merged[-1][1]), max(share, merged[-1][2])]
                else:
                    merged.append([lo, hi, share])
            out += [(int(have[d]), self.names[t], int(lo - begin[d]), int(hi - lo + WORDS), float(s)) for lo, hi, s in merged]
        return out


def license_scan(docs: DataFrame, templates=TEMPLATES, min_share: float = 0.8, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, license, start_word, n_words, share: one row per match; words are runs of letters and digits."""
    templates = tuple(templates)

    def run(batches):
        known = Templates(templates)
        for whole in batches:
            for batch in bounded_slices(whole, 1):
                found = known.scan(text_bytes(batch.column(1)), min_share)
                ids = batch.column(0).to_pylist()
                cols = list(zip(*found)) if found else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i] for i in cols[0]], pa.int64()), pa.array(cols[1], pa.string()),
                     pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.float64())],
                    ["doc_id", "license", "start_word", "n_words", "share"])

    return id_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
