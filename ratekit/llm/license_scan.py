r"""License scans: templates met in texts by MinHash over overlapping windows.

Texts and templates are normalised to lower-case words of letters and
digits, and hashed as 5-word shingles (a template of fewer words: as one
shingle of all).  For each template, windows a quarter longer than it overlap over
the whole text, starting every eighth of its length; a window's MinHash
signature of ``BANDS`` values is compared with the template's, band by band.

Band settings: a window that wholly holds a copy with 80 % of the
template's shingles has a Jaccard similarity of at least 0.8 / 1.7 with it, so
with one row per band it agrees on some band with probability over
1 - (1 - 0.47)^20, and misses with 4e-6 (and the windows beside it try again).
Every window so retrieved is verified: the share of the template's
shingles that occur in it, counted exactly, must reach ``MIN_CONTAINED``.

Sliding minima are taken over streams of whole documents in numpy, in
chunks that overlap by a window, so memory is bounded whatever the length
of a text.  Spark reads and writes; there is no shuffle.  Templates are
a small fixed list, sent with the function.

Defined results: a null or empty text has no matches (an empty array);
matches are ordered by place, then by template; repeated rows and an empty
table need no special care; other columns are untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from .common import WordHashes, bounded_batches, odd_constants, shingles

#: Wording of licence notices, as their owners publish them.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice":
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    "mit": "Released under the MIT License.",
    "mit-text":
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice":
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    "bsd-conditions":
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    "isc-text":
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mpl-2.0":
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "all-rights-reserved": "All rights reserved.",
}

SHINGLE = 5
BANDS = 20
MIN_CONTAINED = 0.8
#: Words of text handled at once.
CHUNK = 1 << 14

_MATCH = ArrayType(StructType([
    StructField("license", StringType()), StructField("start", IntegerType()), StructField("n_words", IntegerType()),
    StructField("contained", DoubleType())]))

_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_HASH = odd_constants(BANDS, seed=71)
_FULL = np.uint64(2**64 - 1)
_NO_RANK = np.uint32(2**32 - 1)


def normal_words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased."""
    return text.encode().translate(_NORMAL).split() if text else []


class Template:
    """One template: its shingles, its signature, and the windows that look for it."""

    def __init__(self, name: str, text: str, hashes: WordHashes):
        found = normal_words(text)
        self.name, self.width = name, min(SHINGLE, len(found))
        self.set = np.unique(shingles(hashes.of(found), self.width))
        self.signature = _ranks(self.set).min(axis=1)
        self.stride = max(1, len(found) // 8)
        # in shingles: the template, a quarter more, and what the next window's start may miss
        own = len(found) - self.width + 1
        self.span = own + max(own // 4, 1) + self.stride


def _ranks(parts: np.ndarray) -> np.ndarray:
    """Order of each shingle under each band's hash function: a row per band."""
    ranks = (parts[None, :] * _HASH[:, None] >> np.uint64(32)).astype(np.uint32)
    ranks[:, parts == _FULL] = _NO_RANK
    return ranks


def _ladder(ranks: np.ndarray, span: int) -> list[np.ndarray]:
    """Minima over windows of 1, 2, 4, ... places up to ``span``, from every place."""
    levels = [ranks]
    while 2 << (len(levels) - 1) <= span:
        last, step = levels[-1], 1 << (len(levels) - 1)
        level = last.copy()
        np.minimum(last[:, :-step], last[:, step:], out=level[:, :-step])
        levels.append(level)
    return levels


def _window_minima(levels: list[np.ndarray], span: int, stride: int) -> np.ndarray:
    """Minima over windows of ``span`` places from every ``stride``-th; the last ones are cut short."""
    level = span.bit_length() - 1
    low = levels[level]
    out = low[:, ::stride].copy()
    shifted = low[:, span - (1 << level)::stride] if span > 1 << level else low[:, :0]
    np.minimum(out[:, :shifted.shape[1]], shifted, out=out[:, :shifted.shape[1]])
    return out


class Scanner:
    """Looks for all templates in streams of documents."""

    def __init__(self, templates: dict[str, str], min_contained: float):
        self.hashes = WordHashes()
        self.templates = [Template(name, text, self.hashes) for name, text in templates.items()]
        self.min_contained = min_contained
        self.longest = max((t.span for t in self.templates), default=0)

    def scan(self, texts: list[str | None]) -> list[list[tuple[str, int, int, float]]]:
        out: list[list] = [[] for _ in texts]
        parts: list[tuple[int, np.ndarray]] = []
        total = 0
        for i, text in enumerate(texts):
            words = self.hashes.of(normal_words(text))
            if len(words):
                parts.append((i, words))
                total += len(words)
            if total >= CHUNK:
                self._stream(parts, out)
                parts, total = [], 0
        self._stream(parts, out)
        return [sorted(found, key=lambda m: (m[1], m[0])) for found in out]

    def _stream(self, parts: list[tuple[int, np.ndarray]], out: list[list]) -> None:
        """Matches of the documents, laid end to end, in chunks that overlap by the longest window."""
        if not parts:
            return
        words = np.concatenate([w for _, w in parts])
        starts = np.cumsum([0, *(len(w) for _, w in parts)])
        for width in sorted({t.width for t in self.templates}):
            own = [t for t in self.templates if t.width == width]
            if len(words) < width:
                continue
            every = shingles(words, width)
            for s in starts[1:-1]:  # what runs over the end of a document is no shingle
                every[max(0, s - width + 1):s] = _FULL
            seen: dict[str, list[np.ndarray]] = {t.name: [] for t in own}
            for at in range(0, len(every), CHUNK):
                part = every[at:at + CHUNK + self.longest]
                levels = _ladder(_ranks(part), max(t.span for t in own))
                for t in own:
                    near = (_window_minima(levels, t.span, t.stride) == t.signature[:, None]).any(axis=0)
                    windows = np.nonzero(near)[0] * t.stride
                    if len(windows):
                        seen[t.name].append(at + windows[windows < CHUNK])
            for t in own:
                if seen[t.name]:
                    self._verify(t, every, np.concatenate(seen[t.name]), starts, parts, out)

    def _verify(self, t: Template, every, windows, starts, parts, out) -> None:
        """Exact containment in each retrieved window; windows that share matched words are one match."""
        best: dict[int, list[list]] = {}
        for w in windows.tolist():
            first = int(np.searchsorted(starts, w, "right")) - 1
            last = int(np.searchsorted(starts, min(w + t.span, len(every)) - 1, "right")) - 1
            for d in range(first, last + 1):  # a window over the end of a document counts for each by itself
                low, high = max(w, int(starts[d])), min(w + t.span, int(starts[d + 1]), len(every))
                hit = np.nonzero(np.isin(every[low:high], t.set))[0]
                contained = len(np.unique(every[low:high][hit])) / len(t.set)
                if contained >= self.min_contained:
                    a, b = low + int(hit[0]) - int(starts[d]), low + int(hit[-1]) - int(starts[d]) + t.width
                    best.setdefault(d, []).append([a, b, contained])
        for d, found in best.items():
            merged: list[list] = []
            for a, b, c in sorted(found):
                if merged and a < merged[-1][1]:
                    merged[-1] = [merged[-1][0], max(b, merged[-1][1]), max(c, merged[-1][2])]
                else:
                    merged.append([a, b, c])
            out[parts[d][0]] += [(t.name, a, b - a, c) for a, b, c in merged]


def scan(text: Column, templates: dict[str, str] | None = None, min_contained: float = MIN_CONTAINED) -> Column:
    """Array of (license, start, n_words, contained) for a text column; start counts words from 0."""
    wanted = dict(TEMPLATES if templates is None else templates)

    @F.pandas_udf(_MATCH)
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(wanted, min_contained)
        names = ("license", "start", "n_words", "contained")
        for texts in batches:
            yield pd.Series([[dict(zip(names, m)) for m in found] for found in scanner.scan(texts.tolist())])

    return scanned(text)


def with_licenses(docs: DataFrame, text: str = "text", into: str = "licenses",
                  templates: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with the matches of each text in column ``into`` (added, or replaced if it is there)."""
    bounded_batches(docs.sparkSession)
    return docs.withColumn(into, scan(F.col(text), templates))
