"""License scans: MinHash bands over overlapping windows of a text retrieve license texts; exact shingle containment decides.

Windows have a few fixed lengths and stand at every word, so one lies right over any notice. A license text is cut into windows
of the longest of these lengths that fits it. ``BANDS`` bands of ``ROWS`` minima each meet with a probability of
1 - (1 - s**ROWS)**BANDS at similarity s: 0.998 at 0.8 and over 0.9999 at 0.9; equal windows always meet.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spotshare.llm.common import DIGITS, LETTERS, batch_of, byte_classes, chunks, encoded, mix, tokens

SHINGLE = 2  # words
LENGTHS = (2, 4, 8, 16, 32)  # shingles in a window
SLICE = 1 << 16  # shingles whose band keys are held at once
BANDS, ROWS = 6, 2
CONTAINED = 0.8
_CLASSES = byte_classes(word=LETTERS + DIGITS)

# Public notices of well-known licenses, in their own words.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
                 "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                  "License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    "LGPL-notice": "licensed under the GNU Lesser General Public License",
    "AGPL-notice": "licensed under the GNU Affero General Public License",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                      "the following conditions are met",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-long": "licensed under a Creative Commons Attribution-ShareAlike License",
    "CC0-notice": "dedicated to the public domain under CC0 1.0",
    "Proprietary-notice": "All rights reserved. Do not redistribute.",
}


def _shingles(words: np.ndarray) -> np.ndarray:
    if not len(words):
        return words
    while len(words) < SHINGLE:
        words = np.append(words, np.uint64(0))
    h = words[: len(words) - SHINGLE + 1]
    for k in range(1, SHINGLE):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k : len(words) - SHINGLE + 1 + k])
    return h


def _band_keys(shingles: np.ndarray) -> dict[int, np.ndarray]:
    """For each window length that fits: the band keys (BANDS, windows) of the windows at all places."""
    keys: dict[int, list[np.ndarray]] = {}
    for band in range(BANDS):
        low = [mix(shingles ^ np.uint64(0xA24BAED4963EE407 * (band * ROWS + r + 1) % (1 << 64))) for r in range(ROWS)]
        width = 1
        for length in LENGTHS:
            if length > len(shingles):
                break
            while width < length:
                low = [np.minimum(x[:-width], x[width:]) for x in low]
                width *= 2
            key = low[0]
            for x in low[1:]:
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + x)
            keys.setdefault(length, []).append(key)
    return {length: np.stack(k) for length, k in keys.items()}


@dataclass
class Licenses:
    """The license texts as shingles, and their band keys with the license and place of each."""

    names: list[str]
    shingles: list[np.ndarray]
    index: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, templates: dict[str, str]) -> Licenses:
        names, shingles, found = sorted(templates), [], {}
        for k, name in enumerate(names):
            words, *_ = tokens([templates[name].lower().encode()], _CLASSES)
            own = _shingles(words)
            if len(own) < LENGTHS[0]:
                raise ValueError(f"{name}: shorter than the shortest window")
            shingles.append(own)
            length = max(n for n in LENGTHS if n <= len(own))
            for at, column in enumerate(_band_keys(own)[length].T):
                for band, key in enumerate(column):
                    found.setdefault((length, band), []).append((int(key), k, at))
        index = {}
        for key, rows in found.items():
            rows.sort()
            index[key] = (np.array([r[0] for r in rows], dtype=np.uint64), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
        return cls(names, shingles, index)

    def scan(self, shingles: np.ndarray) -> list[tuple[int, int, int, float]]:
        """License, first and last shingle and containment of each notice in a text; of overlapping ones the best, then the longest."""
        places = set()
        # a long text in slices that share the longest window but one place
        for offset in range(0, max(1, len(shingles) - LENGTHS[0] + 1), SLICE):
            for length, keys in _band_keys(shingles[offset : offset + SLICE + max(LENGTHS) - 1]).items():
                for band in range(BANDS):
                    if (length, band) not in self.index:
                        continue
                    own, licence, at = self.index[length, band]
                    left = np.searchsorted(own, keys[band], side="left")
                    for i in np.flatnonzero(own[np.minimum(left, len(own) - 1)] == keys[band]):
                        for j in range(left[i], len(own)):
                            if own[j] != keys[band][i]:
                                break
                            places.add((int(licence[j]), offset + int(i) - int(at[j])))
        found = []
        for licence, start in places:
            own = self.shingles[licence]
            slack = max(2, len(own) // 8)  # room for words put in
            first = max(0, start - slack)
            region = shingles[first : max(0, start + len(own) + slack)]
            # a shingle counts near its place alone, not where a neighbour in the slack has it
            apart = np.arange(first - start, first - start + len(region))[:, None] - np.arange(len(own))
            placed = (region[:, None] == own) & (np.abs(apart) <= slack)
            share = len(np.unique(own[placed.any(0)])) / len(np.unique(own))
            if share >= CONTAINED:
                hit = np.flatnonzero(placed.any(1))
                found.append((licence, first + int(hit[0]), first + int(hit[-1]), share))
        found.sort(key=lambda f: (-f[3], -len(self.shingles[f[0]]), f[1], f[0]))
        # what is taken never overlaps, so only the neighbours by place can
        starts: list[int] = []
        taken: dict[int, tuple[int, int, int, float]] = {}
        for f in found:
            at = bisect_right(starts, f[2])
            if not at or taken[starts[at - 1]][2] < f[1]:
                starts.insert(at, f[1])
                taken[f[1]] = f
        return [taken[start] for start in starts]


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row for each license notice: ``doc_id``, ``license``, ``start`` and ``end`` (bytes of the lower-cased text, [start, end)),
    ``start_word``, ``containment`` (share of the license's shingles in the place), ``notice`` (the text there).

    Documents without a notice don't appear, and NULL or empty texts have none. Repeated rows repeat their notices, a NULL id
    stays NULL, other columns are not read. Whole texts are scanned. Without templates nothing is found.
    """
    licenses = Licenses.of(TEMPLATES if templates is None else templates)
    schema = pa.schema([
        ("doc_id", pa.int64()), ("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("start_word", pa.int32()),
        ("containment", pa.float64()), ("notice", pa.string()),
    ])

    def rows_of(ids: list, texts: list[bytes]) -> Iterator[tuple]:
        words, owner, _, start, end = tokens(texts, _CLASSES)
        firsts = np.searchsorted(owner, np.arange(len(texts) + 1))
        for i, text in enumerate(texts):
            a, b = firsts[i], firsts[i + 1]
            for licence, head, tail, share in licenses.scan(_shingles(words[a:b])):
                left, right = int(start[a + head]), int(end[min(a + tail + SHINGLE, b) - 1])
                yield ids[i], licenses.names[licence], left, right, head, share, text[left:right].decode(errors="replace")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, part in chunks(encoded(batch.column(1), lower=True)):
                rows = list(rows_of(ids[first : first + len(part)], part))
                if rows:
                    yield batch_of(schema, **{f.name: [r[k] for r in rows] for k, f in enumerate(schema)})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, license string, start int, end int, start_word int, containment double, notice string")
