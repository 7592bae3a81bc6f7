"""License scans: MinHash bands over overlapping text windows retrieve templates, shingle containment verifies them.

Words are cut into overlapping windows. A template of ``m`` words is looked for in windows of the smallest width
``L >= 2 m`` of ``WIDTHS`` that start every ``L / 2`` words, so each occurrence lies whole in one of them. Window and
template are compared by ``BANDS`` bands of one MinHash value each. A window that holds ``CONTAINMENT`` of a template's
shingles has at least about a fifth of all shingles of both in common, so a band agrees with a chance of
``1 - (1 - J) ** BANDS`` (see ``miss_chance``). Retrieved pairs are verified by the exact share of the template's
shingles inside the window, and windows that overlap on one occurrence are merged. Of templates that match the same
words (two versions of a notice, say) those with the highest containment are reported.

Templates are a fixed short list (or the caller's), so they travel with the task; documents are not shuffled.

Edge cases: null and empty texts match nothing; very long texts are hashed block by block; a template without a word
is ignored, one shorter than a shingle must occur as a whole; repeated rows repeat their matches; ties between
templates of equal containment are all reported; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.llm.common import WordHashes, map_batches, shingle_hashes, text_bytes

# Short public notices by SPDX-like name.
TEMPLATES = {
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "LGPL-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so"
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-notice": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "All-rights-reserved": "All rights reserved.",
}
SHINGLE = 3
WIDTHS = (8, 16, 32, 64, 128, 256, 512, 1024, 2048)
BANDS = 56
CONTAINMENT = 0.8
BLOCK = 1 << 14
STEP = WIDTHS[0] // 2
WORD = re.compile(r"[^\W_]+")


def miss_chance(words: int, bands: int = BANDS, containment: float = CONTAINMENT) -> float:
    """Chance that no band agrees for a template of ``words`` words with just enough of it in a window."""
    own = max(1, words - SHINGLE + 1)
    window = next(w for w in WIDTHS if w >= 2 * words) - SHINGLE + 1
    shared = containment * own
    return (1 - shared / (window + own - shared)) ** bands


class Templates:
    """Shingle sets and MinHash values of the templates, by window width."""

    def __init__(self, texts: dict[str, str], bands: int = BANDS, containment: float = CONTAINMENT, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.factors = rng.integers(0, 1 << 31, bands, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.shifts = rng.integers(0, 1 << 32, bands, dtype=np.uint32)
        self.containment, self.hashes = containment, WordHashes()
        self.names, self.sets, self.by_width = [], [], {}
        for name, text in sorted(texts.items()):
            words = self.words_of(text.encode())
            if not len(words):
                continue
            if 2 * len(words) > WIDTHS[-1]:
                raise ValueError(f"template {name} is longer than {WIDTHS[-1] // 2} words")
            width = next(w for w in WIDTHS if w >= 2 * len(words))
            k = min(SHINGLE, len(words))
            shingles = np.unique(shingle_hashes(words, k))
            group = self.by_width.setdefault((width, k), ([], []))
            group[0].append(len(self.names))
            group[1].append(self.minima(shingles).min(0))
            self.names.append(name)
            self.sets.append(shingles)

    def words_of(self, data: bytes) -> np.ndarray:
        return self.hashes.of(WORD.findall(data.decode("utf-8", "replace").lower()))

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        """MinHash values of consecutive stretches of ``STEP`` shingles, ``(stretches, bands)``."""
        n = -(-len(shingles) // STEP)
        out = np.empty((n, len(self.factors)), np.uint32)
        for at in range(0, len(shingles), BLOCK):
            part = (shingles[at:at + BLOCK] >> np.uint64(32)).astype(np.uint32)
            if len(part) % STEP:  # repeating the last one changes no minimum
                part = np.concatenate([part, np.repeat(part[-1:], STEP - len(part) % STEP)])
            values = (part[:, None] ^ self.shifts) * self.factors
            out[at // STEP:at // STEP + len(part) // STEP] = values.reshape(-1, STEP, values.shape[1]).min(1)
        return out

    def scan(self, data: bytes) -> list[tuple[str, int, int, float, int]]:
        """``(name, first word, end word, containment, windows)`` of every occurrence in a whole text."""
        words = self.words_of(data)
        found: list[tuple[str, int, int, float, int]] = []
        levels: dict[tuple[int, int], np.ndarray] = {}
        for (width, k), (members, values) in self.by_width.items():
            if len(words) < k:
                continue
            shingles = shingle_hashes(words, k)
            if (STEP, k) not in levels:
                levels[STEP, k] = self.minima(shingles)
            half = STEP
            while half < width // 2:  # minima of wider stretches from those of two narrower ones
                if (2 * half, k) not in levels:
                    levels[2 * half, k] = _pairs(levels[half, k])
                half *= 2
            stretches = levels[half, k]
            windows = np.minimum(stretches[:-1], stretches[1:]) if len(stretches) > 1 else stretches
            for number, value in zip(members, values):
                hits = np.flatnonzero((windows == value).any(1))
                found += self.verify(number, k, shingles, hits, half)
        return [m for m in found if not any(o[1] < m[2] and m[1] < o[2] and o[3] > m[3] for o in found)]

    def verify(self, number: int, k: int, shingles: np.ndarray, hits: np.ndarray, half: int) -> list[tuple]:
        """Exact containment per retrieved window; overlapping matches of one occurrence become one."""
        wanted, out = self.sets[number], []
        for hit in hits:
            start = int(hit) * half
            window = shingles[start:start + 2 * half]
            at = np.flatnonzero(np.isin(window, wanted))
            share = len(np.unique(window[at])) / len(wanted)
            if share < self.containment:
                continue
            first, end = start + int(at[0]), start + int(at[-1]) + k
            if out and first < out[-1][2]:
                _, a, b, best, n = out[-1]
                out[-1] = (self.names[number], a, max(b, end), max(best, share), n + 1)
            else:
                out.append((self.names[number], first, end, share, 1))
        return out


def _pairs(minima: np.ndarray) -> np.ndarray:
    if len(minima) % 2:
        minima = np.concatenate([minima, minima[-1:]])
    return np.minimum(minima[::2], minima[1::2])


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, license, first_word, end_word, containment, windows`` of every match in every whole text."""
    texts = TEMPLATES if templates is None else templates
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), text_bytes(text).alias("data"))
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int32()]
    names = ["doc_id", "license", "first_word", "end_word", "containment", "windows"]

    def work():
        known = Templates(texts)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            out = [(doc, *match) for doc, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                   for match in known.scan(data)]
            if not out:
                return None
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        return step

    return map_batches(
        rows, work, "doc_id long, license string, first_word long, end_word long, containment double, windows int")
