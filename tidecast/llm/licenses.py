"""License scan: MinHash bands over overlapping windows find candidate templates, shingle containment decides."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidecast.llm.common import worker_store

SHINGLE, CONTAINMENT, BANDS = 5, 0.8, 32
#: Shingles of the finest blocks.
FINEST = 4
#: Shingles whose windows are looked at together, a multiple of every step; words whose hash a worker remembers.
SLICE = 1 << 14
REMEMBERED = 1 << 19

#: Notices as they are commonly published (fixed values).
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-long": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-long": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-long": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "BSD-long": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
}
_WORDS = re.compile(r"\w+").findall
#: Multipliers of the bands, odd, from the hash of their number.
MULTIPLIERS = np.array([xxhash.xxh64_intdigest(b"band", i) | 1 for i in range(BANDS)], np.uint64)
_POWERS = np.array([pow(0x9E3779B97F4A7C15, j, 1 << 64) for j in range(SHINGLE)], np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """The hash of every run of five lower-case words (of all, if fewer), in order."""
    words = _WORDS((text or "").lower())
    if not words:
        return np.zeros(0, np.uint64)
    known = worker_store("license words")
    if len(known) > REMEMBERED:
        known.clear()
    for w in set(words).difference(known):
        known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - SHINGLE + 1)
    out = np.zeros(n, np.uint64)
    for j in range(min(SHINGLE, len(words))):
        out += hashes[j:j + n] * _POWERS[j]
    return out ^ out >> np.uint64(29)


class Templates:
    """Templates by how many shingles they have, rounded up to a power of two, with the minima of their bands."""

    def __init__(self, templates: Mapping[str, str]):
        self.names, self.sets, self.sizes = list(templates), [], {}
        for i, text in enumerate(templates.values()):
            self.sets.append(np.unique(shingles(text)))
            if len(self.sets[-1]):
                self.sizes.setdefault(1 << (len(self.sets[-1]) - 1).bit_length(), []).append(i)
        self.minima = {size: np.array([[(self.sets[i] * m).min() for m in MULTIPLIERS] for i in members])
                       for size, members in self.sizes.items()}

    def windows(self, size: int) -> tuple[int, int]:
        """Shingles from one window to the next, and in a window: any run of ``size`` lies inside one."""
        step = max(FINEST, size // 4)
        return step, -(-(size + step - 1) // step) * step

    def candidates(self, grams: np.ndarray, start: int) -> Iterator[tuple[int, int]]:
        """(template, first shingle) of the windows that begin in a slice and agree with a template in some band.

        The minima of the finest blocks are taken once; wider blocks and windows are minima of these.
        """
        reach = max(map(sum, map(self.windows, self.sizes)))
        count = min(len(grams) - start, SLICE)
        part = grams[start:start + SLICE + reach]
        part = np.concatenate([part, np.full(-len(part) % FINEST, part[-1])])
        low = part[None, ::FINEST] * MULTIPLIERS[:, None]
        for j in range(1, FINEST):
            np.minimum(low, part[None, j::FINEST] * MULTIPLIERS[:, None], out=low)
        wide = FINEST
        for size, members in sorted(self.sizes.items()):
            step, width = self.windows(size)
            while wide < step:
                low = np.concatenate([low, low[:, -1:]], 1) if low.shape[1] % 2 else low
                low, wide = np.minimum(low[:, ::2], low[:, 1::2]), 2 * wide
            window = low
            for j in range(1, width // step):
                window = window.copy() if j == 1 else window
                np.minimum(window[:, :-j], low[:, j:], out=window[:, :-j])
            minima, begins = self.minima[size], -(-count // step)
            for k, member in enumerate(members):
                agrees = (window[:, :begins] == minima[k][:, None]).any(0)
                if agrees.any():
                    yield from ((member, start + int(w) * step) for w in np.flatnonzero(agrees))

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(template, containment, first shingle, last shingle) of every template that the text holds."""
        grams = shingles(text)
        found: dict[int, tuple[float, int, int]] = {}
        hits = {hit for a in range(0, len(grams), SLICE) for hit in self.candidates(grams, a)} if self.sizes else set()
        if hits:
            for member, w in sorted(hits):
                wanted, size = self.sets[member], 1 << (len(self.sets[member]) - 1).bit_length()
                width = self.windows(size)[1]
                a, b = max(0, w - size), min(len(grams), w + width + size)
                at = a + np.flatnonzero(np.isin(grams[a:b], wanted))
                share = len(np.unique(grams[at])) / len(wanted)
                if share >= CONTAINMENT and share > found.get(member, (0,))[0]:
                    found[member] = (share, int(at[0]), int(at[-1]))
        return [(self.names[i], *found[i]) for i in sorted(found)]


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, license, containment, first_word, last_word: one row per document and template found in its text.

    A window of a text that holds four fifths of a template has a similarity of at least 0.24 to it; each of 32
    bands of one row then agrees with that probability, so some band does with 0.9998.  A template is reported if at least
    ``CONTAINMENT`` of its distinct shingles of five words occur around such a window; of several places the fullest,
    then the first.  Short templates (under five words) are one shingle.  Null and empty texts hold none; repeated
    rows are scanned each; a very long text is scanned window by window to its end; an empty table gives an empty result and
    other columns are ignored.  The templates are a small parameter and travel with the job.
    """
    known = Templates(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(d.as_py(), *hit[:3], hit[3] + SHINGLE - 1) for d, t in zip(*batch.columns) for hit in known.scan(t.as_py())]
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)],
                                             ["doc_id", "license", "containment", "first_word", "last_word"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, license string, containment double, first_word long, last_word long")
