"""License scan: MinHash bands over overlapping text windows.

Texts and templates are sequences of five-word shingles.  A template of m
shingles belongs to the class of the smallest power of two L >= m (at least 8);
texts are cut into windows of 2L shingles that start at every multiple of L, so
each run of up to L shingles lies whole in some window.  A window is retrieved
for a template if any of its minhashes (bands of one row) equals the template's.
The number of bands makes a window that holds ``CONTAINMENT`` of a template
collide with probability ``RECALL`` at least, whatever else it holds.  Each
retrieved window is verified by the exact share of the template's shingles that
it contains.

Result: one row per document and license: doc_id, license, containment (the
best window's), first_word and last_word of the earliest best window's matching
shingles.  Defined results: null texts and texts without words match nothing; a
text of one to four words is one shingle; repeated rows give repeated results;
an empty table gives no rows."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from acctpulse.llm.common import SHINGLE_WORDS, mix, text_chunks, window_hashes, word_hashes

CONTAINMENT = 0.8
RECALL = 0.999
SMALLEST = 8

#: The texts that are looked for.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def _shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in order, and where each text's begin and end."""
    words, doc = word_hashes(data, offsets)
    n = len(offsets) - 1
    at = np.searchsorted(doc, np.arange(n + 1))
    size = np.diff(at)
    count = np.where(size >= SHINGLE_WORDS, size - SHINGLE_WORDS + 1, np.minimum(size, 1))
    cut = np.concatenate(([0], np.cumsum(count)))
    grams = window_hashes(words, SHINGLE_WORDS)
    own = np.repeat(at[:-1], count) + np.arange(cut[-1]) - np.repeat(cut[:-1], count)
    out = np.zeros(cut[-1], np.uint64)
    whole = np.repeat(size >= SHINGLE_WORDS, count)
    out[whole] = grams[own[whole]]
    for d in np.flatnonzero((size > 0) & (size < SHINGLE_WORDS)):
        out[cut[d]] = window_hashes(words[at[d] : at[d + 1]], size[d])[0]
    return out, cut


class Scanner:
    def __init__(self, templates: dict[str, str] = TEMPLATES):
        self.names = list(templates)
        self.sets, self.classes = [], {}
        for i, text in enumerate(templates.values()):
            for _, data, offsets in text_chunks(pa.array([text])):
                grams = np.unique(_shingles(data, offsets)[0])
            self.sets.append(grams)
            size = max(SMALLEST, 1 << (len(grams) - 1).bit_length()) if len(grams) else SMALLEST
            if len(grams):
                self.classes.setdefault(size, []).append(i)
        self.bands = max((self._bands(size, len(self.sets[i])) for size, own in self.classes.items() for i in own), default=1)
        self.factors = mix(np.arange(1, self.bands + 1, dtype=np.uint64)) | np.uint64(1)
        self.marks = [np.array([(grams * f).min() if len(grams) else 0 for f in self.factors], np.uint64) for grams in self.sets]

    @staticmethod
    def _bands(size: int, grams: int) -> int:
        """Bands for a window of 2 * size shingles that holds the least accepted share."""
        held = math.ceil(CONTAINMENT * grams)
        similarity = held / (2 * size + grams - held)
        return math.ceil(math.log(1 - RECALL) / math.log(1 - min(similarity, 0.999)))

    def windows(self, cut: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, begin and end of all windows of 2 * size shingles."""
        count = np.diff(cut)
        n = np.where(count > 0, np.maximum(-(-count // size) - 1, 1), 0)
        doc = np.repeat(np.arange(len(n)), n)
        begin = cut[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * size
        return doc, begin, np.minimum(begin + 2 * size, cut[doc + 1])

    def candidates(self, grams: np.ndarray, cut: np.ndarray) -> dict[int, set[tuple[int, int]]]:
        """By class: the (window, template) pairs that agree in some band."""
        found: dict[int, set[tuple[int, int]]] = {size: set() for size in self.classes}
        if not len(grams):
            return found
        # minima of blocks of SMALLEST shingles; larger windows take minima of these
        count = np.diff(cut)
        blocks = -(-count // SMALLEST)
        first_block = np.concatenate(([0], np.cumsum(blocks)))
        doc = np.repeat(np.arange(len(blocks)), blocks)
        start = cut[doc] + (np.arange(len(doc)) - first_block[doc]) * SMALLEST
        spans = {}
        for size in self.classes:
            wdoc, begin, end = self.windows(cut, size)
            a = first_block[wdoc] + (begin - cut[wdoc]) // SMALLEST
            b = first_block[wdoc] + -(-(end - cut[wdoc]) // SMALLEST)
            spans[size] = np.stack([a, b], axis=1).reshape(-1)
        for j, factor in enumerate(self.factors):
            low = np.append(np.minimum.reduceat(grams * factor, start), np.uint64(2**64 - 1))
            for size, own in self.classes.items():
                least = np.minimum.reduceat(low, spans[size])[::2]
                marks = np.array([self.marks[i][j] for i in own])
                order = np.argsort(marks)
                at = np.minimum(np.searchsorted(marks[order], least), len(own) - 1)
                for w in np.flatnonzero(marks[order][at] == least):
                    found[size].update((int(w), i) for i, m in zip(own, marks) if m == least[w])
        return found

    def scan(self, data: np.ndarray, offsets: np.ndarray, exhaustive: bool = False) -> list[tuple[int, str, float, int, int]]:
        """(text, license, containment, first word, last word) of the best windows;
        ``exhaustive`` verifies every window instead of the retrieved ones."""
        grams, cut = _shingles(data, offsets)
        found = self.candidates(grams, cut) if not exhaustive else {}
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        for size, own in self.classes.items():
            doc, begin, end = self.windows(cut, size)
            pairs = ((w, i) for w in range(len(doc)) for i in own) if exhaustive else sorted(found[size])
            for w, i in pairs:
                own_grams = grams[begin[w] : end[w]]
                inside = np.flatnonzero(np.isin(own_grams, self.sets[i]))
                share = len(np.unique(own_grams[inside])) / len(self.sets[i])
                if share >= CONTAINMENT:
                    base = int(begin[w] - cut[doc[w]])
                    new = (share, -(base + int(inside[0])), base + int(inside[-1]) + SHINGLE_WORDS - 1)
                    key = (int(doc[w]), i)
                    if key not in best or new[:2] > best[key][:2]:
                        best[key] = new
        return [(d, self.names[i], share, -first, last) for (d, i), (share, first, last) in sorted(best.items())]


@lru_cache(1)
def _scanner() -> Scanner:
    return Scanner()


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, license, containment, first_word and last_word of all matches."""

    def run(batches):
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(1)):
                rows = _scanner().scan(data, offsets)
                if rows:
                    d, name, share, a, b = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([first + x for x in d])), pa.array(name), pa.array(share, pa.float64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                        names=["doc_id", "license", "containment", "first_word", "last_word"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, license string, containment double, first_word long, last_word long")
