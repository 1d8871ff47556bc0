"""Licence scan: MinHash bands over overlapping text windows retrieve
templates, and exact shingle containment verifies them.

Band settings, from each template's own shingles. A template of k shingles
may be spread over twice its words: that many shingle places, p (of one
shingle: its one place). The windows have p + step - 1 places and step by at
most a quarter of p, so one of them holds all of any such passage. A window of
v places that holds c of the k shingles has Jaccard s >= c / (k + v - c) with
the template, whatever its other shingles are. With one row a band and b bands
the pair is missed with probability (1 - s) ** b; b is taken such that at the
least c that counts this is at most ``most_missed``, for every template. Only
shingles that some template has are kept in a window, which lifts s further.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Hashes, binary_texts, chunks, mix64, shingle_hashes

# Notices that name a licence (template id, text).
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("bsd-grant", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                  "provided that the following conditions are met"),
    ("apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                          "except in compliance with the License."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("all-rights-reserved", "All rights reserved. No part of this publication may be reproduced"),
)

_EDGE = re.compile(rb"^[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+|[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+$")


class _WordHashes(Hashes):
    """Hash of a word without ASCII punctuation at its ends (0: nothing else in it)."""

    def __missing__(self, word):
        import xxhash
        bare = _EDGE.sub(b"", _EDGE.sub(b"", word))
        if len(self) >= self.most:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(bare) if bare else 0
        return h


def _words(text: bytes, hashes: _WordHashes) -> np.ndarray:
    """Hashes of the words that have more than punctuation."""
    w = text.lower().split()
    h = np.fromiter(map(hashes.__getitem__, w), np.uint64, len(w))
    return h


class Matcher:
    """The templates' shingle sets, grouped by shingle width and window, and their band tables."""

    def __init__(self, templates, width: int = 5, bands: int = 32, similarity: float = 0.8, most_missed: float = 2e-9):
        self.similarity = similarity
        hashes = _WordHashes()
        sizes, need = defaultdict(list), {}
        self.names, self.sets = [], []
        for name, text in templates:
            w = _words((text or "").encode(), hashes)
            w = w[w != 0]
            if not len(w):
                continue
            n, s = min(width, len(w)), np.unique(shingle_hashes(w, width))
            places = 1 if len(s) == 1 else 2 * len(w) - n + 1
            step = max(1, places // 4)
            span = places + step - 1
            least = max(1, math.ceil(similarity * len(s) - 1e-9))  # shingles that count as found
            jaccard = least / (len(s) + max(span, least) - least)
            if jaccard < 1:
                bands = max(bands, math.ceil(math.log(most_missed) / math.log1p(-jaccard)))
            sizes[n, step, span].append(len(self.names))
            self.names.append(name)
            self.sets.append(s)
        self.salts = mix64(np.arange(1, bands + 1))
        # (step, span, band minimum -> templates), by shingle width
        self.tables, self.known = defaultdict(list), {}
        for (n, step, span), members in sizes.items():
            table = defaultdict(set)
            for t in members:
                for key in self._bands(self.sets[t]):
                    table[key].add(t)
            self.tables[n].append((step, span, dict(table)))
        for n in self.tables:
            self.known[n] = np.unique(np.concatenate([self.sets[t] for size, members in sizes.items() if size[0] == n for t in members]))

    def _bands(self, shingles: np.ndarray) -> list[tuple[int, int]]:
        return list(enumerate(mix64(shingles ^ self.salts[:, None]).min(axis=1).tolist()))

    def scan(self, words: np.ndarray) -> list[tuple[str, int, int, float]]:
        """(template, first word, words, containment) of the best window of every template found."""
        best = {}
        for n, tables in self.tables.items():
            if len(words) < n:
                continue
            sh = shingle_hashes(words, n)
            # A window without one template shingle has Jaccard 0 with all of them and shares no band.
            at = np.flatnonzero(np.isin(sh, self.known[n]))
            if not len(at):
                continue
            for step, span, table in tables:
                back = np.arange(-(-span // step))
                starts = np.unique(np.maximum(at[:, None] // step - back, 0)) * step
                # Windows with the same shingles at the same places are looked at once.
                slices = np.unique(np.stack([np.searchsorted(at, starts), np.searchsorted(at, starts + span)], axis=1), axis=0)
                for a, z in slices.tolist():
                    if a == z:
                        continue
                    places = at[a:z]
                    window = np.unique(sh[places])
                    found = set().union(*(table.get(key, ()) for key in self._bands(window)))
                    for t in found:
                        share = np.isin(self.sets[t], window, assume_unique=True).mean()
                        if share >= self.similarity and (t not in best or share > best[t][2]):
                            first, last = _shortest(sh[places], places, self.sets[t])
                            best[t] = (first, last - first + n, float(share))
        return [(self.names[t], *x) for t, x in sorted(best.items())]


def _shortest(shingles: np.ndarray, places: np.ndarray, wanted: np.ndarray) -> tuple[int, int]:
    """First and last place of the shortest part that holds as many of the wanted shingles as all places do."""
    inside = np.isin(shingles, wanted)
    shingles, places = shingles[inside].tolist(), places[inside].tolist()
    most, have, a, best = len(set(shingles)), defaultdict(int), 0, None
    for s, last in zip(shingles, places):
        have[s] += 1
        while have[shingles[a]] > 1:
            have[shingles[a]] -= 1
            a += 1
        if len(have) == most and (best is None or last - places[a] < best[1] - best[0]):
            best = places[a], last
    return best


def scan_licenses(docs: DataFrame, templates, width: int = 5, bands: int = 32, similarity: float = 0.8, most_missed: float = 2e-9) -> DataFrame:
    """(doc_id, text) -> one row per document: doc_id, n_words, licenses
    (array of structs template, first_word, n_words, containment).

    Words are cut at ASCII white space, A-Z lower-cased, ASCII punctuation at
    their ends dropped; ``templates`` is a list of (name, text), part of the
    job's settings. A template is found where a passage of at most twice its
    words holds at least ``similarity`` of its distinct ``width``-word shingles
    (of a shorter template: its whole sequence); such a passage is missed with
    probability ``most_missed`` at most, for every template. ``bands`` is the
    least number of bands. Null and empty texts have no licence; the
    whole text is scanned; repeated rows give repeated rows.
    """
    matcher = Matcher(templates, width, bands, similarity, most_missed)
    found_type = pa.list_(pa.struct([("template", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("containment", pa.float64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("licenses", found_type)])

    def scan(batches):
        hashes = _WordHashes()
        for batch in batches:
            ids, texts = batch.column(0), binary_texts(batch.column(1))
            for a, z in chunks(texts):
                counts, found = [], []
                for text in texts[a:z]:
                    w = _words(text, hashes) if text else np.empty(0, np.uint64)
                    counts.append(len(w))
                    bare = np.flatnonzero(w)
                    hits = matcher.scan(w[bare])
                    found.append([{"template": t, "first_word": int(bare[i]), "n_words": int(bare[i + n - 1] - bare[i] + 1), "containment": c}
                                  for t, i, n, c in hits])
                yield pa.RecordBatch.from_arrays([ids.slice(a, z - a), pa.array(counts, pa.int64()), pa.array(found, found_type)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(
        scan, "doc_id long, n_words long, licenses array<struct<template: string, first_word: long, n_words: long, containment: double>>")


def op10(spark, sf_dir) -> DataFrame:
    from ..tables import read_table
    return scan_licenses(read_table(spark, sf_dir, "documents"), TEMPLATES)
