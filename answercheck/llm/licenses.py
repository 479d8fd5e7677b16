"""License scans: MinHash bands retrieve templates, exact containment verifies.

Words are compared in lower case and without marks. Templates are held as sets
of five-word shingles (a shorter one is a single shingle). A text is cut into overlapping
windows, for each class of template sizes windows 1.25 to 2.5 times as long that start
every quarter of a window: a template in the text, four fifths of it intact, has with
some window a Jaccard similarity of 0.3 or more. With ``bands`` = 32 bands of one MinHash
value such a window shares a band with probability 1 - 0.7^32 = 0.99999. Windows run
over many texts at a time; one that spans two texts only retrieves. A retrieved template is then verified on the whole text: a stretch of at most twice its length must hold
``containment`` of its shingles or more.

Templates are a parameter of bounded size (``MAX_TEMPLATES``) and are sent to all tasks;
texts are scanned where they are read, without a shuffle.

Defined cases: a null text is empty and holds no license; whole texts are scanned; rows
are judged each on its own, so nulls, ties and repeated rows need no rule; an empty table
gives an empty result; carried columns that clash with result columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, hashed_words, mix, shingle_hashes, texts

WORDS, CONTAINMENT = 5, 0.8
BANDS = 32
MAX_TEMPLATES = 4096
MARKS = b".,;:!?\"'()[]{}<>*#$%&|/\\-_=+~`"
# Shingles scanned at once.
BLOCK = 1 << 15

# Usual short notices by license.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License "
                   "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("all-rights-reserved", "All rights reserved. No part of this publication may be reproduced"),
)

_SEEDS = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
_LOW = np.uint32(0xFFFF)


def plain(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace").translate(None, MARKS)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Hashes of the word shingles of a text, in order."""
    return shingle_hashes(hashed_words([plain(text)])[0], words)


class Index:
    """Templates by size class, with the MinHash values of each.

    ``scan`` returns (template number, first shingle, last shingle) of each verified hit."""

    def __init__(self, templates, words=WORDS, bands=BANDS, containment=CONTAINMENT):
        if len(templates) > MAX_TEMPLATES:
            raise ValueError(f"{len(templates)} templates; at most {MAX_TEMPLATES}")
        self.words, self.bands, self.containment = words, bands, containment
        self.sets = [np.unique(shingles(t, words)) for _, t in templates]
        self.lengths = [len(shingles(t, words)) for _, t in templates]
        self.sizes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        by_class: dict[int, list[int]] = {}
        for i, n in enumerate(self.lengths):
            if n:
                by_class.setdefault(self._window(n), []).append(i)
        for window, members in by_class.items():
            minima = np.stack([self._hashed(self.sets[i]).min(axis=1) for i in members])
            keys = self._keys(minima.T).T.ravel()
            owners = np.repeat(members, self.bands)
            order = np.argsort(keys, kind="stable")
            some = np.zeros((self.bands, 1 << 16), bool)  # low halves of the values of each band
            some[np.arange(self.bands), minima & _LOW] = True
            self.sizes[window] = (some, keys[order], owners[order])

    @staticmethod
    def _window(n: int) -> int:
        """Window of a template of n shingles: the power of two over 1.25 n (1 stays 1)."""
        return 1 if n == 1 else 1 << int(np.ceil(np.log2(1.25 * n)))

    def _hashed(self, s: np.ndarray, bands: int | None = None) -> np.ndarray:
        """One row of 32-bit hash values per band."""
        return ((s[None, :] * _SEEDS[:bands or self.bands, None]) >> np.uint64(32)).astype(np.uint32)

    @staticmethod
    def _keys(minima: np.ndarray) -> np.ndarray:
        """A band's number and value in one (bands x windows)."""
        return (np.arange(len(minima), dtype=np.uint64)[:, None] << np.uint64(32)) | minima

    def retrieve(self, s: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, first, past last) of the windows of ``s`` that share a band with it."""
        found: set[tuple[int, int, int]] = set()
        pieces, size = self._hashed(s, 1 if set(self.sizes) == {1} else None), 1
        for window, (some, keys, owners) in sorted(self.sizes.items()):
            step = max(1, window // 4)
            while size < step:  # minima of pieces twice as long
                if pieces.shape[1] % 2:
                    pieces = np.concatenate([pieces, pieces[:, -1:]], axis=1)
                pieces = np.minimum(pieces[:, 0::2], pieces[:, 1::2])
                size *= 2
            if window == 1:  # single shingles agree in all bands or in none: one tells
                minima = pieces[:1]
            else:  # a window is four pieces; the last ones are shorter
                minima = pieces.copy()
                np.minimum(minima[:, :-1], pieces[:, 1:], out=minima[:, :-1])
                np.minimum(minima[:, :-2], minima[:, 2:].copy(), out=minima[:, :-2])
            maybe = np.stack([some[i][m & _LOW] for i, m in enumerate(minima)])
            band, at = np.nonzero(maybe)
            probe = (band.astype(np.uint64) << np.uint64(32)) | minima[band, at]
            lo, hi = np.searchsorted(keys, probe), np.searchsorted(keys, probe, side="right")
            for a, b, w in zip(lo.tolist(), hi.tolist(), at.tolist()):
                found.update((int(i), w * step, w * step + window) for i in owners[a:b])
        return sorted(found)

    def verify(self, s: np.ndarray, i: int) -> list[tuple[int, int, int]]:
        """Exact containment of template ``i`` in stretches of the shingles ``s``: found
        shingles that lie within twice the template's length of each other's first."""
        at = np.flatnonzero(np.isin(s, self.sets[i]))
        out, start = [], 0
        need = self.containment * len(self.sets[i])
        while start < len(at):
            stop = int(np.searchsorted(at, at[start] + 2 * self.lengths[i]))
            if len(np.unique(s[at[start:stop]])) >= need:
                # the shortest stretch from here that holds enough
                while stop - 1 > start and len(np.unique(s[at[start:stop - 1]])) == len(np.unique(s[at[start:stop]])):
                    stop -= 1
                out.append((i, int(at[start]), int(at[stop - 1])))
                start = stop
            else:
                start += 1
        return out

    def scan(self, batch: list[str]) -> list[list[tuple[int, int, int]]]:
        """Verified hits of each text."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in batch]
        if not self.sizes:
            return out
        flat, sizes = hashed_words([plain(t) for t in batch])
        many = np.where(sizes >= self.words, sizes - self.words + 1, np.minimum(sizes, 1))
        begin, first = np.cumsum(sizes) - sizes, np.cumsum(many) - many
        runs = shingle_hashes(flat, self.words)
        s = np.empty(int(many.sum()), np.uint64)
        for i in np.flatnonzero(many).tolist():
            short = sizes[i] < self.words
            s[first[i]:first[i] + many[i]] = (shingle_hashes(flat[begin[i]:begin[i] + sizes[i]], self.words) if short
                                              else runs[begin[i]:begin[i] + many[i]])
        wanted: set[tuple[int, int]] = set()
        longest = max(self.sizes)
        for at in range(0, len(s), BLOCK):
            # Blocks overlap by a window, so that each window lies whole in one of them.
            for i, a, b in self.retrieve(s[at:at + BLOCK + longest]):
                texts_hit = np.searchsorted(first, [at + a, min(at + b, len(s)) - 1], side="right") - 1
                wanted.update((t, i) for t in range(texts_hit[0], texts_hit[1] + 1))
        for t, i in sorted(wanted):
            out[t] += self.verify(s[first[t]:first[t] + many[t]], i)
        return out


def scan(docs: DataFrame, carry: list[str], templates=TEMPLATES, *, words: int = WORDS, bands: int = BANDS,
         containment: float = CONTAINMENT) -> DataFrame:
    """``carry`` columns of each row of ``docs`` (text) with n_matches, licenses (distinct
    names, sorted, comma-joined) and matches (name:first:last by shingle number)."""
    index = Index(templates, words, bands, containment)
    names = [n for n, _ in templates]
    sent = docs.sparkSession.sparkContext.broadcast((index, names))
    result = ("n_matches", "licenses", "matches")
    carry = [c for c in carry if c not in result and c != "_text"]
    kept = docs.select(*[F.col(f"`{c}`") for c in carry], F.col("text").alias("_text"))
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]),
                     "n_matches long, licenses string, matches string"])

    def run(batches):
        idx, name = sent.value
        for batch in batches:
            n, found, where = [], [], []
            for block in blocks(texts(batch.column("_text")), 1 << 20):
                for hits in idx.scan(block):
                    named = sorted((a, b, name[i]) for i, a, b in hits)
                    n.append(len(named))
                    found.append(",".join(sorted({h[2] for h in named})))
                    where.append(",".join(f"{c}:{a}:{b}" for a, b, c in named))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry), pa.array(n, pa.int64()), pa.array(found, pa.string()),
                 pa.array(where, pa.string())], names=[*carry, *result])

    return kept.mapInArrow(run, ddl)
