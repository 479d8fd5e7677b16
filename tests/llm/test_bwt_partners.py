"""Which strings of a bucket get a place in the order."""

from __future__ import annotations

import random

import numpy as np

from answercheck.llm import bwt
from tests.llm.test_bwt_merges import by_force, strings_of


def test_strings_without_a_partner_are_not_ordered(monkeypatch):
    ordered = []

    def watched(shards, docs, length, original=bwt.merged_repeats):
        ordered.extend(body for s in shards for body in s)
        return original(shards, docs, length)

    monkeypatch.setattr(bwt, "merged_repeats", watched)
    r = random.Random(5)
    bodies, docs, keys = strings_of(anchors=6, each=5)
    alone = [bytes(r.choice(b"abcdefgh ") for _ in range(90)) for _ in range(40)] + [b"", b"short"]
    at = sorted(range(len(bodies) + len(alone)), key=lambda i: keys[i] if i < len(bodies) else i % 6)
    bodies = [(bodies + alone)[i] for i in at]
    docs = np.append(docs, np.arange(len(alone)) % 10)[at]
    keys = [keys[i] if i < len(keys) else i % 6 for i in at]
    for shard in (200, 1500, 1 << 18):
        ordered.clear()
        assert bwt.repeats(bodies, docs, keys, shard=shard) == by_force(bodies, docs)
        assert ordered and not set(alone) & set(ordered)
    assert bwt.repeats([b"x", b""], np.array([1, 2]), [1, 1]) == {}


def test_union_of_spans():
    spans = [(5, 9), (0, 3), (3, 4), (7, 8), (20, 30), (9, 12)]
    assert bwt.union(*np.array(spans).T) == [(0, 4), (5, 12), (20, 30)]
    assert bwt.remove(bytes(range(32)), [(0, 4), (5, 12), (20, 30)]) == bwt.remove(bytes(range(32)), spans)
