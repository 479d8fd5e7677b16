"""Which shards of a bucket are merged."""

from __future__ import annotations

import random

import numpy as np

from answercheck.llm import bwt


def by_force(bodies, docs):
    least = {}
    for body, doc in zip(bodies, docs):
        for k in range(len(body) - 49):
            least[body[k:k + 50]] = min(doc, least.get(body[k:k + 50], doc))
    out = {}
    for i, (body, doc) in enumerate(zip(bodies, docs)):
        gone = [k for k in range(len(body) - 49) if least[body[k:k + 50]] < doc]
        if gone:
            edges = [x for k in gone for x in [k] * (k - 1 not in gone) + [k + 1] * (k + 1 not in gone)]
            out[i] = edges
    return out


def strings_of(anchors, each, seed=3):
    r = random.Random(seed)
    bodies, docs, keys = [], [], []
    for a in range(anchors):
        core = bytes(r.choice(b"abcdefgh ") for _ in range(70)) + bytes([a + 1] * 4)
        for _ in range(each):
            bodies.append(core[r.randint(0, 20):] + bytes(r.choice(b"xyz") for _ in range(r.randint(0, 30))))
            docs.append(r.randint(0, 9))
            keys.append(a)
    return bodies, np.array(docs, np.int64), keys


def test_only_shards_that_an_anchor_spans_are_merged(monkeypatch):
    merged = []

    def watched(shards, depth, original=bwt.merge):
        merged.append(len(shards))
        return original(shards, depth)

    monkeypatch.setattr(bwt, "merge", watched)
    bodies, docs, keys = strings_of(anchors=12, each=8)
    assert bwt.repeats(bodies, docs, keys, shard=1500) == by_force(bodies, docs)
    assert len(merged) > 3 and set(merged) == {1}   # every anchor fits a shard
    merged.clear()
    assert bwt.repeats(bodies, docs, keys, shard=200) == by_force(bodies, docs)
    assert len(merged) == 12 and min(merged) > 1    # none does


def test_a_pass_steps_over_several_bytes():
    text = np.frombuffer(b"the words of a text, all of them\xff" * 3000, np.uint8)
    gram, width = bwt.grams(text, 50)
    assert width >= 3
    circle = text.tobytes() + text.tobytes()[:width]
    at = [0, 7, 31, 32, 33, len(text) - 1]
    strings = [circle[i:i + width] for i in at]
    assert all((gram[a] < gram[b]) == (x < y) for a, x in zip(at, strings) for b, y in zip(at, strings))
