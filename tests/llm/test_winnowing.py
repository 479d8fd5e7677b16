"""Decontamination against a word-by-word version."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from answercheck.llm import winnowing
from answercheck.llm.common import Scratch

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def force(docs, items, window=10):
    wanted = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wanted.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, held = words(text), set(), set()
        for n in {len(x) for x in wanted}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in wanted:
                    hit |= set(range(i, i + n))
                    held |= wanted[tuple(w[i:i + n])] - {None}
        digest = hashlib.sha256(",".join(sorted(map(str, held))).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(held), digest, bool(hit)))
    return sorted(out, key=repr)


def got(spark, docs, items, **options):
    found, spans = winnowing.decontaminate(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS),
                                           Scratch(spark, "t"), **options)
    rows = sorted((tuple(r) for r in found.collect()), key=repr)
    assert sum(r["end_word"] - r["first_word"] for r in spans.collect()) == sum(r[2] for r in rows)
    return rows


@pytest.mark.parametrize("seed, bits", [(1, 1 << 24), (2, 64), (3, 1 << 12)])
def test_winnowing_equals_word_by_word_version(spark, seed, bits):
    """Few different words, so that windows overlap, touch and repeat; with 64 bits the
    filter lets nearly everything through to the join."""
    r = random.Random(seed)
    vocabulary = ["a", "B", "c1", "Dé", "é", "日本"]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(1, 16)))) for i in range(12)]
    items += [(3, items[0][1]), (None, "a B c1 Dé"), (40, items[1][1])]
    docs = []
    for i in range(60):
        text = [r.choice(vocabulary) for _ in range(r.randint(0, 60))]
        for _ in range(r.randint(0, 2)):
            text += r.choice(items)[1].upper().split() + [r.choice(vocabulary)]
        docs.append((i, r.choice([" ", ", ", "\n", "--"]).join(text)))
    assert got(spark, docs, items, filter_bits=bits) == force(docs, items)


def test_winnowing_edges(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    items = [(1, passage), (2, None), (3, ""), (4, "...!"), (5, "alpha beta"), (None, "gamma delta"), (6, "w3 w4 " * 8),
             (7, passage), (8, "one two three four five six seven eight nine ten")]
    docs = [(1, None), (2, ""), (3, " .\n"), (4, passage), (4, passage), (None, passage), (5, passage.upper()),
            (6, "ALPHA-beta"), (7, "gamma delta alpha"), (8, "x " * 30_000 + passage + " y" * 30_000), (9, "alpha"),
            (10, " ".join(f"w{i}" for i in range(9))), (11, " ".join(f"w{i}" for i in range(10))),
            (12, "w3 w4 " * 400), (13, "one two three four five"), (14, "six seven eight nine ten"),
            (15, "ſ K " + passage), (16, "w" * 200_000)]
    assert got(spark, docs, items) == force(docs, items)


def test_a_run_of_two_neighbouring_texts_is_no_hit(spark):
    items = [(1, "one two three four five six seven eight nine ten"), (2, "left right")]
    docs = [(1, "one two three four five"), (2, "six seven eight nine ten"), (3, "left"), (4, "right")]
    assert all(not r[5] for r in got(spark, docs, items))


def test_winnowing_of_empty_tables_and_clashing_columns(spark):
    docs, items = [(1, "a b c")], [(1, "a b c")]
    assert got(spark, [], items) == []
    assert got(spark, docs, []) == force(docs, [])
    found, _ = winnowing.decontaminate(
        spark.createDataFrame([(1, "a b c", "x", 2)], "doc_id long, text string, run string, item_id int"),
        spark.createDataFrame([(1, "a b c", 5)], "item_id long, text string, doc_id int"), Scratch(spark, "t"))
    assert [tuple(r)[:4] for r in found.collect()] == [(1, 3, 3, 1)]


def test_a_passage_that_most_documents_hold_is_dealt_by_salt(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    docs = [(i, f"d{i} {passage} e{i % 3}") for i in range(300)]
    items = [(i, f"{passage} q{i}") for i in range(30)]
    assert got(spark, docs, items, salts=4) == force(docs, items)


def test_the_kept_gram_depends_on_the_run_alone():
    """The guarantee: equal runs of ten words keep the same gram wherever they stand."""
    r = np.random.default_rng(5)
    shared = r.integers(0, 1 << 60, 10).astype(np.uint64)
    for left, right in [(0, 7), (5, 0), (13, 4)]:
        around = [r.integers(0, 1 << 60, n).astype(np.uint64) for n in (left, right)]
        text = np.concatenate([around[0], shared, around[1]])
        assert winnowing.winnow(text, 10, 4)[left] == winnowing.winnow(shared, 10, 4)[0]
        assert winnowing.winnow(text, 10, 4)[left] in winnowing.grams(shared, 4)
