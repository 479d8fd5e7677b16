"""Rows that repeat a doc_id with different texts, in every order of the rows."""

from __future__ import annotations

import itertools
import random

from answercheck.llm import minhash
from answercheck.llm.common import Scratch, union_find


def prose(seed, n=120):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n)]


def near(words, at):
    return [*words[:at], "changed", *words[at + 1:]]


def classes(spark, rows):
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark, "t")).collect()
    assert len(found) == len(rows)
    return {r["doc_id"]: r["component_id"] for r in found}


def test_both_texts_of_a_repeated_id_find_their_near_copies(spark):
    a, b = prose(1), prose(2)
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join(near(a, 60))), (3, " ".join(near(b, 30)))]
    for order in list(itertools.permutations(rows))[::5]:
        assert classes(spark, list(order)) == {1: 1, 2: 1, 3: 1}


def test_repeated_ids_equal_brute_force(spark):
    r = random.Random(6)
    bases = [prose(10 + i, r.randint(20, 90)) for i in range(8)]
    rows = []
    for i in range(60):
        words = list(r.choice(bases))
        if r.random() < 0.6:
            words = near(words, r.randrange(len(words)))
        rows.append((r.randint(0, 25), " ".join(words)))
    rows += rows[:6]
    bags = [minhash.bag(t) for _, t in rows]
    pairs = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2)
             if rows[i][0] == rows[j][0] or minhash.weighted_jaccard(bags[i], bags[j]) >= 0.8]
    part = union_find(pairs)
    least: dict[int, int] = {}
    for i, (doc, _) in enumerate(rows):
        c = part.get(i, i)
        least[c] = min(doc, least.get(c, doc))
    assert classes(spark, rows) == {doc: least[part.get(i, i)] for i, (doc, _) in enumerate(rows)}
