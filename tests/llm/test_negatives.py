"""Hard negatives against Python's integers."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from answercheck.llm import negatives
from answercheck.llm.common import Scratch

SCHEMA = "vec_id long, embedding array<double>, label int"


def force(rows, positives=5, k=5, low=80, high=100):
    ok = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ok.setdefault(i, []).append((label, [math.floor(256 * x) for x in v]))
    out = []
    for a, own in ok.items():
        if a % 100:
            continue
        label, u = max((lab, v) for lab, v in own)
        scores = {}
        for i, others in ok.items():
            for other, v in others:
                if i != a and len(v) == len(u):
                    key = i, other == label
                    score = sum(x * y for x, y in zip(u, v))
                    scores[key] = max(score, scores.get(key, score))
        order = sorted(((-s, i) for (i, same), s in scores.items() if same))[:positives]
        for s, p in order:
            inside = sorted((-n, i) for (i, same), n in scores.items() if not same and low * -s <= 100 * n <= high * -s)
            out += [(a, p, rank, i, -s, -n) for rank, (n, i) in enumerate(inside[:k], 1)]
    return sorted(out)


def got(spark, rows, schema=SCHEMA, **options):
    found = negatives.mine(spark.createDataFrame(rows, schema), F.col("vec_id") % 100 == 0, Scratch(spark, "t"), **options)
    return sorted(tuple(r) for r in found.collect())


def vectors(seed, n, dim, scale=1.0, round_to=None):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(3, dim))
    out = []
    for i in range(n):
        v = scale * (centres[i % 3] + 0.4 * r.normal(size=dim))
        out.append((i, (v if round_to is None else np.round(v, round_to)).tolist(), int(r.integers(0, 4))))
    return out


@pytest.mark.parametrize("dim", [1, 3, 33, 64, 70])
def test_negatives_equal_brute_force(spark, dim):
    rows = vectors(dim, 420, dim)
    assert got(spark, rows) == force(rows)


def test_negatives_do_not_depend_on_how_rows_are_dealt(spark):
    """Many groups and stripes; rounded components make ties frequent."""
    rows = vectors(8, 500, 6, round_to=0)
    want = force(rows)
    assert want and got(spark, rows, side_rows=70) == want
    random.Random(1).shuffle(rows)
    assert got(spark, rows, side_rows=2) == want


def test_negatives_edges(spark):
    rows = vectors(9, 120, 4, round_to=1)
    rows += [(200, None, 1), (201, [1.0, None, 1.0, 1.0], 1), (202, [float("nan")] * 4, 1), (203, [float("inf")] * 4, 1),
             (204, [0.0] * 4, None), (None, [1.0] * 4, 1), (300, [], 1), (301, [], 1), (302, [], 2), (400, [2.0, 1.0], 3),
             (401, [1.0, 1.0], 3), (402, [1.0, 0.9], 2), (500, [0.0] * 4, 2), (-100, [0.5, 0.5, 0.5, 0.5], 0),
             (600, [9.0, 9.0, 9.0], 7), rows[3], rows[3], (5, [3.0, 3.0, 3.0, 3.0], 2), (100, [1.0, -1.0, 2.0, 0.5], 1)]
    assert got(spark, rows) == force(rows)


def test_negatives_of_empty_and_wider_tables(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, [1.0], 1)]) == []
    rows = vectors(4, 210, 5)
    wide = [(*r, "x", 1, 2.0) for r in rows]
    assert got(spark, wide, SCHEMA + ", id string, stripe int, v double") == force(rows)
    floats = spark.createDataFrame(rows, SCHEMA).withColumn("embedding", F.col("embedding").cast("array<float>"))
    single = [(i, np.array(v, np.float32).astype(float).tolist(), lab) for i, v, lab in rows]
    found = negatives.mine(floats, F.col("vec_id") % 100 == 0, Scratch(spark, "t"))
    assert sorted(tuple(r) for r in found.collect()) == force(single)


def test_scores_beyond_double_precision_are_exact(spark):
    rows = vectors(11, 210, 8, scale=2.0 ** 21)
    want = force(rows)
    assert max(abs(r[4]) for r in want) > 1 << 53
    assert got(spark, rows) == want


def test_scores_that_fit_no_long_fail(spark):
    with pytest.raises(Exception, match="does not fit a long"):
        got(spark, [(0, [1e12, 1.0], 1), (1, [1e12, 1.0], 1), (2, [1e300, 1.0], 2)])


@pytest.mark.parametrize("n, k, m, leaf", [(1, 1, 1, 1), (5, 7, 9, 1), (33, 65, 17, 4), (64, 64, 64, 8), (40, 3, 200, 2)])
def test_strassen_equals_the_plain_product(n, k, m, leaf):
    r = np.random.default_rng(n * k)
    a, b = r.integers(-1 << 40, 1 << 40, (n, k)), r.integers(-1 << 10, 1 << 10, (k, m))
    want = a.astype(object) @ b.astype(object)
    assert (negatives.strassen(a, b, leaf).astype(object) == want).all()
    assert (negatives.product(a, b.T, leaf).astype(object) == want).all()
    # Sums that wrap on the way leave what fits intact.
    big = np.array([[1 << 61, 1], [1 << 61, 2]], np.int64)
    assert (negatives.strassen(big, np.array([[1, 0], [0, 1]], np.int64), 1) == big).all()
