"""The trees and their threshold come from every labelled candidate."""

from __future__ import annotations

import inspect

import numpy as np
from pyspark.sql import functions as F

from answercheck.llm import pii
from tests.llm.test_operators import frame


def documents(spark, n):
    """``n`` assigned secrets and ``n`` long tokens in prose, one of each a document."""
    letters = F.translate(F.sha2(F.col("id").cast("string"), 256), "0123456789", "ghijklmnop")
    token = F.concat(F.lit("t7k"), letters)
    return spark.range(n).select(F.concat(
        F.lit("then password = "), token, F.lit(" was set, but plain words about "), F.reverse(token), F.lit(" follow")).alias("text"))


def test_pii_every_labelled_candidate_is_trained_on(spark):
    n = 10_700
    rows = {r["y"]: r["count"] for r in pii.labelled(documents(spark, n)).groupBy("y").count().collect()}
    assert rows == {0: n, 1: n}
    assert "sample_rows" not in inspect.signature(pii.train).parameters


def test_pii_copies_of_a_passage_count_once(spark):
    docs = documents(spark, 7)
    assert pii.labelled(docs.union(docs)).count() == 14


def test_pii_threshold_is_the_least_that_is_precise_over_all_rows(spark):
    trees = pii.Trees([([(0, 0.0, 1, 2, 0.0), (-1, 0.0, -1, -1, -1.0), (-1, 0.0, -1, -1, 1.0)], 1.0)], 2.0)
    x = np.zeros(len(pii.FEATURES))
    low, high = [float(v) for v in x], [1.0] + [float(v) for v in x[1:]]
    rows = [(1, high)] * 98 + [(0, high)] * 2 + [(0, low)] * 50 + [(1, low)] * 5
    schema = "y int, x array<double>"
    assert pii.calibrated(frame(spark, rows, schema), trees, 0.98) == 0.5
    assert pii.calibrated(frame(spark, rows, schema), trees, 0.981) == 2.0
    assert pii.calibrated(frame(spark, rows[100:], schema), trees, 0.5) == 2.0
