"""Candidates of any length, and short values after a secret's name."""

from __future__ import annotations

import random
import string
import time

import pytest

from answercheck.llm import pii
from tests.llm.test_operators import frame, prose


def found(text, value):
    at = text.index(value)
    return {k for k, s, e in pii.candidates(text) if (s, e) == (at, at + len(value))}


@pytest.mark.parametrize("kind, before, value, after", [
    ("secret", "key ", "aB3" * 600, " end"),
    ("secret", "the password = ", "hunter", " and more"),
    ("secret", "secret: '", "open the door", "' end"),
    ("secret", '{"api_key": "', "xyzzy", '"}'),
    ("secret", "token=", "abcdefghijklmnopqrstuvwx", ""),
    ("number", "account ", "1234 " * 12 + "1234", " end"),
    ("contact", "write to ", "a.b" * 40 + " (at) example.org", " now"),
    ("contact", "write to ", "a.b (at) " + "sub." * 40 + "org", " now"),
])
def test_pii_candidates_have_no_length_limit(kind, before, value, after):
    assert kind in found(before + value + after, value)


def test_pii_candidates_are_linear_in_long_runs_after_names():
    for unit in ("password=", "token:'", "secret \"", "a.", "A1", "key = ", "passwd:\n"):
        start = time.perf_counter()
        for kind, s, e in pii.candidates(unit * 40_000)[:50]:
            pii.features(unit * 40_000, kind, s, e)
        assert time.perf_counter() - start < 20


def test_pii_short_and_long_secrets_reach_the_trees_and_the_text(spark):
    r = random.Random(5)
    seen = [f"{' '.join(prose(9, i))} password = {''.join(r.choices(string.ascii_lowercase, k=r.randint(5, 12)))} "
            f"{' '.join(prose(9, 900 + i))}" for i in range(300)]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").union(
        frame(spark, [(t,) for t in seen], "text string"))
    long_key, plain = "q7Rt2Kx9" * 100, "plain words that say nothing of the kind"
    rows = [(1, "then the password = hunter was set"), (2, f"then api_key = {long_key} here"), (3, plain)]
    out = {x["doc_id"]: x["redacted"] for x in pii.detect(frame(spark, rows), ["doc_id"], pii.train(docs)).collect()}
    assert out == {1: "then the password = [SECRET] was set", 2: "then api_key = [SECRET] here", 3: plain}
