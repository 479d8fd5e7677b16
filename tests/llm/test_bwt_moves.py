"""What of the strings around shared anchors is moved."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from answercheck.llm import bwt
from answercheck.llm.common import packed, unpacked
from tests.llm.test_operators import frame, prose, removal_by_force, removed


def test_strings_are_moved_once_and_repeated_ones_without_their_bytes(spark, monkeypatch):
    passage = " ".join(prose(40, 77))
    rows = [(i, f"{i} " + " ".join(prose(8, 300 + i)) + " " + passage + f" {i}") for i in range(60)]
    given = []

    def watched(some, *args, original=bwt.bucket_repeats):
        out = original(some, *args)
        given.append((some.count(), some.agg(F.sum("n")).first()[0], out._jdf.queryExecution().executedPlan().toString().count("Exchange")))
        return out

    monkeypatch.setattr(bwt, "bucket_repeats", watched)
    assert removed(spark, frame(spark, rows).coalesce(1)) == removal_by_force(rows)
    (moved, held, exchanges), = given
    assert exchanges == 1 and moved < held / 2


def test_equal_strings_of_a_bucket_become_one_while_it_is_read(spark, monkeypatch):
    monkeypatch.setattr(bwt, "WAITING", 16)
    monkeypatch.setattr(bwt, "BLOCKS", 1)
    monkeypatch.setattr(bwt, "BUFFER", 1)   # no two texts in a block
    passage = " ".join(prose(30, 5))
    rows = [(i, " ".join(prose(6, i)) + " " + passage + " " + " ".join(prose(6, 900 + i))) for i in range(40)]
    assert removed(spark, frame(spark, rows), strings_per_bucket=1 << 20) == removal_by_force(rows)


def test_rows_of_equal_strings_are_combined():
    table = pa.table({"h": [1, 1, 2, 2, 2], "s": [b"a", b"a", b"b", b"c", b"b"], "x": [7, 7, 7, 9, 7],
                      "lo": [5, 3, 4, 1, 9], "n": [1, 2, 1, 1, 6]})
    out = bwt.combined(table).to_pylist()
    assert sorted((r["h"], r["s"], r["lo"], r["n"]) for r in out) == [(1, b"a", 3, 3), (2, b"b", 4, 7), (2, b"c", 1, 1)]
    assert [r["h"] for r in out] == sorted(r["h"] for r in out)
    lo, n = bwt.first_of_equals([b"p", b"q", b"p", b"p"], np.array([4, 8, 2, 3]))
    assert n.tolist() == [3, 1, 0, 0] and lo[0] == 2 and lo[1] == 8


def test_packed_texts_come_back(spark):
    texts = ["", None, "été " * 500, "x", "a" * 5000]
    held = packed(frame(spark, list(enumerate(texts)))).toArrow().combine_chunks().to_batches()[0]
    assert list(unpacked(held)) == [(t or "").encode() for t in texts]
