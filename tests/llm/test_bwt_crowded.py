"""Anchors with ever new text around them."""

from __future__ import annotations

from answercheck.llm import bwt
from tests.llm.test_operators import frame, prose, removal_by_force, removed


def test_bwt_gathers_no_more_strings_of_an_anchor_than_its_bound(spark, monkeypatch):
    field = " the field of a template of this site: "
    rows = [(i, " ".join(prose(12, i)) + field + " ".join(prose(12, 500 + i))) for i in range(60)]
    rows += [(100 + i, " ".join(prose(12, i))[-25:] + field + " ".join(prose(12, 700 + i))) for i in range(30)]
    rows += [(200, rows[3][1]), (200, "x" + rows[4][1]), (None, rows[5][1]), (201, "ab" * 900), (202, "ab" * 800)]
    rows += [(300 + i, "a plain passage that two documents have in common, without the field " + str(i)) for i in range(2)]
    gathered = []

    def watched(distinct, *args, original=bwt.bucket_repeats):
        gathered.extend(r["count"] for r in distinct.groupBy("h").count().collect())
        return original(distinct, *args)

    monkeypatch.setattr(bwt, "bucket_repeats", watched)
    assert removed(spark, frame(spark, rows), shard=512, strings_per_bucket=64, strings_per_anchor=10) == removal_by_force(rows)
    assert gathered and max(gathered) <= 10
