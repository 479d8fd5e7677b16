"""Which members of a bucket are held against the bucket."""

from __future__ import annotations

from pyspark.sql import functions as F

from answercheck.llm import minhash


def test_only_members_outside_the_main_component_are_joined_with_the_bucket(spark):
    # Bucket 1: a component of 60, one of two and three of one; bucket 2: one component; 3: two of one.
    rows = [(1, i, 0) for i in range(60)] + [(1, 60, 60), (1, 61, 60)] + [(1, i, i) for i in (62, 63, 64)]
    rows += [(2, i, 0) for i in range(20)] + [(3, 70, 70), (3, 61, 60)]
    members = minhash.with_main(spark.createDataFrame(rows, "k long, node long, component long"))
    assert members.where("k = 2").isEmpty() and members.count() == 67
    few = members.where("component <> main")
    assert [r["node"] for r in few.where("k = 1").orderBy("node").collect()] == [60, 61, 62, 63, 64]
    pairs = minhash.meet_main(members, F.lit(True))
    want = sorted((min(a, b), max(a, b)) for k, a, c in rows for m, b, d in rows if k == m and a < b and c != d)
    assert sorted(map(tuple, pairs.collect())) == want
