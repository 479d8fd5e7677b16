"""How the pairs of a large bucket are dealt to tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from answercheck.llm import minhash


def test_pairs_of_a_large_bucket_are_dealt_to_cells_of_a_few_members(spark, monkeypatch):
    # Bucket 1: a component of 300 and 100 of one member; bucket 2: two of one.
    monkeypatch.setattr(minhash, "CELL", 16)
    rows = [(1, i, 0 if i < 300 else i) for i in range(400)] + [(2, 7, 0), (2, 401, 401)]
    members = minhash.with_main(spark.createDataFrame(rows, "k long, node long, component long"))
    few, most = (x.cache() for x in minhash.cells(members))
    for side, blocks in ((few, 7), (most, 25)):
        at = side.groupBy("k", "i", "j").count()
        assert at.agg(F.max("count")).first()[0] <= 3 * 16
        assert at.where("k = 1").count() == 7 * 25 and at.where("k = 2").count() == 1
        own = "i" if blocks == 7 else "j"  # a member is in one block, held against all of the other side
        assert side.groupBy("k", "node").agg(F.count_distinct(own).alias("n")).where("n <> 1").isEmpty()
    met = few.alias("x").join(most.alias("y"), ["k", "i", "j"]).groupBy("k", "x.node", "y.node").count()
    assert met.count() == 100 * 400 + 2 and met.where("count <> 1").isEmpty()
    pairs = [tuple(r) for r in minhash.meet_main(members, F.lit(True)).collect()]
    assert len(pairs) == len(set(pairs)) == 100 * 300 + 100 * 99 // 2 + 1


def test_a_skewed_bucket_is_not_cut_by_both_sides(spark):
    plan = minhash.meet_main(minhash.with_main(spark.createDataFrame(
        [(1, i, i // 2) for i in range(9)], "k long, node long, component long")), F.lit(True))
    exchanges = [x for x in plan._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning(k" in x and ", i#" in x]
    assert len(exchanges) == 2 and all("REPARTITION_BY_COL" in x for x in exchanges)
