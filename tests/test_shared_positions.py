"""Ordered comparisons of one batch write the rows of the same query once."""

from __future__ import annotations

import pytest

from answercheck.operators import diff

GOLD = "SELECT id % 7 AS a, COUNT(*) AS n FROM range(100) GROUP BY id % 7 ORDER BY n DESC, a LIMIT 5"
OTHER = "SELECT id % 5 AS a, COUNT(*) AS n FROM range(100) GROUP BY id % 5 ORDER BY n DESC, a LIMIT 5"


@pytest.fixture
def written(monkeypatch):
    calls, real = [], diff.with_position
    monkeypatch.setattr(diff, "with_position", lambda df, tables, **more: calls.append(df) or real(df, tables, **more))
    return calls


def test_a_query_of_several_ordered_pairs_is_written_once(spark, written):
    got = diff.compare_batch([(key, spark.sql(GOLD), spark.sql(cand), True)
                              for key, cand in (("same", GOLD), ("other", OTHER), ("again", GOLD))])
    assert [got[k].equal for k in ("same", "other", "again")] == [True, False, True]
    assert [(got[k].gold_rows, got[k].cand_rows) for k in ("same", "other")] == [(5, 5), (5, 5)]
    assert len(written) == 2


def test_other_types_names_and_random_rows_are_not_shared(spark, written):
    lots = "SELECT rand() AS a FROM range(50) ORDER BY a"
    got = diff.compare_batch([("random", spark.sql(lots), spark.sql(lots), True),
                              ("float", spark.sql(GOLD), spark.sql(GOLD.replace("COUNT(*)", "CAST(COUNT(*) AS DOUBLE)")), True),
                              ("exact", spark.sql(GOLD), spark.sql(GOLD), True)])
    assert not got["random"].equal and got["float"].equal and got["exact"].equal
    assert len(written) == 2 + 2 + 1


def test_a_shared_query_that_fails_fails_each_of_its_pairs(spark, written):
    bad = "SELECT assert_true(id < 3), id FROM range(9) ORDER BY id"
    good = "SELECT CAST(NULL AS VOID) AS x, id FROM range(9) ORDER BY id"
    got = diff.compare_batch([("a", spark.sql(good), spark.sql(bad), True), ("b", spark.sql(good), spark.sql(bad), True),
                              ("c", spark.sql(good), spark.sql(good), True)])
    assert isinstance(got["a"], Exception) and isinstance(got["b"], Exception) and got["c"].equal
