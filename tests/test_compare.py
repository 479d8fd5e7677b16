"""Result comparison: order, names, tolerance, multiplicity, failures, explanations,
plus the edge cases the distributed version decides differently, and properties."""

from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from answercheck.operators.diff import compare, residual_rows
from answercheck.operators.diff_queries import FACT_SCHEMA, compare_sql
from answercheck.operators.explain import explain_col


def R(spark, rows, schema="a long"):
    return spark.createDataFrame(rows, schema)


def eq(g, c, ordered=False, **kw):
    return compare(g, c, ordered=ordered, **kw).equal


def explain(spark, gold_sql, cand_sql, ordered=False):
    row = compare_sql(spark, "t", gold_sql, cand_sql, ordered)
    return spark.createDataFrame([row], FACT_SCHEMA).select(explain_col()).first()[0]


# --- what counts as the same answer: (gold rows, candidate rows, gold schema, candidate schema) ---

SAME_ANSWER = {
    "equal cells": ([(1,)], [(1,)], "a long", "a long"),
    "another order of rows": ([(1,), (2,)], [(2,), (1,)], "a long", "a long"),
    "another name": ([(1,)], [(1,)], "revenue long", "total long"),
    "an integer as a float": ([(5,)], [(5.0,)], "a long", "a double"),
    "noise in the last digit": ([(1234.56,)], [(1234.5600000000001,)], "a double", "a double"),
}
ANOTHER_ANSWER = {
    "a cent more": ([(1234.56,)], [(1234.57,)], "a double", "a double"),
    "a row twice": ([(1,)], [(1,), (1,)], "a long", "a long"),
    "a row once instead of twice": ([(1,), (1,)], [(1,)], "a long", "a long"),
}


@pytest.mark.parametrize("case", SAME_ANSWER)
def test_answers_that_count_as_the_same(spark, case):
    gold, cand, gs, cs = SAME_ANSWER[case]
    assert eq(R(spark, gold, gs), R(spark, cand, cs))


@pytest.mark.parametrize("case", ANOTHER_ANSWER)
def test_answers_that_count_as_different(spark, case):
    gold, cand, gs, cs = ANOTHER_ANSWER[case]
    assert not eq(R(spark, gold, gs), R(spark, cand, cs))


def test_positions_count_only_for_ordered_pairs(spark):
    up, down = R(spark, [(1,), (2,)]).orderBy("a"), R(spark, [(2,), (1,)]).orderBy(F.col("a").desc())
    assert eq(up, down) and not eq(up, down, ordered=True)
    assert eq(up, R(spark, [(2,), (1,)]).orderBy("a"), ordered=True)


@pytest.mark.parametrize("gold, cand", [("SELECT 1", "SELECT nope FROM nowhere"), ("SELECT boom FROM x", "SELECT 1"),
                                        ("SELECT boom FROM x", "SELECT boom FROM x")])
def test_a_side_that_fails_equals_nothing(owner, gold, cand):
    row = compare_sql(owner[0], "t", gold, cand, False)
    assert not row["equal"] and row["cand_ok"] == ("SELECT 1" in cand)


@pytest.mark.parametrize("gold, cand, ordered, said", [
    ("SELECT 297994", "SELECT 511991", False, "1.72x"),
    ("SELECT * FROM VALUES (1), (2)", "SELECT 1", False, "fewer rows"),
    ("SELECT bad gold", "SELECT 1", False, "benchmark is broken"),
    ("SELECT a FROM VALUES (1), (2) t(a) ORDER BY a", "SELECT a FROM VALUES (1), (2) t(a) ORDER BY a DESC", True, "wrong order"),
])
def test_explanations_name_the_first_difference(owner, gold, cand, ordered, said):
    assert said in explain(owner[0], gold, cand, ordered)


def test_a_filter_and_its_negated_complement_agree(owner):
    row = compare_sql(owner[0], "t", "SELECT SUM(total_cents) FROM shop_orders WHERE status = 'completed'",
                      "SELECT SUM(o.total_cents) FROM shop_orders AS o "
                      "WHERE NOT (o.status = 'cancelled' OR o.status = 'pending')", False)
    assert row["equal"]


# --- decided differently here, on purpose ------------------------------------------------

def test_empty_against_empty_is_equal_at_any_arity(spark):
    d = compare(spark.createDataFrame([], "a long"), spark.createDataFrame([], "a long, b long"))
    assert d.equal and not d.arity_match


def test_different_arity_with_rows_is_not_equal(spark):
    assert not eq(R(spark, [(1,)]), R(spark, [(1, 2)], "a long, b long"))


def test_nan_equals_nan_only(spark):
    nan = float("nan")
    assert eq(R(spark, [(nan,)], "a double"), R(spark, [(nan,)], "a double"))
    assert not eq(R(spark, [(nan,)], "a double"), R(spark, [(1.0,)], "a double"))


def test_integers_above_2_to_the_53_compare_exactly(spark):
    big = 2 ** 53
    assert not eq(R(spark, [(big,)]), R(spark, [(big + 1,)]))
    assert eq(R(spark, [(big + 1,)]), R(spark, [(big + 1,)]))


def test_tolerance_is_on_the_unrounded_difference(spark):
    assert eq(R(spark, [(1.0,)], "a double"), R(spark, [(1.0000005,)], "a double"))
    assert not eq(R(spark, [(0.3,)], "a double"), R(spark, [(0.300002,)], "a double"))


def test_bool_against_int(spark):
    assert eq(R(spark, [(True,)], "a boolean"), R(spark, [(1,)]))
    assert not eq(R(spark, [(True,)], "a boolean"), R(spark, [(0,)]))


def test_null_against_zero_and_null_against_null(spark):
    assert not eq(R(spark, [(None,)]), R(spark, [(0,)]))
    assert eq(R(spark, [(None,)]), R(spark, [(None,)]))


def test_text_against_number_never_matches(spark):
    assert not eq(R(spark, [("5",)], "a string"), R(spark, [(5,)]))


def test_whitespace_around_text_is_ignored(spark):
    assert eq(R(spark, [("Nigeria",)], "a string"), R(spark, [("\tNigeria \n",)], "a string"))
    assert not eq(R(spark, [("Nigeria",)], "a string"), R(spark, [("Nige ria",)], "a string"))


def test_results_over_the_display_cap_are_compared_whole(spark):
    g = spark.range(1500).toDF("a")
    c = spark.range(1500).toDF("a").withColumn("a", F.when(F.col("a") == 1499, 0).otherwise(F.col("a")))
    assert not eq(g, c)


def test_matching_is_not_greedy(spark):
    """With tolerance 1, {0, 1} against {1, 2} matches as 0-1, 1-2; cancelling the
    equal 1s first would leave 0 against 2 and miss it."""
    assert eq(R(spark, [(0.0,), (1.0,)], "a double"), R(spark, [(1.0,), (2.0,)], "a double"), tol=1.0)


def test_a_hot_group_is_re_paired_whole(spark):
    """One exact key with most of the rows, floats off by noise: equal; one value
    really moved: exactly one row unmatched per side."""
    n = 3000
    g = spark.range(n).select(F.when(F.col("id") < 2500, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                              (F.col("id") / 7).alias("x"))
    c = g.select("k", (F.col("x") + F.when(F.col("x") > 100, 4e-7).otherwise(-4e-7)).alias("x"))
    assert eq(g, c)
    moved = c.select("k", F.when(F.col("x") > 300, F.col("x") + 1e-3).otherwise(F.col("x")).alias("x"))
    g2 = g.where(F.col("x") <= 300.001)
    c2 = moved.where(F.col("x") <= 301)
    d = compare(g2, c2)
    assert not d.equal


def test_residual_rows_name_the_surplus(spark):
    r = residual_rows(R(spark, [(1,), (2,), (2,)]), R(spark, [(2,), (3,)])).collect()
    got = sorted((int(x.c0), x.side, x.excess_rows) for x in r)
    assert got == [(1, "gold", 1), (2, "gold", 1), (3, "candidate", 1)]


# --- properties -------------------------------------------------------------------------------

rows_st = st.lists(st.tuples(st.integers(-5, 5), st.floats(-1e3, 1e3, allow_nan=False)), min_size=1, max_size=12)
SCHEMA = "k long, x double"
PROP = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@PROP
@given(rows=rows_st, seed=st.integers(0, 1000))
def test_permuting_repartitioning_or_renaming_never_changes_equality(spark, rows, seed):
    import random
    shuffled = rows[:]
    random.Random(seed).shuffle(shuffled)
    g = spark.createDataFrame(rows, SCHEMA)
    c = spark.createDataFrame(shuffled, "kk long, xx double").repartition(3)
    assert eq(g, c)


@PROP
@given(rows=rows_st, pick=st.integers(0, 100), dup=st.booleans())
def test_dropping_or_duplicating_one_row_always_breaks_equality(spark, rows, pick, dup):
    i = pick % len(rows)
    other = rows + [rows[i]] if dup else rows[:i] + rows[i + 1:]
    g = spark.createDataFrame(rows, SCHEMA)
    c = spark.createDataFrame(other, SCHEMA)
    assert not eq(g, c)
    assert not math.isnan(sum(x for _, x in rows))


# --- matching and positions over many partitions ------------------------------------------------

def test_a_hot_group_is_matched_through_the_global_sort(spark):
    n = 4000
    g = spark.range(n).repartition(7).select(
        F.when(F.col("id") < 3000, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") / 7).alias("x"))
    c = g.select("k", (F.col("x") + F.when(F.col("x") > 100, 4e-7).otherwise(-4e-7)).alias("x"))
    assert eq(g, c)
    c2 = c.select("k", F.when(F.col("x") > 500, F.col("x") + 1e-3).otherwise(F.col("x")).alias("x"))
    d = compare(g, c2)
    assert not d.equal and d.unmatched_gold > 0 and d.unmatched_gold == d.unmatched_cand


def test_positions_of_a_sorted_result_span_partitions(spark):
    from answercheck.operators.diff import with_position
    from answercheck.session import SharedTables
    df = spark.range(5000).repartition(6).orderBy(F.col("id").desc())
    with SharedTables(spark) as tables:
        pos = {r.id: r._pos for r in with_position(df, tables).collect()}
        root = tables.root
    fs = spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    assert not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(root))  # nothing stays behind
    assert all(pos[i] == 4999 - i for i in range(5000))


def test_ordered_comparison_without_a_limit(spark):
    g = spark.range(3000).toDF("a").repartition(5).orderBy("a")
    same = spark.range(3000).toDF("a").repartition(3).orderBy("a")
    rev = spark.range(3000).toDF("a").orderBy(F.col("a").desc())
    assert eq(g, same, ordered=True)
    d = compare(g, rev, ordered=True)
    assert d.bag_equal and not d.equal


def test_batches_split_and_keep_every_result(spark):
    from answercheck.operators.diff import compare_batch
    items = [(str(i), R(spark, [(i,)]), R(spark, [(i if i % 3 else i + 1,)]), False) for i in range(7)]
    out = compare_batch(items, batch=3)
    assert sorted(out) == sorted(str(i) for i in range(7))
    assert [out[str(i)].equal for i in range(7)] == [bool(i % 3) for i in range(7)]


def test_positions_are_checked_inside_the_summary_job(spark):
    """The position check of an ordered pair is a second row of the one summary job."""
    from answercheck.operators.diff import ORDERED_SUFFIX, _summary, prepare
    from answercheck.session import SharedTables
    base = spark.range(50).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    g = base.orderBy(F.col("b").desc()).limit(5)
    same = base.orderBy(F.col("b").desc()).limit(5)
    with SharedTables(spark) as tables:
        summary = _summary(prepare("k", g, same, True, tables))
        assert sorted(r["pid"] for r in summary.collect()) == ["k", "k" + ORDERED_SUFFIX]
    assert eq(g, same, ordered=True)
    g3 = base.where(F.col("b") < 3).orderBy("b").limit(3)
    c3 = base.where(F.col("b") < 3).orderBy(F.col("b").desc()).limit(3)
    d3 = compare(g3, c3, ordered=True)
    assert d3.bag_equal and not d3.equal


def test_relative_tolerance_absorbs_the_last_digits_of_large_sums(spark):
    """Off by default: 1e12 against 1e12 + 1e-3 differs by far more than 1e-6, but
    only in the 16th significant digit."""
    g = R(spark, [(1e12,)], "x double")
    c = R(spark, [(1e12 + 1e-3,)], "x double")
    assert not eq(g, c)
    assert eq(g, c, rel_tol=1e-12)
    assert not eq(g, R(spark, [(1.001e12,)], "x double"), rel_tol=1e-12)
    # many rows: the grid disagrees, the re-pairing applies the relative bound
    rows = [(f"k{i % 3}", 1e12 * (i + 1)) for i in range(30)]
    g = spark.createDataFrame(rows, "k string, x double")
    c = g.select("k", (F.col("x") * (1 + 1e-14)).alias("x"))
    assert not eq(g, c)
    assert eq(g, c, rel_tol=1e-12)
    assert eq(g.orderBy("x"), c.orderBy("x"), ordered=True, rel_tol=1e-12)
    assert not eq(g.orderBy("x"), c.orderBy(F.col("x").desc()), ordered=True, rel_tol=1e-12)


def test_only_groups_that_disagree_lose_rows(spark):
    g = spark.range(3000).select((F.col("id") % 40).alias("k"), (F.col("id") / 7).alias("x"))
    c = g.select("k", F.when(F.col("k") == 3, F.col("x") + 4e-7).otherwise(F.col("x")).alias("x"))
    assert eq(g, c)
    c2 = g.select("k", F.when(F.col("k") == 3, F.col("x") + 1e-3).otherwise(F.col("x")).alias("x"))
    d = compare(g, c2)
    assert not d.equal and d.unmatched_gold == d.unmatched_cand == 75


def test_two_float_columns_match_across_the_grid(spark):
    g = R(spark, [(1.0000004, 5.0), (1.0000006, 7.0)], "a double, b double")
    c = R(spark, [(1.0000006, 5.0), (1.0000004, 7.0)], "a double, b double")
    assert eq(g, c)


def test_unmatched_counts_use_the_tolerance_when_row_counts_differ(spark):
    d = compare(R(spark, [(0.3000004,), (9.0,)], "x double"), R(spark, [(0.3000006,)], "x double"))
    assert (d.unmatched_gold, d.unmatched_cand) == (1, 0)


def test_decimals_compare_as_decimals(spark):
    big = "CAST('12345678901234567.01' AS DECIMAL(38, 2)) AS x", "CAST('12345678901234567.02' AS DECIMAL(38, 2)) AS x"
    g, c = (spark.sql(f"SELECT {b}") for b in big)
    assert not eq(g, c) and eq(g, g)
    assert eq(spark.sql("SELECT CAST(5 AS DECIMAL(12, 2))"), spark.sql("SELECT 5"))
    fine = [spark.sql(f"SELECT k, CAST(x AS DECIMAL(30, 9)) x FROM VALUES (1, '1.000000400'), (2, '{t}') t(k, x)")
            for t in ("2.000000000", "2.000000900", "2.000001100")]
    assert eq(fine[0], fine[1]) and not eq(fine[0], fine[2])


def test_a_date_equals_its_iso_text(spark):
    assert eq(spark.sql("SELECT DATE '1998-03-01' AS d"), spark.sql("SELECT '1998-03-01' AS d"))
    assert not eq(spark.sql("SELECT DATE '1998-03-01' AS d"), spark.sql("SELECT '1998-3-1' AS d"))


def test_chains_match_through_the_whole_comparison(spark):
    """0, 1, 2, ... against the same shifted by one step of just under the tolerance:
    one long run, all but the ends paired; and values a third of the rows share."""
    step = 0.9e-6
    g = spark.range(300).select((F.col("id") * step).alias("x"))
    c = spark.range(300).select(((F.col("id") + 1) * step).alias("x"))
    assert eq(g, c)
    hot = g.union(spark.range(150).select(F.lit(7.0).alias("x")))
    d = compare(hot, c.union(spark.range(130).select(F.lit(7.0000003).alias("x"))))
    assert (d.unmatched_gold, d.unmatched_cand) == (20, 0)


def test_one_failing_pair_costs_only_itself(spark):
    from answercheck.operators.diff import compare_batch
    bad = spark.sql("SELECT CAST(o AS INT) AS a FROM VALUES ('x') t(o)")
    items = [(str(i), R(spark, [(i,)]), bad if i == 5 else R(spark, [(i,)]), False) for i in range(8)]
    out = compare_batch(items)
    assert [out[str(i)].equal if i != 5 else isinstance(out["5"], Exception) for i in range(8)] == [True] * 8
