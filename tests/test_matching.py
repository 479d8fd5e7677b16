"""Largest matchings within a tolerance against trying all ways and against known answers."""

from __future__ import annotations

import random
from decimal import Decimal, localcontext

import numpy as np
import pytest
from pyspark.sql import functions as F

from answercheck.operators import matching
from answercheck.operators.diff import compare
from answercheck.operators.matching import Clamp, close, furthest_decimal, furthest_float


def left_over(spark, gold, cand, schema, tol=1.0, rel_tol=0.0):
    d = compare(spark.createDataFrame(gold, schema), spark.createDataFrame(cand, schema), tol=tol, rel_tol=rel_tol)
    return d.unmatched_gold, d.unmatched_cand


def some(r, columns, n, top):
    return [(r.randint(0, 2), *[r.choice([r.randint(0, top) / 2, r.randint(0, top) / 2, None, float("nan"), float("inf")]
                                         if r.random() < 0.1 else [r.randint(0, top) / 2]) for _ in range(columns)])
            for _ in range(n)]


def exact_or_close(rows):
    """Rows as tuples that ``close`` can compare: NaN and the infinities as text."""
    return [tuple(str(x) if isinstance(x, float) and x - x != 0 else x for x in r) for r in rows]


def by_force(gold, cand, tol=1.0, rel_tol=0.0):
    def match(a, b):
        return a[0] == b[0] and all((x == y) if isinstance(x, str) or isinstance(y, str) else close(x, y, tol, rel_tol)
                                    for x, y in zip(a[1:], b[1:]))
    gold, cand, taken = exact_or_close(gold), exact_or_close(cand), {}

    def place(i, seen):
        for j in range(len(cand)):
            if j not in seen and match(gold[i], cand[j]):
                seen.add(j)
                if j not in taken or place(taken[j], seen):
                    taken[j] = i
                    return True
        return False
    n = sum(place(i, set()) for i in range(len(gold)))
    return len(gold) - n, len(cand) - n


@pytest.mark.parametrize("seed", range(6))
def test_one_column_is_matched_as_well_as_can_be(spark, seed):
    r = random.Random(seed)
    gold, cand = some(r, 1, 60, 30), some(r, 1, r.randint(30, 70), 30)
    assert left_over(spark, gold, cand, "k int, x double") == by_force(gold, cand)


@pytest.mark.parametrize("seed", range(4))
def test_two_and_three_columns_are_matched_as_well_as_can_be(spark, seed):
    r = random.Random(seed)
    columns = 2 + seed % 2
    gold, cand = some(r, columns, 45, 5), some(r, columns, r.randint(30, 50), 5)
    schema = "k int, " + ", ".join(f"x{i} double" for i in range(columns))
    assert left_over(spark, gold, cand, schema) == by_force(gold, cand)


def test_relative_tolerance_in_one_and_two_columns(spark):
    r = random.Random(3)
    gold = [(0, r.choice([-1, 1]) * 1.07 ** r.randint(0, 60), 1.05 ** r.randint(0, 8)) for _ in range(40)]
    cand = [(0, r.choice([-1, 1]) * 1.07 ** r.randint(0, 60), 1.05 ** r.randint(0, 8)) for _ in range(45)]
    one = [g[:2] for g in gold], [c[:2] for c in cand]
    assert left_over(spark, *one, "k int, x double", 1e-3, 0.08) == by_force(*one, 1e-3, 0.08)
    assert left_over(spark, gold, cand, "k int, x double, y double", 1e-3, 0.08) == by_force(gold, cand, 1e-3, 0.08)


def test_decimals_of_many_digits(spark):
    r = random.Random(5)
    base = Decimal("1234567890123456789012345678")
    rows = [[(0, base + Decimal(r.randint(0, 40)) / 10 ** 7, Decimal(r.randint(0, 30)) / 10 ** 7) for _ in range(30)]
            for _ in range(2)]
    for n in (2, 3):
        gold, cand = ([x[:n] for x in side] for side in rows)
        schema = "k int, " + ", ".join(f"x{i} decimal(38, 9)" for i in range(n - 1))
        assert left_over(spark, gold, cand, schema, 1e-6) == by_force(gold, cand, 1e-6)


def test_a_dense_column_takes_one_sweep(spark):
    """200,000 neighbours within the tolerance of each other and one row different."""
    g = spark.range(200_000).select((F.col("id") * 4e-7).alias("x"))
    c = spark.range(200_000).select(F.when(F.col("id") == 77, 9.0).otherwise(
        F.col("id") * 4e-7 + F.when(F.col("id") % 2 == 0, 3e-7).otherwise(-3e-7)).alias("x"))
    d = compare(g, c)
    assert (d.unmatched_gold, d.unmatched_cand) == (1, 1)
    d = compare(g, g.select(F.col("x") + 9e-7))
    assert d.equal and d.approximate


def test_an_extra_row_far_from_the_missing_one_moves_a_chain(spark):
    """A row too many at one end and one too few at the other: every row moves by one."""
    n = 12
    g = [(0, i * 0.9, 0.0) for i in range(n)]
    c = [(0, i * 0.9 + 0.9, 0.0) for i in range(n)]
    assert left_over(spark, g, c, "k int, x double, y double") == (0, 0)
    c[4] = (0, 4 * 0.9 + 0.9, 5.0)
    assert left_over(spark, g, c, "k int, x double, y double") == by_force(g, c) == (1, 1)


def test_clamps_compose_like_the_sweep_they_stand_for():
    r = random.Random(2)
    for _ in range(400):
        steps = [(r.choice(["add", "at_most", "at_least"]), r.randint(-4, 4)) for _ in range(r.randint(0, 12))]
        whole = Clamp()
        for name, n in steps:
            getattr(whole, name)(abs(n) if name == "at_most" else -abs(n) if name == "at_least" else n)
        for start in range(-9, 10):
            n, gold, cand = start, 0, 0
            for name, x in steps:
                if name == "add":
                    n += x
                elif name == "at_most":
                    gold, n = gold + max(0, n - abs(x)), min(n, abs(x))
                else:
                    cand, n = cand + max(0, -abs(x) - n), max(n, -abs(x))
            assert whole.apply(start) == (n, gold, cand)


@pytest.mark.parametrize("tol, rel_tol", [(1e-6, 0.0), (1.0, 0.0), (1e-6, 1e-9), (1e-6, 0.3)])
def test_the_furthest_double_is_the_last_that_matches(tol, rel_tol):
    r = np.random.default_rng(7)
    v = np.concatenate([r.normal(size=200), r.normal(size=50) * 1e-6, [0.0, -tol, tol, -1e-6, 1e15, -1e300, 1.7e308, 5e-324],
                        10.0 ** r.integers(-20, 20, 60)])
    end = furthest_float(v, tol, rel_tol)
    for a, b in zip(v.tolist(), end.tolist()):
        assert close(a, b, tol, rel_tol)
        after = float(np.nextafter(b, np.inf))
        assert after == float("inf") or not close(a, after, tol, rel_tol)


def test_the_furthest_decimal_is_the_last_that_matches():
    for text in ("0", "1.123456789", "-5.5", "99999999999999999999.000000001"):
        for rel in (0.0, 0.01):
            v = Decimal(text)
            end = furthest_decimal(v, 9, 1e-6, rel)
            with localcontext() as ctx:
                ctx.prec = 60
                assert close(v, end, 1e-6, rel) and not close(v, end + Decimal("1e-9"), 1e-6, rel)
    assert furthest_decimal(Decimal("9" * 29), 9, 1e-6, 0.1) is None


def test_each_query_is_run_once(spark):
    """An accumulator inside both queries counts rows: what is compared is read once."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def count(x):
        seen.add(1)
        return x

    base = spark.range(500).select((F.col("id") % 9).alias("k"), (F.col("id") * 1.0).alias("x"))
    g, c = base.select("k", count("x").alias("x")), base.select("k", count(F.col("x") + 4e-7).alias("x"))
    assert compare(g, c).equal
    assert seen.value == 1000
    assert not compare(g.orderBy("x"), c.orderBy(F.col("x").desc()), ordered=True).equal
    assert seen.value <= 4000   # a range sort samples its input once more


def test_no_row_of_a_run_is_gathered(spark):
    """The plans hold no grouped Python task and no cross join."""
    import inspect
    text = inspect.getsource(matching)
    assert "applyInPandas" not in text and "crossJoin" not in text and "collect_list" not in text
