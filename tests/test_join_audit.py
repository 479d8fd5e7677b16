"""The join audit (T2) sizes equi-joins from per-key counts: exact for every join
type, and a hot many-to-many key is never expanded."""

from __future__ import annotations

import time

import pytest

from answercheck.operators.fanout import join_audit

JOIN_TYPES = ("JOIN", "LEFT JOIN", "RIGHT JOIN", "FULL JOIN", "LEFT SEMI JOIN", "LEFT ANTI JOIN")


@pytest.fixture(scope="module")
def sides(spark):
    # keys with duplicates on both sides, keys on one side only, and NULL keys
    left = [(k,) for k in (1, 1, 2, 3, 3, 3, None, None, 7)]
    right = [(k, k) for k in (1, 2, 2, 3, 4, None, 9, 9)]
    spark.createDataFrame(left, "k int").createOrReplaceTempView("audit_l")
    spark.createDataFrame(right, "k bigint, w bigint").createOrReplaceTempView("audit_r")
    return left, right


def _brute(left, right, how):
    n = 0
    matched_r = set()
    for i, (a,) in enumerate(left):
        hits = [j for j, (b, _) in enumerate(right) if a is not None and b is not None and a == b]
        matched_r.update(hits)
        if how == "JOIN":
            n += len(hits)
        elif how in ("LEFT JOIN", "FULL JOIN"):
            n += max(len(hits), 1)
        elif how == "LEFT SEMI JOIN":
            n += 1 if hits else 0
        elif how == "LEFT ANTI JOIN":
            n += 0 if hits else 1
        elif how == "RIGHT JOIN":
            n += len(hits)
    if how in ("RIGHT JOIN", "FULL JOIN"):
        n += len(right) - len(matched_r)
    return n


@pytest.mark.parametrize("how", JOIN_TYPES)
def test_key_counts_give_the_exact_join_size(spark, sides, how):
    left, right = sides
    df = spark.sql(f"SELECT * FROM audit_l l {how} audit_r r ON l.k = r.k")
    row = join_audit(df, "t").first()
    assert (row.left_rows, row.right_rows) == (len(left), len(right))
    assert row.joined_rows == _brute(left, right, how) == (spark.sql(
        f"SELECT COUNT(*) FROM audit_l l {how} audit_r r ON l.k = r.k").first()[0])


CONDITIONS = (
    "l.k = r.k AND r.w > 1", "l.k = r.k AND l.a > 2", "l.k = r.k AND r.w < l.a", "l.k = r.k AND r.w >= l.a",
    "l.k = r.k AND l.a BETWEEN r.lo AND r.hi", "l.k = r.k AND l.a > r.lo AND l.a < r.hi", "r.lo <= l.a AND l.a < r.hi",
    "r.w BETWEEN l.a AND l.b", "l.k = r.k AND r.w > l.a AND r.w <= l.b AND r.k < 3", "l.a < r.w", "l.k = r.k AND l.a <> r.w",
    "l.a <> r.w AND r.w > 0", "abs(l.k) = r.k + 0", "l.k = r.k AND l.b >= r.lo AND r.hi >= l.a AND l.a <= l.b AND r.lo <= r.hi",
)


@pytest.fixture(scope="module")
def ranged(spark):
    import random
    r = random.Random(4)

    def number(top):
        return r.choice([None, *range(top)])
    left = [(number(4), number(9), number(9)) for _ in range(40)]
    right = [(number(4), number(9), number(9), number(9)) for _ in range(50)]
    spark.createDataFrame(left * 2, "k int, a int, b int").createOrReplaceTempView("ranged_l")
    spark.createDataFrame(right + right[:9], "k int, w int, lo int, hi int").createOrReplaceTempView("ranged_r")


@pytest.mark.parametrize("condition", CONDITIONS)
def test_partners_are_counted_without_the_join(spark, ranged, condition):
    """Against the joins themselves, of every type, and the partners of every left row."""
    m = spark.sql(f"""SELECT id, COUNT(r.here) AS m FROM (SELECT *, uuid() AS id FROM ranged_l) l
                      LEFT JOIN (SELECT *, 1 AS here FROM ranged_r) r ON {condition} GROUP BY id""").collect()
    lone, again = sum(x.m == 0 for x in m), sum(max(x.m - 1, 0) for x in m)
    at = CONDITIONS.index(condition)
    for how in {"JOIN", JOIN_TYPES[at % 6]} if at % 5 else JOIN_TYPES:
        df = spark.sql(f"SELECT * FROM ranged_l l {how} ranged_r r ON {condition}")
        row = join_audit(df, "t").first()
        assert (row.left_rows, row.right_rows, row.joined_rows) == (80, 59, df.count()), how
        keeps = how in ("LEFT JOIN", "FULL JOIN")
        assert row.dropped_rows == (0 if keeps else 80 - lone if "ANTI" in how else lone), how
        assert row.repeated_rows == (0 if "SEMI" in how or "ANTI" in how else again), how


def test_conditions_of_no_known_form_are_unknown_and_not_run(spark, ranged):
    for condition in ("l.k = r.k AND l.a + r.w > 5", "l.k = r.k OR l.a = r.w",
                      "l.a >= r.lo AND l.b <= r.hi", "l.k = r.k AND l.a > r.lo AND l.b > r.hi"):
        row = join_audit(spark.sql(f"SELECT * FROM ranged_l l JOIN ranged_r r ON {condition}"), "t").first()
        assert row.left_rows == 80 and row.joined_rows is None


def test_lateral_joins_are_counted_through_their_plain_form(spark, ranged):
    bodies = ("SELECT w FROM ranged_r r WHERE r.k = l.k", "SELECT w FROM ranged_r r WHERE r.k = l.k AND r.w > l.a",
              "SELECT COUNT(*) AS n FROM ranged_r r WHERE r.k = l.k", "SELECT w FROM ranged_r r WHERE r.k = l.k ORDER BY w LIMIT 1",
              "SELECT explode(sequence(0, l.a)) AS x")
    for body in bodies:
        # Spark runs the last body as a plain generator, which forgets the outer join.
        for how in (",", "LEFT JOIN") if "explode" not in body else (",",):
            df = spark.sql(f"SELECT * FROM ranged_l l {how} LATERAL ({body}) x")
            row = join_audit(df, "t").first()
            assert (row.left_rows, row.joined_rows) == (80, df.count()), (body, how)
            assert row.dropped_rows is not None and row.repeated_rows is not None


def test_a_hot_many_to_many_key_is_never_expanded(spark):
    """30,000 rows on one key on each side: the join would emit 900 million rows; the
    audit reads 60,000."""
    hot = spark.range(30_000).selectExpr("0 AS k", "id AS v")
    hot.createOrReplaceTempView("audit_hot_l")
    hot.selectExpr("k", "v AS w").createOrReplaceTempView("audit_hot_r")
    df = spark.sql("SELECT * FROM audit_hot_l l JOIN audit_hot_r r ON l.k = r.k")
    t = time.perf_counter()
    row = join_audit(df, "hot").first()
    assert row.joined_rows == 900_000_000 and row.changed_rows and row.factor == 30_000.0
    assert time.perf_counter() - t < 60


def test_a_with_body_is_seen_through_and_lateral_joins_are_counted(spark, sides):
    left, right = sides
    df = spark.sql("WITH r AS (SELECT * FROM audit_r), j AS (SELECT l.k FROM audit_l l JOIN r ON l.k = r.k) SELECT COUNT(*) FROM j")
    assert join_audit(df, "t").first().joined_rows == _brute(left, right, "JOIN")
    df = spark.sql("SELECT * FROM audit_l l, LATERAL (SELECT w FROM audit_r r WHERE r.k = l.k) x")
    row = join_audit(df, "t").first()
    assert row.changed_rows and row.joined_rows == _brute(left, right, "JOIN")


def test_a_join_inside_a_subquery_is_audited(spark, sides):
    df = spark.sql("SELECT (SELECT COUNT(*) FROM audit_l l JOIN audit_r r ON l.k = r.k) AS n")
    assert join_audit(df, "t").first().joined_rows == _brute(*sides, "JOIN")


def test_a_product_is_sized_and_never_run(spark):
    spark.range(1_000_000).createOrReplaceTempView("audit_many")
    df = spark.sql("SELECT COUNT(*) FROM audit_many a, audit_many b")
    row = join_audit(df, "t").first()
    assert row.keyless and row.joined_rows == 10 ** 12 and row.changed_rows
    row = join_audit(spark.sql("SELECT * FROM audit_many a JOIN audit_many b ON a.id < b.id"), "t").first()
    assert row.keyless and row.joined_rows == 10 ** 6 * (10 ** 6 - 1) // 2 and row.dropped_rows == 1


def test_dropped_and_repeated_rows_do_not_cancel(spark):
    spark.createDataFrame([(1,), (2,), (3,)], "k int").createOrReplaceTempView("audit_three")
    spark.createDataFrame([(2,), (3,), (3,)], "k int").createOrReplaceTempView("audit_other")
    row = join_audit(spark.sql("SELECT * FROM audit_three a JOIN audit_other b ON a.k = b.k"), "t").first()
    assert row.joined_rows == row.left_rows == 3 and (row.dropped_rows, row.repeated_rows) == (1, 1) and row.changed_rows
