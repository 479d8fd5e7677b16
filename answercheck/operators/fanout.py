"""Join fan-out diagnostics (group M, C2, C3, T1).

Joining a parent (orders) to its children (lineitem) repeats each parent once per
child, so any aggregate of a parent column is weighted by child counts. All of these
reduce the child to one row per parent first (``lines_per_order``): the shuffle then
carries partial counts, a parent with a third of all lines collapses map-side, and
every figure below is one pass over (order, line count).
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..registry import query
from ..sources.tables import cents, shop_cte, table
from .join_sizes import SIZED, decorrelated, plan_rows, projected, sized
from .relational import completed_orders

_CENTS = "CAST(ROUND(o.o_totalprice * 100) AS BIGINT)"
_LINES = "(SELECT l_orderkey, COUNT(*) AS lines FROM lineitem GROUP BY l_orderkey)"


def lines_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))


def completed_with_lines(spark: SparkSession, sf_dir: str, how: str = "inner") -> DataFrame:
    """(id, total_cents, lines) per completed order; ``how='left'`` keeps childless ones."""
    o = completed_orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("id"), cents(F.col("o_totalprice")).alias("total_cents"))
    lpo = lines_per_order(spark, sf_dir)
    return o.join(lpo, o.id == lpo.l_orderkey, how).drop("l_orderkey")


@query("fanout_revenue", oracle=f"""
    SELECT CAST(SUM({_CENTS}) AS BIGINT) AS revenue_cents
    FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE o.o_orderstatus = 'F'""")
def fanout_revenue(spark, sf_dir):
    """The wrong answer on purpose: the parent total summed across the 1:N join.
    Computed as total x line count, which is what the join produces, without
    materialising one row per line."""
    j = completed_with_lines(spark, sf_dir)
    return j.agg(F.sum(F.col("total_cents") * F.col("lines")).alias("revenue_cents"))


@query("aggregate_then_join", oracle=f"""
    SELECT CAST(SUM({_CENTS}) AS BIGINT) AS revenue_cents
    FROM orders o JOIN {_LINES} i ON i.l_orderkey = o.o_orderkey WHERE o.o_orderstatus = 'F'""")
def aggregate_then_join(spark, sf_dir):
    """Repair 2 as written: child aggregated first, then an INNER join. It drops
    completed orders that have no lines."""
    return completed_with_lines(spark, sf_dir).agg(F.sum("total_cents").alias("revenue_cents"))


@query("aggregate_then_left_join", oracle=f"""
    SELECT CAST(SUM({_CENTS}) AS BIGINT) AS revenue_cents
    FROM orders o LEFT JOIN {_LINES} i ON i.l_orderkey = o.o_orderkey WHERE o.o_orderstatus = 'F'""")
def aggregate_then_left_join(spark, sf_dir):
    """Repair 2 done right: a LEFT join keeps childless parents and equals the true
    total. Catalyst removes the join entirely (the aggregate is unique on the key and
    no column of it is used), so the plan is the plain scan of total_revenue."""
    return completed_with_lines(spark, sf_dir, "left").agg(F.sum("total_cents").alias("revenue_cents"))


@query("distinct_key_revenue", oracle=f"""
    SELECT CAST(SUM(total_cents) AS BIGINT) AS revenue_cents FROM (
        SELECT DISTINCT o.o_orderkey, {_CENTS} AS total_cents
        FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE o.o_orderstatus = 'F') t""")
def distinct_key_revenue(spark, sf_dir):
    """Repair 3: the parent column over DISTINCT parent keys of the joined rows. The
    distinct joined parents are exactly the parents with a child, so the join plus
    de-duplication is a semi-join: no joined row is ever built. Child keys are made
    distinct first, map-side too, so an order with very many lines is one row."""
    o = completed_orders(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct()
    return (o.join(li, o.o_orderkey == li.l_orderkey, "left_semi")
            .agg(F.sum(cents(F.col("o_totalprice"))).alias("revenue_cents")))


@query("fanout_per_parent", oracle=f"""
    SELECT o.o_orderkey AS id, {_CENTS} AS total_cents, COUNT(l.l_orderkey) AS line_items,
           {_CENTS} * COUNT(l.l_orderkey) AS counted_as
    FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    WHERE o.o_orderstatus = 'F'
    GROUP BY o.o_orderkey, {_CENTS} ORDER BY id""")
def fanout_per_parent(spark, sf_dir):
    """Per completed order: its total, its lines, and what the join counts it as.
    The reference selects the total beside GROUP BY id (a SQLite bare column); here
    the total is functionally dependent on the key and joins after the count."""
    j = completed_with_lines(spark, sf_dir)
    return j.select("id", "total_cents", F.col("lines").alias("line_items"),
                    (F.col("total_cents") * F.col("lines")).alias("counted_as")).orderBy("id")


@query("fanout_check", oracle=f"""
    WITH per AS (
        SELECT o.o_orderkey, i.lines FROM orders o LEFT JOIN {_LINES} i ON i.l_orderkey = o.o_orderkey
        WHERE o.o_orderstatus = 'F')
    SELECT COUNT(*) AS rows_before, CAST(COALESCE(SUM(lines), 0) AS BIGINT) AS rows_after,
           COUNT(*) FILTER (WHERE lines IS NULL) AS parents_dropped,
           COUNT(*) FILTER (WHERE lines > 1) AS parents_repeated,
           MAX(lines) AS max_multiplicity,
           COUNT(*) <> COALESCE(SUM(lines), 0) OR COUNT(*) FILTER (WHERE lines IS NULL) > 0
             OR COUNT(*) FILTER (WHERE lines > 1) > 0 AS join_changed_rows
    FROM per""")
def fanout_check(spark, sf_dir):
    """Did the join change the row count? Also how many parents it dropped and how
    many it repeated, since drops and repeats can cancel in the totals."""
    per = completed_with_lines(spark, sf_dir, "left")
    lines = F.col("lines")
    out = per.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.coalesce(F.sum(lines), F.lit(0).cast("bigint")).alias("rows_after"),
        F.count_if(lines.isNull()).alias("parents_dropped"),
        F.count_if(lines > 1).alias("parents_repeated"),
        F.max(lines).alias("max_multiplicity"),
    )
    return out.withColumn("join_changed_rows",
                          (F.col("rows_before") != F.col("rows_after"))
                          | (F.col("parents_dropped") > 0) | (F.col("parents_repeated") > 0))


@query("fanout_inflation", oracle=f"""
    WITH per AS (
        SELECT {_CENTS} AS total_cents, i.lines FROM orders o LEFT JOIN {_LINES} i ON i.l_orderkey = o.o_orderkey
        WHERE o.o_orderstatus = 'F'),
    s AS (SELECT CAST(SUM(total_cents) AS BIGINT) AS true_cents,
                 CAST(SUM(total_cents * lines) AS BIGINT) AS fanout_cents,
                 COUNT(*) AS parents, CAST(COALESCE(SUM(lines), 0) AS BIGINT) AS joined_rows FROM per)
    SELECT true_cents, fanout_cents, fanout_cents - true_cents AS error_cents,
           ROUND(fanout_cents / true_cents, 6) AS inflation,
           ROUND(joined_rows / parents, 6) AS lines_per_parent
    FROM s""")
def fanout_inflation(spark, sf_dir):
    """Inflation factor is weighted by amount, so it differs from lines per parent."""
    per = completed_with_lines(spark, sf_dir, "left")
    s = per.agg(
        F.sum("total_cents").alias("true_cents"),
        F.sum(F.col("total_cents") * F.col("lines")).alias("fanout_cents"),
        F.count(F.lit(1)).alias("parents"),
        F.coalesce(F.sum("lines"), F.lit(0).cast("bigint")).alias("joined_rows"),
    )
    return s.select(
        "true_cents", "fanout_cents",
        (F.col("fanout_cents") - F.col("true_cents")).alias("error_cents"),
        F.round(F.col("fanout_cents") / F.col("true_cents"), 6).alias("inflation"),
        F.round(F.col("joined_rows") / F.col("parents"), 6).alias("lines_per_parent"),
    )


@query("total_mismatch", oracle="""
    WITH li AS (
        SELECT l.l_orderkey, SUM(CAST(l.l_quantity AS BIGINT) * CAST(ROUND(p.p_retailprice * 100) AS BIGINT)) AS lines_cents
        FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY l.l_orderkey)
    SELECT COUNT(*) AS mismatched_orders,
           CAST(SUM(li.lines_cents - CAST(ROUND(o.o_totalprice * 100) AS BIGINT)) AS BIGINT) AS difference_cents
    FROM orders o JOIN li ON li.l_orderkey = o.o_orderkey
    WHERE li.lines_cents <> CAST(ROUND(o.o_totalprice * 100) AS BIGINT)""")
def total_mismatch(spark, sf_dir):
    """Reconcile headers against lines: orders whose SUM(qty * unit_cents) differs from
    the order total (HAVING on an aggregate), as a count and the net difference."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    p = table(spark, sf_dir, "part").select("p_partkey", cents(F.col("p_retailprice")).alias("unit_cents"))
    per_order = (li.join(p, li.l_partkey == p.p_partkey).groupBy("l_orderkey")
                 .agg(F.sum(F.col("l_quantity").cast("bigint") * F.col("unit_cents")).alias("lines_cents")))
    o = table(spark, sf_dir, "orders").select("o_orderkey", cents(F.col("o_totalprice")).alias("total_cents"))
    bad = (per_order.join(o, per_order.l_orderkey == o.o_orderkey)
           .where(F.col("lines_cents") != F.col("total_cents")))
    return bad.agg(F.count(F.lit(1)).alias("mismatched_orders"),
                   F.sum(F.col("lines_cents") - F.col("total_cents")).alias("difference_cents"))


# --- T2: the same check on any query ---------------------------------------------------------

_AUDIT = ("query_id string, join_index int, join_type string, keyless boolean, left_rows decimal(38,0), "
          "right_rows decimal(38,0), joined_rows decimal(38,0), dropped_rows decimal(38,0), repeated_rows decimal(38,0)")


def _joins(node, out: list) -> list:
    """Join nodes of an analyzed plan, outermost first, those inside subqueries and lateral
    ones included; a view is a table here."""
    kids = [node.children().apply(i) for i in range(node.children().size())]
    if node.nodeName() == "SubqueryAlias" and len(kids) == 1 and kids[0].nodeName() == "View":
        return out
    if node.nodeName() in ("Join", "LateralJoin"):
        out.append(node)
    subs = [node.subqueries().apply(i) for i in range(node.subqueries().size())]
    for k in kids + subs:
        _joins(k, out)
    return out


def _big(c):
    """Counts are multiplied: DECIMAL(38,0) holds what BIGINT cannot."""
    return F.coalesce(c.cast("decimal(19,0)"), F.lit(0).cast("decimal(19,0)"))


def _counts_by_keys(session, j):
    """Rows in on each side, rows out, and left rows dropped and repeated by an equi-join,
    without building its output.

    Each side is counted per key value (one aggregate, combined map-side, so a key
    holding a third of all rows is one partial row per task); the two count tables
    are full-outer-joined on the key, one row per key and side, and the output size
    is the sum of ``left * right`` over keys (plus unmatched rows for outer joins).
    Exact for equality keys; a many-to-many hot key is never expanded. None if the
    join has another condition."""
    jt = j.joinType().toString()
    if jt not in SIZED:
        return None
    extracted = session._jvm.org.apache.spark.sql.catalyst.planning.ExtractEquiJoinKeys.unapply(j)
    if not extracted.isDefined():
        return None
    parts = extracted.get()
    lkeys, rkeys, other = parts._2(), parts._3(), parts._4()
    if other.isDefined() or lkeys.size() == 0:
        return None
    sides = []
    for plan, keys, tag in ((j.left(), lkeys, "l"), (j.right(), rkeys, "r")):
        names = {f"{tag}{i}": keys.apply(i) for i in range(keys.size())}
        sides.append(projected(session, plan, names).groupBy(*names).agg(F.count(F.lit(1)).alias(f"n{tag}")))
    lk, rk = sides
    on = reduce(lambda a, b: a & b, [F.col(f"l{i}") == F.col(f"r{i}") for i in range(lkeys.size())])
    nl, nr, one = _big(F.col("nl")), _big(F.col("nr")), F.lit(1).cast("decimal(19,0)")
    matched = nl * nr
    lone_left, lone_right = F.when(nr == 0, nl).otherwise(0), F.when(nl == 0, nr).otherwise(0)
    kept = F.when((nl > 0) & (nr > 0), nl).otherwise(0)
    out = {"Inner": matched, "LeftOuter": matched + lone_left, "RightOuter": matched + lone_right,
           "FullOuter": matched + lone_left + lone_right, "LeftSemi": kept, "LeftAnti": lone_left}[jt]
    dropped = {"Inner": lone_left, "RightOuter": lone_left, "LeftSemi": lone_left, "LeftAnti": kept}.get(jt, F.lit(0))
    repeated = F.lit(0) if jt in ("LeftSemi", "LeftAnti") else F.when(nr > 1, nl * (nr - one)).otherwise(0)
    total = lambda c: F.coalesce(F.sum(c.cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)")
    return lk.join(rk, on, "full_outer").agg(
        total(nl).alias("left_rows"), total(nr).alias("right_rows"), total(out).alias("joined_rows"),
        total(dropped).alias("dropped_rows"), total(repeated).alias("repeated_rows"))


def _side_by_side(session, plans: dict) -> DataFrame:
    """The row count of each plan as a column, all in one job."""
    tagged = reduce(DataFrame.unionByName, [plan_rows(session, p).select(F.lit(n).alias("_n")) for n, p in plans.items()])
    return tagged.agg(*[F.count_if(F.col("_n") == n).cast("decimal(38,0)").alias(n) for n in plans])


def _counts(session, j) -> tuple[DataFrame, bool | None]:
    """(one row of counts, keyless): NULL where a count would take running the join."""
    none = F.lit(None).cast("decimal(38,0)")
    if j.nodeName() == "LateralJoin":
        j = decorrelated(session, j)
        if j is None:
            raise ValueError("a lateral join that no plain join replaces")
    by_keys = _counts_by_keys(session, j)
    if by_keys is not None:
        return by_keys, False
    keyless = not session._jvm.org.apache.spark.sql.catalyst.planning.ExtractEquiJoinKeys.unapply(j).isDefined()
    if j.condition().isDefined():
        counts = sized(session, j)
        if counts is not None:
            row = [(tuple(None if v is None else Decimal(v) for v in counts.values()))]
            return session.createDataFrame(row, ", ".join(f"{n} decimal(38,0)" for n in counts)), keyless
    c = _side_by_side(session, {"left_rows": j.left(), "right_rows": j.right()})
    product = (F.col("left_rows").cast("decimal(19,0)") * F.col("right_rows").cast("decimal(19,0)")).cast("decimal(38,0)")
    return (c.withColumn("joined_rows", none if j.condition().isDefined() else product).withColumn("dropped_rows", none)
            .withColumn("repeated_rows", none)), keyless


def join_audit(df: DataFrame, query_id: str = "q") -> DataFrame | None:
    """M1 for an arbitrary query: for every join it makes, rows in on each side, rows out,
    and (for equi-joins) how many left rows it dropped and how often it repeated others, in
    one job (one row per join, unioned). A join that dropped or repeated rows of its left
    (FROM) side has weighted any aggregate of a left-side column, even if both cancel out.

    ``WITH`` bodies are put in place of their references first, lateral joins are decorrelated.
    Equi-joins are sized from per-key counts, joins with a range or ``<>`` condition, with or
    without keys, from sorted ends (``join_sizes``), a product as the product of its sides. No
    join is run; one that none of this sizes has NULL counts. ``keyless``: no equality at all.
    None if there is no join."""
    session = df.sparkSession
    plan = df._jdf.queryExecution().analyzed()
    inlined = session._jvm.org.apache.spark.sql.catalyst.optimizer.InlineCTE(True, False).apply(plan)
    joins = _joins(inlined, [])
    if not joins:
        return None
    names = [f.split(" ")[0] for f in _AUDIT.split(", ")]
    rows = []
    for i, j in enumerate(joins):
        try:
            counts, keyless = _counts(session, j)
        except Exception:  # noqa: BLE001  an audit never fails its query
            counts = session.createDataFrame([(None,) * 5], ", ".join(f"{n} decimal(38,0)" for n in names[4:]))
            keyless = None
        rows.append(counts.select(F.lit(query_id).alias("query_id"), F.lit(i).alias("join_index"),
                                  F.lit(j.joinType().toString()).alias("join_type"),
                                  F.lit(keyless).cast("boolean").alias("keyless"), *names[4:]))
    wide = reduce(DataFrame.unionByName, rows)
    changed = (F.coalesce(F.col("joined_rows") != F.col("left_rows"), F.col("keyless"), F.lit(False))
               | (F.coalesce("dropped_rows", F.lit(0)) > 0) | (F.coalesce("repeated_rows", F.lit(0)) > 0))
    known = F.col("left_rows").isNotNull()
    return wide.select(
        "query_id", "join_index", "join_type", "keyless",
        *names[4:], F.when(known, changed).alias("changed_rows"),
        F.when(F.col("left_rows") > 0, F.round(F.col("joined_rows").cast("double") / F.col("left_rows").cast("double"), 6)
               ).alias("factor"))


# One query of each kind the audit has to see through, and the key sets (left,
# right) its join meets on, for the oracle.
_TWICE = ("(SELECT id FROM shop_orders WHERE id % 4 <> 0 UNION ALL SELECT id FROM shop_orders WHERE id % 4 = 1)")
AUDIT_CASES = {
    "fanout": ("SELECT SUM(o.total_cents) FROM shop_orders o JOIN shop_order_items i ON i.order_id = o.id "
               "WHERE o.status = 'completed'", "shop_orders", "id", "shop_order_items", "order_id"),
    "in_a_with_body": ("WITH i AS (SELECT order_id, qty FROM shop_order_items), "
                       "j AS (SELECT o.total_cents FROM shop_orders o JOIN i ON i.order_id = o.id) "
                       "SELECT SUM(total_cents) FROM j", "shop_orders", "id", "shop_order_items", "order_id"),
    "drops_as_much_as_it_repeats": (f"SELECT SUM(o.total_cents) FROM shop_orders o JOIN {_TWICE} t ON t.id = o.id",
                                    "shop_orders", "id", f"{_TWICE} t", "id"),
}
_LATERAL_SQL = ("SELECT SUM(o.total_cents) FROM shop_orders o, "
                "LATERAL (SELECT i.qty FROM shop_order_items i WHERE i.order_id = o.id) x")
_CROSS_SQL = "SELECT COUNT(*) FROM shop_orders o CROSS JOIN shop_refunds r"
# Joins on ranges: with a key, without one, by an open end, and with conditions on
# one side; each with its join written out for the oracle.
RANGE_CASES = {
    "refunded_within_a_quarter": (
        "SELECT SUM(o.total_cents) FROM shop_orders o JOIN shop_refunds r ON r.order_id = o.id "
        "AND r.refunded_at BETWEEN o.ordered_at AND date_add(o.ordered_at, 90)", "Inner", False, "shop_orders o", "shop_refunds r",
        "r.order_id = o.id AND r.refunded_at BETWEEN o.ordered_at AND o.ordered_at + 90"),
    "items_of_large_orders": (
        "SELECT SUM(o.total_cents) FROM shop_orders o LEFT JOIN shop_order_items i ON i.order_id = o.id "
        "AND i.qty > 25 AND o.status = 'completed' AND i.qty * 100 <= o.total_cents", "LeftOuter", False, "shop_orders o",
        "shop_order_items i", "i.order_id = o.id AND i.qty > 25 AND o.status = 'completed' AND i.qty * 100 <= o.total_cents"),
    "orders_in_the_day_before": (
        "SELECT COUNT(*) FROM shop_refunds r JOIN shop_orders o ON o.ordered_at >= date_sub(r.refunded_at, 1) "
        "AND o.ordered_at < r.refunded_at", "Inner", True, "shop_refunds r", "shop_orders o", "o.ordered_at = r.refunded_at - 1"),
    "refunded_for_another_day": (
        "SELECT COUNT(*) FROM shop_orders o JOIN shop_refunds r ON r.order_id = o.id AND r.refunded_at <> o.shipped_at",
        "Inner", False, "shop_orders o", "shop_refunds r", "r.order_id = o.id AND r.refunded_at <> o.shipped_at"),
}


def _audit_oracle() -> str:
    dec = "DECIMAL(38, 0)"
    parts = []
    for key, (_, left, lk, right, rk) in AUDIT_CASES.items():
        parts.append(f"""
    SELECT '{key}' AS query_id, 0 AS join_index, 'Inner' AS join_type, FALSE AS keyless, l AS left_rows, r AS right_rows,
           j AS joined_rows, d AS dropped_rows, p AS repeated_rows, (j <> l OR d > 0 OR p > 0) AS changed_rows,
           ROUND(CAST(j AS DOUBLE) / l, 6) AS factor
    FROM (SELECT CAST(SUM(nl) AS {dec}) AS l, (SELECT CAST(COUNT(*) AS {dec}) FROM {right}) AS r,
                 CAST(SUM(nl * COALESCE(nr, 0)) AS {dec}) AS j,
                 CAST(SUM(CASE WHEN nr IS NULL THEN nl ELSE 0 END) AS {dec}) AS d,
                 CAST(SUM(CASE WHEN nr > 1 THEN nl * (nr - 1) ELSE 0 END) AS {dec}) AS p
          FROM (SELECT {lk} AS k, COUNT(*) AS nl FROM {left} GROUP BY 1) a
          LEFT JOIN (SELECT {rk} AS k, COUNT(*) AS nr FROM {right} GROUP BY 1) b USING (k)) x""")
    ranges = {k: v[1:] for k, v in RANGE_CASES.items()} | {
        "lateral": ("Inner", False, "shop_orders o", "shop_order_items i", "i.order_id = o.id")}
    for key, (kind, keyless, left, right, on) in ranges.items():
        alias = left.split()[1]
        other = right.split()[1]
        outer = kind == "LeftOuter"
        parts.append(f"""
    SELECT '{key}', 0, '{kind}', {str(keyless).upper()}, CAST(l AS {dec}), CAST(r AS {dec}), CAST(j AS {dec}),
           CAST(d AS {dec}), CAST(p AS {dec}), (j <> l OR d > 0 OR p > 0), ROUND(CAST(j AS DOUBLE) / l, 6)
    FROM (SELECT COUNT(*) AS l, (SELECT COUNT(*) FROM {right}) AS r,
                 SUM({'greatest(m, 1)' if outer else 'm'}) AS j, {'0' if outer else 'COUNT(*) FILTER (WHERE m = 0)'} AS d,
                 COALESCE(SUM(m - 1) FILTER (WHERE m > 1), 0) AS p
          FROM (SELECT COUNT({other}.here) AS m
                FROM (SELECT *, row_number() OVER () AS row_id FROM {left.split()[0]}) {alias}
                LEFT JOIN (SELECT *, 1 AS here FROM {right.split()[0]}) {other} ON {on}
                GROUP BY {alias}.row_id) x) y""")
    parts.append(f"""
    SELECT 'cross', 0, 'Cross', TRUE, l, r, CAST(l * r AS {dec}), NULL, NULL, l * r <> l, ROUND(CAST(l * r AS DOUBLE) / l, 6)
    FROM (SELECT (SELECT COUNT(*) FROM shop_orders) AS l, (SELECT COUNT(*) FROM shop_refunds) AS r) x""")
    return shop_cte() + " UNION ALL ".join(parts)


@query("join_audit", oracle=_audit_oracle())
def join_audit_q(spark, sf_dir):
    """The join check on one query of each kind: a plain fan-out, one inside a WITH
    body, one that drops as many rows as it repeats, a lateral one, ranges with and without
    a key, a product. No join is run."""
    from ..sources.tables import sql_session
    s = sql_session(spark, sf_dir)
    queries = {k: v[0] for k, v in (AUDIT_CASES | RANGE_CASES).items()} | {"lateral": _LATERAL_SQL, "cross": _CROSS_SQL}
    return reduce(DataFrame.unionByName, [join_audit(s.sql(text), key) for key, text in queries.items()])
